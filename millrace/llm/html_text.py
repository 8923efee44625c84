"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A classifier gives each block a cost for
being content and one for being boilerplate; blocks next to each other or close
in the document tree pay for different labels. The cheapest labelling is a
minimum cut. Spark deals the pages; a page is worked on in one piece.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.labelled import least_hashes
from millrace.llm.min_cut import Cut

#: HTML elements by their role.
UNSEEN = {
    "script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "select", "textarea", "button",
    "canvas", "video", "audio", "datalist", "annotation", "annotation-xml",
}
#: Elements whose content has no tags of its own.
RAW = {"script", "style", "title", "textarea", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
AROUND_TEXT = {"article", "main"}
AROUND_REST = {"nav", "aside", "footer", "menu", "dialog", "search"}
ROLES_REST = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "toolbar",
}
NAMES_REST = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment",
    "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promotion", "recommended",
    "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "sidenav", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar", "widget",
}

#: Words that begin the class or id of what readers wrote, and words after which it is a switch of the page.
NAMES_READERS = {"comment", "comments", "disqus", "replies", "reply", "respond"}
SWITCHES = {"open", "opened", "closed", "enabled", "disabled", "allowed", "on", "off"}

_REST_OF_TAGS = r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z"
_COMMENT = r"<!--.*?(?:-->|\Z)"
_TAG = re.compile(
    rf"{_COMMENT}|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|{_REST_OF_TAGS}", re.S
)
#: For what follows a quote that never ends: a tag reaches to its first ``>``.
_UNQUOTED_TAG = re.compile(rf"{_COMMENT}|()()()(?!)|{_REST_OF_TAGS}", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s=\"'/>])([^\s=\"'/>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"[a-z]+")
_BLANK = re.compile(r"[\x20\x09-\x0d\xa0]+")

TEXT, REST, FORM, UNKNOWN = 1, -1, -2, 0
#: Costs, in thousandths: the most that the classifier may say of a block, what markup that names a role
#: says (a boilerplate element, a boilerplate class or id, an article or form, the bare body), and of
#: parted neighbours. Each of them is less than the classifier's most, so none decides alone. Only what
#: readers wrote counts more: it looks like text, so its looks say nothing.
MOST = 8000
READERS = 9000
ELEMENT, NAMED, LIKELY, UNCERTAIN = 6500, 4500, 4000, 1500
NEXT, SIBLING, COUSIN, ACROSS = 300, 600, 250, 60
PAGES = 400
#: Pull to the plain weights, per block.
RIDGE = 0.005


@dataclass
class Place:
    """What markup says of the blocks in an element: a role, and how much it counts.

    An article inside boilerplate speaks against what is ``around`` it. Alone
    in there it is the text, and the name around it misleads; one of several
    is a teaser, and the name around them holds. An article among what readers
    wrote is a comment, however few there are.
    """

    role: int = UNKNOWN
    weight: int = 0
    around: Place | None = None
    articles: int = 0

    def settled(self) -> Place:
        return self.around.settled() if self.around and self.around.articles > 1 else self


@dataclass
class Block:
    text: str
    tag: str
    link_share: float
    parents: tuple[int, int, int]
    place: Place

    @property
    def role(self) -> int:
        return self.place.role


@dataclass
class _Open:
    tag: str
    number: int
    place: Place
    #: Nothing in it is shown, and whether an end tag follows somewhere.
    unseen: bool = False
    ends: bool = True


@dataclass
class _Builder:
    """Collects the blocks of one page while its tags go by."""

    stack: list[_Open] = field(default_factory=lambda: [_Open("", 0, Place())])
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    #: Where in the stack the open elements of each name are.
    named: dict[str, list[int]] = field(default_factory=dict)
    linked: int = 0
    length: int = 0
    in_link: bool = False
    numbers: int = 0

    @property
    def unseen(self) -> bool:
        return self.stack[-1].unseen

    def add(self, text: str) -> None:
        if self.unseen:
            return
        self.parts.append(text)
        visible = len(text)
        self.length += visible
        if self.in_link:
            self.linked += visible

    def flush(self) -> None:
        if self.parts:
            text = _BLANK.sub(" ", html.unescape("".join(self.parts))).strip(" ")
            if text:
                top = self.stack[-1]
                ids = [o.number for o in self.stack[-3:]][::-1]
                ids += [0] * (3 - len(ids))
                self.blocks.append(Block(text, top.tag, self.linked / max(1, self.length), tuple(ids), top.place))
            self.parts, self.linked, self.length = [], 0, 0

    def push(self, entry: _Open) -> None:
        self.named.setdefault(entry.tag, []).append(len(self.stack))
        self.stack.append(entry)

    def cut(self, depth: int) -> None:
        """Ends all elements from ``depth`` on."""
        while len(self.stack) > depth:
            self.named[self.stack.pop().tag].pop()

    def reveal(self) -> None:
        """Ends what is not shown."""
        while self.unseen:
            self.cut(len(self.stack) - 1)

    def open(self, tag: str, attributes: str) -> None:
        if self.unseen:
            if self.stack[-1].ends:
                self.push(_Open(tag, 0, self.stack[-1].place, unseen=True))
                return
            self.reveal()
        self.flush()
        closes = CLOSES.get(tag)
        if self.stack[-1].tag == "p" or (closes and self.stack[-1].tag in closes):
            self.cut(len(self.stack) - 1)
            if closes and self.stack[-1].tag in closes:
                self.cut(len(self.stack) - 1)
        self.numbers += 1
        self.push(_Open(tag, self.numbers, _place(tag, attributes, self.stack[-1].place)))

    def hide(self, tag: str, ends: bool) -> None:
        """An element that is not shown begins; the text around it stays one block."""
        self.push(_Open(tag, 0, self.stack[-1].place, unseen=True, ends=ends))

    def close(self, tag: str) -> None:
        """Ends the innermost element of that name with all in it, shown or not."""
        depths = self.named.get(tag)
        if not depths:
            if not self.unseen:
                self.flush()
        elif self.stack[depths[-1]].unseen:
            self.cut(depths[-1])
        else:
            self.reveal()
            self.flush()
            self.cut(depths[-1])


def _place(tag: str, attributes: str, above: Place) -> Place:
    """What the markup says of everything inside the element.

    Boilerplate and forms hold all the way down, but give way to an article in them.
    """
    says = _boilerplate(tag, attributes, above)
    if says:
        return above if above.role == REST and above.weight <= -says else Place(REST, -says)
    if tag in AROUND_TEXT and above.role != TEXT:
        if tag == "article" and above.role == REST and above.weight == -READERS:
            return above
        if above.role != REST or tag == "main":
            return Place(TEXT, LIKELY)
        above.articles += 1
        return Place(TEXT, LIKELY, above)
    if tag == "form" and above.role != REST:
        return Place(FORM, -LIKELY)
    return above


def _boilerplate(tag: str, attributes: str, above: Place) -> int:
    """How much the element itself says for boilerplate."""
    names: set[str] = set()
    says = ELEMENT if tag in AROUND_REST else 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes or ""):
        name = name.lower()
        if name in ("class", "id"):
            for token in (a or b or c).lower().split():
                words = _NAME.findall(token)
                names.update(words)
                if words and words[0] in NAMES_READERS and words[-1] not in SWITCHES and tag not in ("body", "html"):
                    return READERS
        elif name == "role" and (a or b or c).lower() in ROLES_REST:
            says = ELEMENT
    if says:
        return says
    if tag != "body" and tag != "html" and names & NAMES_REST:
        return NAMED
    return NAMED if tag == "header" and above.role != TEXT else 0


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order; scripts, styles, form controls and markup are gone.

    What is not shown ends with its parent, or with the next block where it has
    no end tag; a script or style without one takes the rest of the page, as in
    browsers. Of formulas the symbols are text, and what stands in for scripts
    is text in an article.
    """
    builder, ends, pattern, at = _Builder(), _Ends(page), _TAG, 0
    size = len(page)
    while at < size:
        found = pattern.search(page, at)
        if not found:
            builder.add(page[at:])
            break
        if found.start() > at:
            builder.add(page[at : found.start()])
        at = found.end()
        ending, tag, attributes = found.group(1, 2, 3)
        if not tag:
            ending, tag, attributes = found.group(4, 5, 6)
            if not tag:
                continue
            pattern = _UNQUOTED_TAG
        tag = tag.lower()
        if tag in UNSEEN:
            if ending:
                if builder.unseen:
                    builder.close(tag)
            elif not attributes.endswith("/") and not (tag == "noscript" and builder.stack[-1].place.role == TEXT):
                end = ends.after(tag, at)
                if tag == "head":
                    at = _end_of_head(page, at, end)
                elif tag in RAW and end:
                    at = end[1]
                elif tag in ("script", "style"):
                    at = size
                else:
                    builder.hide(tag, end is not None)
            if tag == "head":
                builder.flush()
        elif tag == "a":
            builder.in_link = not ending if not builder.unseen else builder.in_link
        elif tag == "br" or tag == "hr":
            if tag == "br":
                builder.add(" ")
            elif not builder.unseen:
                builder.flush()
        elif tag in BLOCK:
            builder.close(tag) if ending else builder.open(tag, attributes)
    builder.reveal()
    builder.flush()
    for block in builder.blocks:
        block.place = block.place.settled()
    return builder.blocks


_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in UNSEEN}
_BODY = re.compile(r"<body\b", re.I)


@dataclass
class _Ends:
    """Next end tag of each name; looked up from left to right, the page is searched once per name."""

    page: str
    found: dict[str, tuple[int, int] | None] = field(default_factory=dict)

    def after(self, tag: str, at: int) -> tuple[int, int] | None:
        known = self.found.get(tag, (-1, -1))
        if known is not None and known[0] < at:
            match = _ENDS[tag].search(self.page, at)
            known = self.found[tag] = match.span() if match else None
        return known


def _end_of_head(page: str, at: int, end: tuple[int, int] | None) -> int:
    """Where the head ends; an unclosed one ends at the body."""
    body = _BODY.search(page, at)
    if body and (not end or body.start() < end[0]):
        return body.start()
    return end[1] if end else at


SHAPE = ["one", "length", "links", "sentences", "ends", "heading", "item", "paragraph", "capitals"]


def shape(block: Block) -> list[float]:
    """What the classifier sees of a block, without the role its markup names."""
    text = block.text
    words = text.count(" ") + 1
    marks = text.count(".") + text.count("!") + text.count("?") + text.count(",")
    head = block.tag[:1] == "h" and block.tag[1:].isdigit()
    return [
        1.0, min(len(text), 2000) ** 0.5 / 10, block.link_share, min(1.0, 5 * marks / words), float(text[-1] in ".!?:;\"'»”"),
        float(head), float(block.tag in ("li", "dd", "dt", "td", "th")), float(block.tag in ("p", "pre", "blockquote")),
        float(text.isupper()),
    ]


#: Used where no page of the table marks up its article and its rest.
PLAIN = (-2.0, 2.0, -4.0, 1.5, 1.0, 0.5, -1.0, 1.5, -0.5)


def train(pages: list[str]) -> tuple[float, ...]:
    """Weights of a logistic classifier over block shapes, learnt from the
    blocks whose markup names their role and does not contradict itself. Both
    roles weigh alike. Blocks of one template say the same over and over, so
    the more there are, the more it takes to leave ``PLAIN``."""
    rows, target = [], []
    for page in pages:
        for block in blocks_of(page):
            if block.role in (TEXT, REST) and not block.place.around:
                rows.append(shape(block))
                target.append(float(block.role == TEXT))
    x, y = np.array(rows).reshape(-1, len(SHAPE)), np.array(target)
    if not len(y) or y.min() == y.max():
        return PLAIN
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.array(PLAIN)
    ridge = np.full(len(w), max(1.0, RIDGE * len(y)))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * (w - PLAIN)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return tuple(float(v) for v in w)


def evidence(blocks: list[Block]) -> list[int]:
    """What markup says for each block being content.

    Where nothing on the page is called its text, the name of an element that
    holds more than half of the unlinked text counts the less the more it holds:
    boilerplate seldom outweighs the rest, and some wrapper has to hold the text.
    """
    own = [len(b.text) * (1 - b.link_share) for b in blocks]
    held: dict[int, float] = {}
    for block, length in zip(blocks, own, strict=True):
        held[id(block.place)] = held.get(id(block.place), 0) + length
    total = sum(own)
    full = not total or any(b.role == TEXT for b in blocks)
    out = []
    for block in blocks:
        misled = block.role == FORM or block.place.weight == -NAMED
        trust = 1.0 if full or not misled else min(1.0, 2 - 2 * held[id(block.place)] / total)
        out.append(int(trust * block.place.weight))
    return out


def main_blocks(blocks: list[Block], weights: tuple[float, ...]) -> list[Block]:
    """The blocks on the content side of the minimum cut."""
    keep, drop = [], []
    for block, said in zip(blocks, evidence(blocks), strict=True):
        seen = sum(a * b for a, b in zip(weights, shape(block), strict=True))
        cost = int(max(-MOST, min(MOST, 1000 * seen))) + said
        if block.role == UNKNOWN:
            cost -= UNCERTAIN * (block.tag in ("", "body", "html"))
        keep.append(max(cost, 0))
        drop.append(max(-cost, 0))
    cut = Cut(keep, drop)
    last: dict[int, int] = {}
    for n, block in enumerate(blocks):
        parent, grand = block.parents[1], block.parents[2]
        if n:
            before = blocks[n - 1]
            near = NEXT if before.role == block.role else ACROSS
            cut.tie(n - 1, n, near)
        for number, cost in ((parent, SIBLING), (grand, COUSIN)):
            other = last.get(number)
            if other is not None and blocks[other].role == block.role:
                cut.tie(other, n, cost)
        last[parent] = last[grand] = n
    return [b for b, kept in zip(blocks, cut.kept(), strict=True) if kept]


def main_text(page: str, weights: tuple[float, ...] = PLAIN) -> str:
    """Main text of one page, its blocks joined by an empty line."""
    return "\n\n".join(b.text for b in main_blocks(blocks_of(page), weights))


def fitted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = PAGES) -> tuple[float, ...]:
    """Weights learnt from at most ``sample`` pages, chosen by a hash of their ids."""
    rows = pages.select(id_col, html_col).filter(F.col(html_col).isNotNull())
    chosen = least_hashes(rows, F.col(id_col), sample)
    return train([r[html_col] for r in chosen.collect()])


def extracted(
    pages: DataFrame, weights: tuple[float, ...], html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``pages`` with ``text_col`` in place of the html: the main text of each whole page.

    A null or empty page, and one without main text, give an empty text. Other
    columns pass through unread; one already called ``text_col`` is replaced.
    Null and repeated ids are rows like others; an empty table gives an empty
    result.
    """
    kept = [c for c in pages.columns if c not in (html_col, text_col)]
    rows = pages.select(*kept, F.col(html_col).alias("_html"))
    at = len(kept)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(p or "", weights) for p in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(texts, pa.string())], names=[*kept, text_col]
                )

    fields = [pages.schema[c] for c in kept]
    return rows.mapInArrow(extract, StructType([*fields, StructField(text_col, StringType())]))
