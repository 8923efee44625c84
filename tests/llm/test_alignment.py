"""Cross-tokenizer alignment against loops over bytes; sparse products against dense ones."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import alignment
from millrace.llm.bpe import byte_symbols
from millrace.llm.csr import Csr, product
from millrace.llm.queries import vocabulary_path

A, B = vocabulary_path(), vocabulary_path("piece_bpe_32k.model")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text, libraries):
    """``(id, start, end)`` of both tokenizers, or None."""
    a, b = libraries
    byte_of = {s: n for n, s in enumerate(byte_symbols())}
    want = (" " + text).encode()
    tokens = [
        [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
         for i in b.encode(text)],
    ]
    if not text or any(b"".join(x for _, x in t) != want for t in tokens):
        return None
    out = []
    for side in tokens:
        at, placed = 0, []
        for i, raw in side:
            placed.append((i, at, at + len(raw)))
            at += len(raw)
        out.append(placed)
    return out


def brute(rows, libraries):
    found = []
    for key, text in rows:
        both = spans(text or "", libraries)
        if both is None:
            found.append((key, None, [], 0, 0, []))
            continue
        a, b = both
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [[[i for i, s, e in side if low <= s < high] for side in both] for low, high in zip([0, *ends], ends)]
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        found.append((key, groups, links, len(a), len(b), [len(x) * len(y) for x, y in groups]))
    held = Counter(p for _, _, links, *_ in found for p in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = Counter()
    for key, groups, links, n_a, n_b, shared in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or [])
        out[(key, n_a, n_b, len(groups or []), len(links), sum(held[p] == most[p[0]] for p in links),
             sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    return out


def result(df):
    return Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), shape=st.tuples(*[st.integers(1, 12)] * 3), slab=st.integers(1, 40))
def test_product_equals_dense(seed, shape, slab):
    rng = np.random.default_rng(seed)
    n, k, m = shape
    dense = [rng.integers(0, 4, s) * (rng.random(s) < 0.4) for s in ((n, k), (k, m))]
    sparse = []
    for d in dense:
        rows, columns = np.nonzero(d)
        starts = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(d)))))
        sparse.append(Csr(starts, columns, d[rows, columns], d.shape[1]))
    got = np.zeros((n, m), int)
    for row, column, value in product(*sparse, slab=slab):
        assert not got[row, column].any()
        got[row, column] = value
    assert (got == dense[0] @ dense[1]).all()
    turned = sparse[0].transposed()
    back = np.zeros((k, n), int)
    back[turned.row_of_entry(), turned.columns] = turned.values
    assert (back == dense[0].T).all()


TEXTS = [
    "Hello world, unbelievable tokenization!", "the the the", "<|endoftext|> <s> </s> <unk>", "naïve café 中文字 😀 ok", "x",
    "a  b", "trailing ", " leading", "tab\tline\nend", "", None, "ﬁ ligature", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "the the the",
]


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_equals_loops_over_bytes(workers, libraries, sent):
    rows = [*enumerate(TEXTS), (None, "null id"), (3, "repeated id"), (3, "repeated id")]
    docs = workers.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, pairs string, _row int")
    assert result(alignment.aligned(docs, A, B, sent_pairs=sent)) == brute(rows, libraries)


def test_equals_loops_over_the_table(spark, workers, sf_dir, libraries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 1500")
    assert result(alignment.aligned(docs, A, B)) == brute([(r.doc_id, r.text) for r in docs.collect()], libraries)


def test_long_texts_are_cut_where_no_token_crosses(libraries, monkeypatch):
    both = alignment.tokenizers_of(open(A, encoding="utf-8").read(), open(B, "rb").read())
    text = " ".join(["some words here, 12 of-them", "unbelievable\nlines  twice", "naïve 中文"] * 40)
    whole = alignment.measured([text, "b", text], both)
    monkeypatch.setattr(alignment, "PART", 50)
    monkeypatch.setattr(alignment, "LOT", 300)
    assert len(both.parts(text)) > 10
    cut = alignment.measured([text, "b", text], both)
    for name, value in whole.items():
        assert cut[name].tolist() == value.tolist() if isinstance(value, np.ndarray) else cut[name].equals(value)


def test_links_name_places(workers, libraries):
    docs = workers.createDataFrame([(1, TEXTS[0]), (2, None), (3, TEXTS[3])], "doc_id long, text string")
    for shared in (False, True):
        want = Counter()
        for key, text in ((1, TEXTS[0]), (3, TEXTS[3])):
            a, b = spans(text, libraries)
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            of = lambda end: next(n for n, e in enumerate(ends) if end <= e)
            for x, (i, s, e) in enumerate(a):
                for y, (j, t, f) in enumerate(b):
                    if shared and of(e) == of(f):
                        want[(key, x, y, i, j, ends[of(e)] - ([0, *ends][of(e)]))] += 1
                    elif not shared and s < f and t < e:
                        want[(key, x, y, i, j, min(e, f) - max(s, t))] += 1
        assert Counter(map(tuple, alignment.links(docs, A, B, shared_group=shared).collect())) == want


def test_odd_rows(edge, nothing):
    got = {r.doc_id: r for r in alignment.aligned(edge, A, B).collect() if r.doc_id is not None}
    assert alignment.aligned(edge, A, B).count() == edge.count()
    assert got[2].n_a == got[3].n_links == got[2].count_sum == 0 and got[3].groups_sha256 == ""
    assert got[5].n_a > 20000 and got[5].n_links >= got[5].n_groups
    assert alignment.aligned(nothing, A, B).count() == 0


def test_long_runs_of_blanks(libraries):
    both = alignment.tokenizers_of(open(A, encoding="utf-8").read(), open(B, "rb").read())
    for text in ("\n" * 6000 + "end", "x" + "\t" * 5000 + "y", "no blanks" * 900):
        (got,) = both.encode([text])
        assert got is None or got[0].tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
