"""BPE against the tokenizers library; token counts under edits against counting anew."""

from __future__ import annotations

import hashlib
from collections import Counter as Bag
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe, token_counts
from millrace.llm.queries import vocabulary_path
from millrace.llm.token_counts import Counter, Edit, TokenTree

tokenizers = pytest.importorskip("tokenizers")
PIECES = [" the", "the ", "a", "'", "s", "'re", "ll", "1", "23", " ", "  ", "\n", "\n\n", "!", "?!", "é", "中", "😀", "\t",
          "<|endoftext|>", "<|endo", "ftext|>", "\x85", "\xa0", "\x1c", "tion", "<", "|"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=40)


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def ours():
    return bpe.Vocabulary(Path(vocabulary_path()).read_text(encoding="utf-8"))


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_encodes_and_decodes_like_the_library(theirs, ours, text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 50256), max_size=20))
def test_decodes_any_ids_like_the_library(theirs, ours, ids):
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_long_junk_without_blanks(theirs, ours):
    text = "abtionthe" * 8000
    assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_every_row_is_encoded(theirs, edge, nothing):
    got = Bag((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(bpe.encoded(edge, vocabulary_path())).collect())
    want = Bag()
    for row in edge.collect():
        ids = theirs.encode(row.text or "", add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        want[(row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encoded(nothing, vocabulary_path()).count() == 0


@settings(max_examples=150, deadline=None)
@given(text=TEXTS, edits=st.lists(st.tuples(st.floats(0, 1), st.integers(0, 30), TEXTS), max_size=5))
def test_counts_follow_edits(ours, text, edits):
    tree = TokenTree(text, Counter(ours))
    assert tree.total == len(ours.encode(text))
    for where, length, new in edits:
        start = int(where * len(tree.text))
        tree.apply(Edit(start, min(len(tree.text), start + length), new))
        assert tree.total == len(ours.encode(tree.text))


def test_an_edit_encodes_little(ours):
    tree = TokenTree("some words here, and there. " * 2000, Counter(ours))
    before = tree.encoded
    tree.apply(Edit(20000, 20004, "what"))
    assert tree.encoded - before < 20


def test_edited_counts_of_every_row(ours, edge, nothing, workers):
    mail = workers.createDataFrame([(1, "write to a.b@c.example.com or 10.0.0.1 now"), (2, None)], "doc_id long, text string")
    one, two = sorted(token_counts.edited_counts(mail, vocabulary_path()).collect(), key=lambda r: r.doc_id)
    assert one.n_edits == 2 and one.n_tokens_after == len(ours.encode("write to <EMAIL> or <IP> now"))
    assert tuple(two) == (2, 0, 0, 0, 0, 0)
    assert token_counts.edited_counts(edge, vocabulary_path()).count() == edge.count()
    assert token_counts.edited_counts(nothing, vocabulary_path()).count() == 0
