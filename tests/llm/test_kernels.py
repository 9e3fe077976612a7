"""Kernels against the plain functions of the language."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.llm import kernels

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é\t\n\x0b0-漢", max_size=30)), max_size=12)


def expected(texts, lower):
    return [(t or "").encode().lower().split() if lower else (t or "").encode().split() for t in texts]


@pytest.mark.parametrize("piece", [1, 7, 1 << 17])
@pytest.mark.parametrize("lower", [False, True])
@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_words(piece, lower, texts):
    before, kernels.PIECE = kernels.PIECE, piece
    try:
        found, names = {}, {}
        for block in kernels.blocks(pa.array(texts, pa.string()), 20):
            w = kernels.words(block, kernels.LOWERED if lower else kernels.PLAIN)
            for row, start, end, value in zip(w.row, w.start, w.end, w.hash, strict=True):
                word = bytes(block.data[start:end])
                word = word.lower() if lower else word
                found.setdefault(block.first + row, []).append(word)
                assert names.setdefault(word, value) == value
    finally:
        kernels.PIECE = before
    assert [found.get(i, []) for i in range(len(texts))] == expected(texts, lower)
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_count_and_windows(texts):
    column = pa.array(texts, pa.string())
    assert kernels.count_words(column).tolist() == [len(w) for w in expected(texts, False)]
    for block in kernels.blocks(column):
        w = kernels.words(block, kernels.PLAIN)
        hashes, at = kernels.windows(w.hash, w.row, 3)
        own = expected(texts, False)[block.first : block.first + block.rows]
        triples = [tuple(x[i : i + 3]) for x in own for i in range(len(x) - 2)]
        assert len(hashes) == len(at) == len(triples)
        assert len(set(hashes.tolist())) == len(set(triples))


def test_long_word_over_pieces():
    before, kernels.PIECE = kernels.PIECE, 64
    try:
        (block,) = kernels.blocks(pa.array(["x" * 1000 + " y", "x" * 1000]))
        w = kernels.words(block, kernels.PLAIN)
    finally:
        kernels.PIECE = before
    assert w.row.tolist() == [0, 0, 1] and w.hash[0] == w.hash[2] != w.hash[1]
