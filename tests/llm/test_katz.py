"""Scores and counts against a plain Katz model; the model adds up to one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadlens.llm import katz
from tests.llm.data import byte_words, documents, empty, frame


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class Plain:
    """The model by its definition, over all rows in memory."""

    def __init__(self, rows):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for doc_id, text, *_ in rows:
            if not held_out(doc_id):
                h = b"<s>"
                for w in [*byte_words(text, lower=True), None]:
                    self.uni[w] += 1
                    self.bi[h][w] += 1
                    h = w
        self.n = sum(self.uni.values())
        self.d1 = self.ratios(Counter(self.uni.values()))
        self.d2 = self.ratios(Counter(c for m in self.bi.values() for c in m.values()))
        left = sum((1 - self.d1[c]) * c for c in self.uni.values() if c <= 5)
        self.total = self.n + (left == 0)
        self.unknown = (left or 1) / self.total

    @staticmethod
    def ratios(n):
        found = [1.0] * 6
        if not n[1]:
            return found
        common = 6 * n[6] / n[1]
        for r in range(1, 6):
            if n[r] and common < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                if 0 < d < 1:
                    found[r] = d
        return found

    def word(self, w):
        c = self.uni.get(w, 0)
        return (self.d1[c] if c <= 5 else 1) * c / self.total if c else self.unknown

    def pair(self, h, w):
        seen = self.bi.get(h)
        if not seen:
            return self.word(w)
        kept = {x: (self.d2[c] if c <= 5 else 1) * c for x, c in seen.items()}
        total = sum(seen.values())
        left = sum((1 - self.d2[c]) * c for c in seen.values() if c <= 5)
        if left == 0:
            left, total = 1, total + 1
        if w in kept:
            return kept[w] / total
        return left / total / (1 - sum(self.word(x) for x in seen)) * self.word(w)


@pytest.mark.parametrize(("chunk", "part"), [(4_000_000, 2_000_000), (5_000, 3_000)])
def test_against_plain_model(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "PART_TOKENS", part)
    monkeypatch.setattr(katz.kernels, "BLOCK", 1 << 14)
    rows = documents()
    model = Plain(rows)
    want = []
    for doc_id, text, *_ in rows:
        tokens = [*byte_words(text, lower=True), None]
        base = sum(math.log10((model.uni.get(w, 0) + 0.5) / (model.n + 0.5 * (len(model.uni) + 1))) for w in tokens)
        score = sum(math.log10(model.pair(h, w)) for h, w in zip([b"<s>", *tokens], tokens, strict=False))
        known = sum(w in model.uni for w in tokens)
        want.append((doc_id, held_out(doc_id), len(tokens), known, model.n, base, score))
    got = [tuple(r) for r in katz.score(frame(spark, rows).repartition(3)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_plain_model_adds_up_to_one():
    model = Plain(documents())
    assert sum(map(model.word, model.uni)) + model.unknown == pytest.approx(1)
    for h in list(model.bi)[:30]:
        assert sum(model.pair(h, w) for w in model.uni) + model.pair(h, b"never seen") == pytest.approx(1)


def test_held_out_text_is_more_likely_than_by_base_counts(spark):
    rows = [r for r in documents() if r[1] and len(r[1]) < 5_000][:26]
    got = katz.score(frame(spark, rows)).filter("held_out").selectExpr("sum(score) > sum(base_score)").first()[0]
    assert got


def test_little_input(spark):
    assert katz.score(empty(spark)).count() == 0
    row = katz.score(frame(spark, [(1, None, "en", "a")])).first()
    assert row.n_tokens == 1 and math.isfinite(row.score) and math.isfinite(row.base_score)


def test_no_row_holds_all_answers_to_a_chunk(spark):
    plan = katz.score(frame(spark, documents()))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    # the answers alone are moved, not the chunks with their tokens
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning(chunk") == 1


@pytest.mark.parametrize("width", [1, 4, 6, 8])
def test_packed_numbers(width):
    top = (1 << (8 * width)) - 1
    for values in ([], [0], [top], [0, 1, 255, 3, top], [1] * 100_000):
        values = np.array(values, dtype=np.uint64)
        packed = katz.pack(values, width)
        assert katz.unpack(packed, width).tolist() == values.tolist()
        assert len(packed) < 200
