"""Components and shingle counts against all pairs."""

import random

import numpy as np
import pytest

from roadlens.llm import jaccard
from tests.llm.data import byte_words, documents, empty, frame


def shingles(text, n):
    w = byte_words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, threshold, n):
    """(id, size, smallest reachable id) of every row by comparing all pairs."""
    sets = [shingles(t, n) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        ((r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr
    )


@pytest.mark.parametrize(("threshold", "n"), [(90, 3), (80, 5), (60, 2)])
def test_against_all_pairs(spark, threshold, n):
    rows = documents()
    got = jaccard.classes(frame(spark, rows), threshold, n).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, threshold, n)


def test_chain_and_short_sets(spark):
    """A chain whose ends are not alike is one component; one-word texts link only to themselves."""
    words = [f"c{i}" for i in range(60)]
    chain = [(100 - k, " ".join(words[k : k + 50]), "en", "a") for k in range(0, 10, 2)]
    rows = chain + [(1, "solo", "en", "a"), (2, "SOLO", "en", "a"), (3, "duo solo", "en", "a")]
    got = jaccard.classes(frame(spark, rows), 90, 3).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 90, 3)


@pytest.mark.parametrize(("threshold", "n", "more"), [(90, 3, 8), (90, 3, 11), (80, 5, 20), (80, 5, 25)])
def test_added_text(spark, threshold, n, more):
    """Texts and copies that only go on longer, or lack their start; no third text shares a shingle."""
    rows = []
    for k in range(60):
        words = [f"w{k}x{i}" for i in range(100 + n - 1 + more)]
        whole, cut = " ".join(words), " ".join(words[:-more] if k % 2 else words[more:])
        rows += [(2 * k, whole, "en", "a"), (2 * k + 1, cut, "en", "a")]
    got = jaccard.classes(frame(spark, rows), threshold, n).select("doc_id", "n_shingles", "component_id")
    want = brute(rows, threshold, n)
    assert sum(c != i for i, _, c in want) == 60
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_one_of_each(spark):
    rows = documents()
    docs = frame(spark, rows)
    kept = jaccard.one_of_each(docs, threshold=80, n=5)
    assert kept.columns == docs.columns
    want = brute(rows, 80, 5)
    with_words = [w for w in want if w[1]]
    got = [r for r in kept.collect() if byte_words(r.text)]
    assert sorted((r.doc_id for r in got), key=repr) == sorted({w[2] for w in with_words}, key=repr)
    assert kept.count() - len(got) == len(want) - len(with_words)


def test_empty_table(spark):
    assert jaccard.classes(empty(spark)).count() == 0
    assert jaccard.one_of_each(empty(spark)).count() == 0


def families(seed, n_families=3, members=25, size=150):
    """Copies with a few words changed: pairs on both sides of the threshold that share most of their shingles."""
    rng, rows = random.Random(seed), []
    for f in range(n_families):
        base = [f"f{f}x{i}" for i in range(size)]
        for _ in range(members):
            words = list(base)
            for _ in range(rng.randrange(1, 9)):
                words[rng.randrange(size)] = f"y{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize(("threshold", "n"), [(90, 3), (80, 5)])
def test_families_about_the_threshold(spark, threshold, n):
    rows = families(3)
    got = jaccard.classes(frame(spark, rows), threshold, n).select("doc_id", "n_shingles", "component_id")
    want = brute(rows, threshold, n)
    assert 3 < len({c for *_, c in want}) < len(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_few_pairs_reach_the_whole_sets(spark, monkeypatch):
    """Postings without a partner of their size go; bitmaps rule out what is not alike."""
    made, store = {}, jaccard.stored

    def counted(df, name, *args):
        made.setdefault(name, []).append((done := store(df, name, *args)).count())
        return done

    monkeypatch.setattr(jaccard, "stored", counted)
    rows = [(i, " ".join(["one rare start", *(f"z{i}x{k}" for k in range(20 * 2**i))]), "en", "a") for i in range(5)]
    jaccard.classes(frame(spark, rows)).count()
    assert made["jaccard-postings"] == [0]
    made.clear()
    jaccard.classes(frame(spark, families(4, 1, 40))).count()
    assert sum(made["jaccard-close"]) < 0.5 * (sum(made["jaccard-pairs"]) + sum(made["jaccard-rest"]))


def test_bitmaps_bound_what_is_common():
    rng = np.random.default_rng(2)
    for n, m, common in [(1, 1, 0), (1, 1, 1), (20, 33, 20), (500, 540, 470), (500, 900, 3), (5, 1000, 5)]:
        values = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
        rng.shuffle(values)
        a, b = np.sort(values[:n]), np.sort(values[n - common : n - common + m])
        one, two = (np.frombuffer(jaccard.bitmap(x), dtype=np.uint64) for x in (a, b))
        assert jaccard.shared_shingles(a, b, n, m) == common
        assert common <= jaccard.may_share(one, two, n, m) <= min(n, m)
        if n == 500:
            assert jaccard.may_share(one, two, n, m) < common + 0.5 * (n - common)
