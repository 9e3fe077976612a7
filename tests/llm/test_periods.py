"""Runs against a word-by-word reading of every period."""

import hashlib
import random
import zlib

import numpy as np

from roadlens.llm import periods
from tests.llm.data import byte_words, documents, empty, frame


def smallest_period(words):
    fail = [0] * (len(words) + 1)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k]
        k += words[i] == words[k]
        fail[i + 1] = k
    return len(words) - fail[len(words)]


def naive_runs(words):
    """(start, length, period) of all runs, by start, then period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_words(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, words):
    runs = naive_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def stitched(rows):
    return sorted((int(s), int(e - s), int(q)) for _, q, s, e in rows if e - s >= max(6, 4 * q))


def test_kernel_on_words_of_few_letters():
    rng = np.random.default_rng(3)
    fibonacci, morse = [0, 1], [0]
    while len(fibonacci) < 400:
        fibonacci = fibonacci + fibonacci[: int(len(fibonacci) / 1.618)]
    while len(morse) < 256:
        morse = morse + [1 - x for x in morse]
    cases = [fibonacci, morse, [0] * 300, [0, 1] * 150, [0] * 5, [0] * 6, [0, 1] * 4, [0, 1] * 3 + [0], [], [1]]
    for size in (7, 20, 40, 90, 200):
        for letters in (2, 3):
            cases += [rng.integers(0, letters, size).tolist() for _ in range(40)]
            for p in (1, 2, 3, 5, 8, 13, 21, 40):
                block = rng.integers(0, letters, p).tolist()
                start = rng.integers(0, 9)
                made = rng.integers(0, letters, start).tolist() + block * (size // p + 1)
                cases.append(made[:size] + rng.integers(0, letters, 9).tolist())
    offsets = np.cumsum([0] + [len(c) for c in cases])
    rows = periods.fragments(np.array([w for c in cases for w in c]), offsets)
    for i, words in enumerate(cases):
        want = sorted(naive_runs(words))
        assert stitched(rows[rows[:, 0] == i]) == want, words
    assert sum(len(naive_runs(c)) for c in cases) > 200


def test_z_function():
    rng = random.Random(1)
    for _ in range(50):
        x = [rng.randrange(2) for _ in range(30)]
        naive = [next((k for k in range(30 - i) if x[k] != x[i + k]), 30 - i) for i in range(30)]
        assert periods.z_function(x) == naive


def rows_for_spark():
    rng = random.Random(8)
    rows = [r for r in documents() if len(r[1] or "") < 20_000]
    for i in range(200, 420):
        size = rng.choice([3, 9, 40, 160])
        rows.append((i, " ".join(rng.choice(["a", "b", "ä", "the"]) for _ in range(size)), "en", "a"))
    rows.append((500, "a " * 700, "en", "a"))
    rows.append((501, "x y z\n\t" * 200 + "\x0bx y x y", "en", "a"))
    rows += [(None, "r s " * 9, None, None)] * 3
    return rows


def test_runs_and_collapsed_texts(spark):
    rows = rows_for_spark()
    made = periods.planted(frame(spark, rows).select("doc_id", "text"))
    got = sorted((tuple(r) for r in periods.collapse(made, digests=True).collect()), key=repr)
    want = sorted((expected(i, planted_words(i, byte_words(t))) for i, t, *_ in rows), key=repr)
    assert got == want
    assert sum(r[1] for r in want) > 20


def test_collapsed_text_is_kept_as_text(spark):
    rows = [(1, "so so so so so so it goes on and on and on and on and on", "en", "a"), (2, None, "en", "a"), (3, "", "en", "a")]
    got = {r.doc_id: r for r in periods.collapse(frame(spark, rows)).collect()}
    assert got[1].collapsed == "so it goes on and" and got[1].runs == "0,6,1\n8,9,2\n"
    assert (got[2].n_runs, got[2].collapsed, got[3].collapsed, got[2].start) == (0, "", "", None)
    assert periods.collapse(empty(spark)).count() == 0


def test_fragments_of_other_tasks_are_stitched(spark):
    rows = [(b"k", 2, 0, 12), (b"k", 2, 10, 30), (b"k", 2, 29, 60), (b"k", 3, 0, 11), (b"l", 2, 0, 7), (b"l", 2, 0, 8)]
    got = periods.stitched(spark.createDataFrame(rows, periods.FRAGMENTS)).collect()
    assert sorted((bytes(r.key), r.period, r.start, r.length) for r in got) == [(b"k", 2, 0, 30), (b"k", 2, 29, 31), (b"l", 2, 0, 8)]


def test_tiles_of_long_documents_cost_little():
    words = np.arange(300_000) % 1000
    words[150_000:] = np.random.default_rng(2).integers(0, 50, 150_000)
    rows = periods.fragments(words, np.array([0, len(words)]))
    assert [r for r in stitched(rows) if r[2] == 1000] == [(0, 150_000, 1000)]
