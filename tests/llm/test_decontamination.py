"""Windows, longest matches and removal against plain search."""

import hashlib
import random
import re

import pytest

from roadlens.llm import decontamination
from tests.llm.data import documents, empty, frame, sentence

PATTERN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall((text or "").encode().lower())


def brute(rows, items, window=10):
    found = []
    for doc_id, text, *_ in rows:
        own = words(text)
        hit, ids = set(), set()
        for item_id, item in items:
            w = words(item)
            n = min(window, len(w))
            probes = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(own) - n + 1) if n else ():
                if tuple(own[i : i + n]) in probes:
                    hit.update(range(i, i + n))
                    ids.add("null" if item_id is None else str(item_id))
        names = ",".join(sorted(ids))
        found.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(3)
    bench = [(i, sentence(rng, rng.randrange(11, 40), [f"b{k}" for k in range(30)])) for i in range(30)]
    bench += [(100, "short item"), (101, "Lone"), (102, None), (103, ""), (None, "null id item"), (7, bench[7][1]), (11, bench[3][1])]
    return bench


@pytest.fixture(scope="module")
def rows(items):
    rng = random.Random(4)
    docs = documents()[:60]
    for i in range(30):
        own = items[rng.randrange(30)][1].split()
        cut = own[rng.randrange(3) : len(own) - rng.randrange(3)]
        text = f"{sentence(rng, 9)} {' '.join(cut)}{rng.choice([' ', '-', '... '])}{sentence(rng, 20)} {' '.join(own[:9])}"
        docs.append((1000 + i, text.upper() if i % 3 == 0 else text, "en", "a"))
    docs += [(2000, "a Short-Item here, lone", "en", "a"), (2001, "null id item", "en", "a"), (2002, " ".join(items[0][1].split() * 400), "en", "a")]
    return docs


def test_against_search(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    for part_words in (2_000_000, 60):
        got = decontamination.matches(frame(spark, rows), bench, part_words=part_words).selectExpr(
            "doc_id", "n_words", "n_hit", "size(items)", "sha2(encode(array_join(items, ','), 'UTF-8'), 256)", "n_hit > 0"
        )
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items)


def test_longest_matches(spark, rows, items):
    """Each match is verbatim, cannot be made longer on either side, and all windows lie in one."""
    bench = spark.createDataFrame(items, "item_id long, text string")
    text_of = {}
    for doc_id, text, *_ in rows:
        text_of.setdefault(doc_id, words(text))
    items_of = {}
    for item_id, text in items:
        items_of.setdefault("null" if item_id is None else str(item_id), []).append(words(text))
    some = 0
    for row in decontamination.matches(frame(spark, rows), bench).collect():
        own = text_of[row.doc_id]
        for m in row.matches:
            a, b, n = m.doc_word, m.item_word, m.n_words
            whole = [w for w in items_of[m.item_id] if own[a : a + n] == w[b : b + n] and len(w) >= b + n]
            assert whole
            assert any(
                (a == 0 or b == 0 or own[a - 1] != w[b - 1]) and (a + n == len(own) or b + n == len(w) or own[a + n] != w[b + n])
                for w in whole
            )
            some += 1
    assert some > 30


def test_remove_and_empty(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    left = decontamination.remove(docs, bench)
    assert left.columns == docs.columns
    want = [r[0] for r in brute(rows, items) if not r[5]]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(want, key=repr)
    assert decontamination.remove(empty(spark), bench).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.remove(docs, nothing).count() == docs.count()
