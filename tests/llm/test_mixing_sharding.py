"""Targets, what is taken, training order, and shards."""

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadlens.llm import mixing, sharding
from tests.llm.data import byte_words, documents, empty, frame


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by the rule itself: share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    free = set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        over = 0.0
        for s in list(free):
            target[s] += left * weight[s] / total
            if target[s] >= most * sizes[s]:
                over += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.remove(s)
        left = over
    return target


def test_targets_and_taken(spark):
    rows = documents()
    sizes = Counter()
    largest = defaultdict(int)
    for _, text, _, source in rows:
        n = len(byte_words(text))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want = water(sizes)
    got = mixing.take(frame(spark, rows)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted(
        (r[0], len(byte_words(r[1]))) for r in rows if r[0] is not None
    )
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1
    again = mixing.take(frame(spark, rows).repartition(7)).select("doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))


def test_positions_invert_the_schedule(spark):
    """The integral of a schedule up to a copy's position is the copy's share of the target."""
    copies = mixing.schedule(mixing.take(frame(spark, documents()))).collect()
    last = {}
    for c in copies:
        a, b = mixing.RAMPS[c.rank % 3]
        met = (a * c.position + (b - a) * c.position**2 / 2) / ((a + b) / 2)
        share = min(1.0, (c.epoch * c.source_size + c._offset) / c.target)
        assert abs(met - share) < 1e-9
        last[c.source] = max(last.get(c.source, 0), c.position)
    assert len(copies) == sum(r.copies for r in mixing.take(frame(spark, documents())).select("copies").collect())


def test_mix_keeps_columns_and_order(spark):
    docs = frame(spark, documents())
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    copies = Counter()
    for r in mixing.take(docs).select("doc_id", "size", "copies").collect():
        copies[r.doc_id, r["size"]] += r.copies
    got = Counter((r.doc_id, len(byte_words(r.text))) for r in mix.collect())
    assert got == +copies
    order = mixing.training_order(mixing.schedule(mixing.take(docs))).select(F.spark_partition_id().alias("p"), "position").collect()
    spans = pd.DataFrame(order, columns=["p", "position"]).groupby("p").position.agg(
        ["min", "max", lambda x: x.is_monotonic_increasing]
    )
    assert spans.iloc[:, 2].all()
    assert (spans["min"].iloc[1:].to_numpy() >= spans["max"].iloc[:-1].to_numpy()).all()


def test_mixing_of_nothing(spark):
    assert mixing.take(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0
    blank = frame(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert [r.taken for r in mixing.take(blank).collect()] == [0, 0]


def test_packing_is_by_dot_product():
    items = pd.DataFrame({"_bytes": [60, 50, 40, 30, 20], "_words": [6, 50, 4, 30, 2], "_rows": [1, 1, 1, 1, 1]})
    shard = sharding.pack(items, 2)
    load = np.zeros((2, 3))
    share = items.to_numpy(float) / items.to_numpy(float).sum(axis=0) * 2
    for i in np.lexsort((np.arange(5), -share.sum(axis=1), -share.max(axis=1))):
        fits = [s for s in range(2) if (load[s] + share[i] <= 1).all()]
        best = max(fits, key=lambda s: ((1 - load[s]) @ share[i], -s)) if fits else min(range(2), key=lambda s: load[s][0])
        assert shard[i] == best
        load[best] += share[i]


@pytest.mark.parametrize("n_shards", [3, 40])
def test_shards(spark, n_shards):
    rows = documents() + [(50_000 + i, "hot text here", "en", "a") for i in range(400)]
    got = sharding.place(frame(spark, rows), n_shards, parcels_per_shard=16).collect()
    assert sorted((r["size"]) for r in got) == sorted(len((t or "").encode()) + 16 for _, t, *_ in rows)
    slots = defaultdict(list)
    total = Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert set(slots) <= set(range(n_shards))
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    largest = max(len((t or "").encode()) + 16 for _, t, *_ in rows)
    whole = sum(total.values())
    if n_shards == 3:
        assert max(total.values()) <= max(whole / 3 * 1.05, largest * 1.01)


def test_small_groups_stay_together(spark):
    rows = documents()
    got = sharding.place(frame(spark, rows), 2, parcels_per_shard=8)
    text = frame(spark, rows).selectExpr("doc_id", "text")
    joined = got.join(text, "doc_id").filter("length(text) between 1 and 20").groupBy("text").agg(F.countDistinct("shard").alias("n"))
    assert joined.agg(F.max("n")).first()[0] == 1


def test_into_shards(spark):
    docs = frame(spark, documents())
    out = sharding.into_shards(docs, 5)
    assert out.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert sorted(map(repr, out.select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert sharding.into_shards(empty(spark)).count() == 0
