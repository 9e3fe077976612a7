"""Global-order operators against brute force, with ties, skew and odd partitionings."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from roadlens.operators import ordered, uplift


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        # A third of all rows share one value, one group holds most rows.
        value = 7.0 if i % 3 == 0 else round(rng.gauss(5, 4), 2)
        data.append(("a" if i % 10 else "b", value if i % 97 else None))
    pdf = pd.DataFrame(data, columns=["g", "v"])
    return spark.createDataFrame(data, "g string, v double").repartition(7), pdf


def test_running_counts(skewed):
    df, pdf = skewed
    want = []
    for g, part in pdf.dropna().groupby("g"):
        sizes = part.groupby("v").size().sort_index()
        before = sizes.cumsum() - sizes
        want += [
            (g, float(v) + 0.0, int(n), int(b), int(sizes.sum()))
            for v, n, b in zip(sizes.index, sizes, before)
        ]
    assert rows(ordered.value_counts(df, "v", by=["g"])) == sorted(want, key=repr)


def test_same_result_for_any_partitioning(spark, skewed):
    df, _ = skewed
    first = rows(ordered.value_counts(df, "v", by=["g"]))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows(ordered.value_counts(df.repartition(3), "v", by=["g"])) == first
        ranked = ordered.running_rank(df.dropna().distinct(), [F.col("v"), F.col("g")])
        got = [r["rank"] for r in ranked.orderBy("v", "g").collect()]
        assert got == list(range(1, len(got) + 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_quantiles(skewed):
    df, pdf = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in ordered.quantiles(df, "v", probs, by=["g"]).collect()}
    for g, part in pdf.dropna().groupby("g"):
        assert got[g].n == len(part)
        want = np.quantile(part["v"], probs)
        assert [got[g][f"q{i}"] for i in range(len(probs))] == pytest.approx(want, abs=1e-12)


def test_mid_ranks(skewed):
    df, pdf = skewed
    ranks = pdf.dropna().assign(r=lambda d: d["v"].rank()).groupby("v")["r"].first()
    got = {r.v: r.mid_rank for r in ordered.mid_ranks(df, "v").collect()}
    assert got == pytest.approx(ranks.to_dict())


def test_decile_bins_follow_value_ranges(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=997), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.v: r.bin_no for r in ordered.quantile_bins(df, "v").collect()}
    cut = pd.qcut(pd.Series(values), 10, labels=range(1, 11))
    assert all(got[float(v)] == b for v, b in zip(values, cut))


def test_deciles_with_heavy_ties_leave_bins_empty(spark):
    data = [(0.0, i % 2 == 0, float(i % 3)) for i in range(300)] + [(1.0, True, 1.0)] * 10
    df = spark.createDataFrame(data, "u double, t boolean, y double")
    got = uplift.uplift_deciles(df, "u", "y", "t").collect()
    assert len(got) == 10 and sum(r.n_bin for r in got) == 310
    assert [r.uplift_decile for r in got] == [
        "D9", "D8", "D7", "D6", "D5", "D4", "D3", "D2", "D10", "D1"
    ]
    empty = [r for r in got if r.n_bin == 0]
    assert empty and all(r.obs_effect is None for r in empty)
    assert sum(r.n_treat + r.n_ctrl for r in got) == 310


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert ordered.value_counts(df, "v", by=["g"]).count() == 0
    assert ordered.quantiles(df, "v", [0.5], by=["g"]).count() == 0


def test_quantiles_of_values_of_any_size(spark):
    """Signs, zeros, subnormal and huge values, infinities, ties that hold most rows; no ordering of rows."""
    rng = np.random.default_rng(2)
    values = np.concatenate([
        rng.normal(size=400), 10.0 ** rng.uniform(-320, 300, 300) * rng.choice([-1, 1], 300), np.zeros(500), [-0.0] * 20,
        [1.5] * 900, rng.integers(-5, 5, 200), 1 + rng.random(300) * 1e-12, [np.inf, -np.inf, 5e-324, -5e-324],
    ])
    rng.shuffle(values)
    df = spark.createDataFrame([(float(v), None if i % 3 else "g") for i, v in enumerate(values)], "v double, g string").repartition(4)
    probs = [0.0, 0.01, 0.2, 0.25, 0.5, 0.61, 0.75, 0.99, 1.0]
    for by, parts in (([], {None: values}), (["g"], {g: values[[(i % 3 == 0) == (g == "g") for i in range(len(values))]] for g in ("g", None)})):
        found = ordered.quantiles(df, "v", probs, by=by)
        plan = found._jdf.queryExecution().toString()
        assert "rangepartitioning" not in plan and "checkpoint" not in plan.lower()
        for r in found.collect():
            part = np.sort(parts[r.g if by else None])
            assert r.n == len(part)
            for i, p in enumerate(probs):
                at = (len(part) - 1) * p
                low, high = part[int(at)], part[min(int(at) + 1, len(part) - 1)]
                want = low + (high - low) * (at - int(at)) if low != high else low
                assert r[f"q{i}"] == want or np.isnan(r[f"q{i}"]) and not np.isfinite(low * high), (p, r[f"q{i}"], want)
