"""Splits, resampling, neighbours and oversampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from roadlens.operators import neighbors, oversample, sampling, weighting


def test_stratified_split_is_exact_and_order_free(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 7 == 0).alias("s"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 2).alias("z"),
    )
    got = sampling.stratified_split(df, "k", 0.25, ["s", "z"])
    for r in got.groupBy("s", "z").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")
    ).collect():
        assert r.t == int(r.n * 0.25 + 0.5)
    shuffled = sampling.stratified_split(df.orderBy(F.desc("k")).repartition(9), "k", 0.25, ["s", "z"])
    assert rows(got) == rows(shuffled)


def test_split_keeps_copies_of_a_key_together(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("k")
    )
    sides = sampling.stratified_split(df, "k", 0.3).filter("k = 'same'").select("is_test").distinct()
    assert sides.count() == 1


def test_bootstrap_agrees_with_the_analytic_interval(spark):
    rng = np.random.default_rng(7)
    n = 4000
    data = [
        (str(i), bool(i % 2), 1.0, float(v)) for i, v in enumerate(rng.normal(0, 1, n) + 0.3)
    ]
    df = spark.createDataFrame(data, "k string, t boolean, weight double, y double")
    replicated = weighting.bootstrap_effects(df, "t", ["y"], "k", 200)
    got = weighting.bootstrap_interval(replicated).first()
    y = np.array([d[3] for d in data])
    t = np.array([d[1] for d in data])
    diff = y[t].mean() - y[~t].mean()
    se = np.sqrt(y[t].var(ddof=1) / t.sum() + y[~t].var(ddof=1) / (~t).sum())
    assert got.ci95_low == pytest.approx(diff - 1.96 * se, abs=0.4 * se)
    assert got.ci95_high == pytest.approx(diff + 1.96 * se, abs=0.4 * se)
    again = weighting.bootstrap_interval(
        weighting.bootstrap_effects(df.repartition(11), "t", ["y"], "k", 200)
    ).first()
    assert again.ci95_low == pytest.approx(got.ci95_low, abs=1e-12)


def brute(points: np.ndarray, k: int) -> np.ndarray:
    gaps = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    return np.sort(gaps, axis=1)[:, :k]


@pytest.mark.parametrize("shape", ["spread", "copies", "line"])
def test_neighbours_equal_brute_force(spark, shape):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(600, 4)) * [1, 10, 0.1, 3]
    if shape == "copies":
        points[::3] = points[0]
    if shape == "line":
        points[:, 1:] = 0
    data = [(f"p{i}", *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(data, "k string, a double, b double, c double, d double")
    got = neighbors.nearest_neighbours(df, "k", ["a", "b", "c", "d"], 5, ring_rows=40)
    found = np.full((len(points), 5), np.nan)
    for r in got.collect():
        assert r.key != r.neighbour
        found[int(r.key[1:]), r.place - 1] = r.distance
    assert np.allclose(found, brute(points, 5))


def test_oversampling_balances_and_stays_between_parents(spark):
    rng = np.random.default_rng(4)
    data = [(f"m{i}", float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(size=(503, 2)))]
    rare = rng.normal(3, 1, size=(41, 2))
    data += [(f"r{i}", float(a), float(b), 1) for i, (a, b) in enumerate(rare)]
    df = spark.createDataFrame(data, "k string, a double, b double, label int")
    made = oversample.oversample(df, "k", ["a", "b"], "label", 5)
    sizes = {r.label: r.n for r in made.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {0: 503, 1: 503}
    order = np.argsort(
        np.sqrt(((rare[:, None] - rare[None]) ** 2).sum(2)) + np.diag([np.inf] * 41), axis=1
    )[:, :5]
    fresh = made.filter("is_synthetic").collect()
    assert len({r.k for r in fresh}) == 462
    bases = {}
    for r in fresh:
        i = int(r.k.split("#")[0][1:])
        bases[i] = bases.get(i, 0) + 1
        x = np.array([r.a, r.b])
        on_segment = [
            np.linalg.norm(x - rare[i]) + np.linalg.norm(x - rare[j])
            - np.linalg.norm(rare[i] - rare[j]) < 1e-9
            for j in order[i]
        ]
        assert any(on_segment)
    assert set(bases.values()) <= {11, 12} and len(bases) == 41


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    got = {r.y: r.class_weight for r in sampling.class_weights(df, "y").distinct().collect()}
    assert got == {0: 8 / 12, 1: 2.0}


def test_rows_of_few_strata_and_classes_stay_on_all_tasks(spark):
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("k")
    ).withColumns({"s": F.when(F.length("k") < 9, "only"), "y": (F.length("k") > 0).cast("int")}).repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for marked in (sampling.stratified_split(df, "k", 0.25, ["s"]), sampling.class_weights(df, "y")):
            tasks = marked.groupBy(F.spark_partition_id()).agg(F.count(marked.columns[-1]).alias("n")).collect()
            assert len(tasks) == 4 and sum(t.n for t in tasks) == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
