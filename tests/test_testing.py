"""Reports on tiny frames: empty arms, constants, ties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import aggregates, testing


def frame(spark, data):
    return spark.createDataFrame(data, "arm boolean, hit boolean, v double, w double")


def test_constant_rate_has_no_chi2(spark):
    df = frame(spark, [(i % 2 == 0, True, float(i), 1.0) for i in range(40)])
    got = testing.ab_report(df, "arm", ["hit"], ["v"]).orderBy("metric").collect()
    assert got[0].metric == "hit_rate" and got[0].stat is None and got[0].p_value is None
    assert got[0].significant is False and got[0].treatment_mean == 1.0
    assert got[1].metric == "v_mean" and got[1].n_treat == 20


def test_empty_arm(spark):
    df = frame(spark, [(True, i % 2 == 0, float(i), 1.0) for i in range(10)])
    got = {r.metric: r for r in testing.ab_report(df, "arm", ["hit"], ["v"]).collect()}
    assert got["hit_rate"].stat is None and got["v_mean"].stat is None
    assert got["v_mean"].mw_u is None and got["v_mean"].mw_p is None
    assert got["v_mean"].control_mean is None
    assert got["v_mean"].n_control == 0


def test_all_tied_values_show_no_difference(spark):
    df = frame(spark, [(i % 2 == 0, True, 3.0, 1.0) for i in range(20)])
    got = testing.rank_sums(df, "arm", ["v"]).first()
    assert got.mw_u == 50.0 and got.mw_p == 1.0


def test_rank_sum_against_pairs(spark):
    rng = np.random.default_rng(1)
    t, c = np.round(rng.normal(1, 2, 83), 1), np.round(rng.normal(0, 2, 71), 1)
    data = [(True, None, float(v), None) for v in t] + [(False, None, float(v), None) for v in c]
    data += [(True, None, None, None), (None, None, 5.0, None), (False, None, math.nan, None)]
    got = testing.rank_sums(frame(spark, data), "arm", ["v"]).first()
    u = (t[:, None] > c[None, :]).sum() + 0.5 * (t[:, None] == c[None, :]).sum()
    assert got.mw_u == u
    flipped = frame(spark, data).withColumn("arm", ~F.col("arm"))
    other = testing.rank_sums(flipped, "arm", ["v"]).first()
    assert got.mw_u + other.mw_u == len(t) * len(c)
    assert got.mw_p == pytest.approx(other.mw_p)


def test_welch_interval(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(0, 1, 50), rng.normal(0.5, 2, 60)
    data = [(True, None, float(v), None) for v in x] + [(False, None, float(v), None) for v in y]
    got = testing.welch_tests(frame(spark, data), "arm", ["v"]).first()
    se = math.sqrt(x.var(ddof=1) / 50 + y.var(ddof=1) / 60)
    assert got.t_stat == pytest.approx((x.mean() - y.mean()) / se)
    assert got.ci95_high - got.ci95_low == pytest.approx(2 * 1.959963984540054 * se)


def test_dominant_category_ties_and_unknown(spark):
    data = [("a", "y"), ("a", "x"), ("b", "y"), ("b", "y"), ("b", "x"), ("c", None)]
    df = spark.createDataFrame(data, "vehicle_id string, maintenance_type string").withColumns(
        {"downtime_hours": F.lit(1.0), "breakdown_event": F.lit(False)}
    )
    got = {r.vehicle_id: r for r in aggregates.vehicle_summary(df).collect()}
    assert [got[k].maintenance_type_mode for k in "abc"] == ["x", "y", None]
    joined = {r.vehicle_id: r for r in aggregates.with_dominant_category(df).collect()}
    assert {k: tuple(sorted(map(str, v))) for k, v in joined.items()} == {
        k: tuple(sorted(map(str, v))) for k, v in got.items()
    }


def test_route_report_sign(spark):
    data = [(True, 1.0 + i * 0.01) for i in range(30)] + [(False, 2.0 + i * 0.01) for i in range(30)]
    df = spark.createDataFrame(data, "optimized_route_flag boolean, fuel_consumption_liters double")
    got = testing.route_report(df, with_median=True).orderBy("optimized_route_flag").collect()
    assert got[0].t_stat > 0 and got[0].significant
    assert got[1].median_fuel == pytest.approx(1.145)
