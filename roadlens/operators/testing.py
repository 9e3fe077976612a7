"""Two-sample tests: every metric of a report comes out of one aggregate pass per grain, and the
closed forms run on the resulting handful of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import tails
from roadlens.functions.derive import risky_event
from roadlens.operators.aggregates import contingency, long_values, vehicle_summary
from roadlens.operators.ordered import quantiles, value_counts
from roadlens.session import durable

# Fixed value: 97.5 % point of the standard normal.
Z_95 = 1.959963984540054


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _null_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


MOMENTS = tuple(f"{stat}_{side}" for side in "tc" for stat in "nmv")
CELLS = ("t1", "t0", "c1", "c0")

# ---------------------------------------------------------------- closed forms


def z_test(p1: Column, n1: Column, p0: Column, n0: Column) -> Column:
    """Two-proportion z with pooled standard error."""
    pooled = _ratio(p1 * n1 + p0 * n0, n1 + n0)
    se = F.sqrt(pooled * (1 - pooled) * (_ratio(F.lit(1), n1) + _ratio(F.lit(1), n0)))
    return F.try_divide(p1 - p0, se)


def yates_chi2(t1: Column, t0: Column, c1: Column, c0: Column) -> Column:
    """2x2 chi-square with continuity correction; NULL unless both rows and columns occur."""
    total = (t1 + t0 + c1 + c0).cast("double")
    cells = [
        (t1, t1 + t0, t1 + c1), (t0, t1 + t0, t0 + c0),
        (c1, c1 + c0, t1 + c1), (c0, c1 + c0, t0 + c0),
    ]
    stat = F.lit(0.0)
    for seen, row, column in cells:
        expected = _ratio(row.cast("double") * column.cast("double"), total)
        gap = F.abs(seen - expected)
        gap = gap - F.least(F.lit(0.5), gap)
        stat = stat + F.try_divide(gap * gap, expected)
    return stat


def welch(m1: Column, v1: Column, n1: Column, m0: Column, v0: Column, n0: Column):
    """(t, Satterthwaite df) from means, sample variances and counts."""
    e1, e0 = _ratio(v1, n1), _ratio(v0, n0)
    t = F.try_divide(m1 - m0, F.sqrt(e1 + e0))
    df = F.try_divide(
        (e1 + e0) * (e1 + e0), _ratio(e1 * e1, n1 - 1) + _ratio(e0 * e0, n0 - 1)
    )
    return t, df


def mean_diff_ci(m1: Column, v1: Column, n1: Column, m0: Column, v0: Column, n0: Column):
    """(low, high) of the 95 % normal interval of m1 - m0."""
    half = F.lit(Z_95) * F.sqrt(_ratio(v1, n1) + _ratio(v0, n0))
    return (m1 - m0) - half, (m1 - m0) + half


# ---------------------------------------------------------------- aggregate passes


def arm_records(
    df: DataFrame, arm: str, means: Sequence[str], rates: Sequence[str] = ()
) -> DataFrame:
    """One row per metric with both arms side by side, from one pass over the table.

    ``means`` get n, m (mean) and v (sample variance) per arm t and c; ``rates`` get the cells
    t1, t0, c1, c0 of event against arm. ``rows_t`` and ``rows_c`` are the arm sizes. The pass
    groups by the arm itself, so each task hands on one row per arm.
    """
    treated = F.col(arm).cast("boolean")
    known = df.filter(treated.isNotNull())
    aggs = [F.count(F.lit(1)).alias("arm_rows")]
    for e in rates:
        hit = F.col(e).cast("boolean")
        aggs += [F.count_if(hit).alias(f"hit_{e}"), F.count_if(~hit).alias(f"miss_{e}")]
    for m in means:
        value = _null_nan(F.col(m).cast("double"))
        aggs += [
            F.count(value).alias(f"n_{m}"),
            F.avg(value).alias(f"m_{m}"),
            F.var_samp(value).alias(f"v_{m}"),
        ]
    per_arm = known.groupBy(treated.alias("treated")).agg(*aggs)

    none = {kind: F.lit(None).cast(kind) for kind in ("bigint", "double")}

    def record(name: str, hit=None, miss=None, n=None, m=None, v=None) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            *[(none["bigint"] if c is None else F.col(c)).alias(a)
              for a, c in (("hit", hit), ("miss", miss), ("n", n))],
            *[(none["double"] if c is None else F.col(c)).alias(a) for a, c in (("m", m), ("v", v))],
        )

    records = [record(e, hit=f"hit_{e}", miss=f"miss_{e}") for e in rates] + [
        record(m, n=f"n_{m}", m=f"m_{m}", v=f"v_{m}") for m in means
    ]
    long = per_arm.select("treated", "arm_rows", F.inline(F.array(*records)))

    def side(column: str, is_treated: bool) -> Column:
        chosen = F.col("treated") if is_treated else ~F.col("treated")
        return F.max(F.when(chosen, F.col(column)))

    def size(column: str, is_treated: bool) -> Column:
        return F.coalesce(side(column, is_treated), F.lit(0).cast("bigint"))

    # An arm without rows counts zero; a metric that is no rate has no cells.
    def cell(column: str, is_treated: bool) -> Column:
        return F.when(F.count("hit") > 0, size(column, is_treated))

    def number(is_treated: bool) -> Column:
        return F.when(F.count("n") > 0, size("n", is_treated))

    return long.groupBy("metric").agg(
        size("arm_rows", True).alias("rows_t"), size("arm_rows", False).alias("rows_c"),
        cell("hit", True).alias("t1"), cell("miss", True).alias("t0"),
        cell("hit", False).alias("c1"), cell("miss", False).alias("c0"),
        number(True).alias("n_t"), side("m", True).alias("m_t"), side("v", True).alias("v_t"),
        number(False).alias("n_c"), side("m", False).alias("m_c"), side("v", False).alias("v_c"),
    )


def moments(df: DataFrame, arm: str, metrics: Sequence[str]) -> DataFrame:
    """metric, n_t, m_t, v_t, n_c, m_c, v_c and the arm sizes, from one pass over the table."""
    return arm_records(df, arm, metrics).select("rows_t", "rows_c", "metric", *MOMENTS)


def rank_sums(df: DataFrame, arm: str, metrics: Sequence[str]) -> DataFrame:
    """metric, mw_u, mw_p: Mann-Whitney U of the treated arm with its two-sided normal p
    (tie-corrected, continuity-corrected).

    Rows shrink to counts per (metric, value) before anything is ordered, so value-heavy metrics
    cost little; sums of squares of counts are kept in decimals, exact at any table size.
    """
    treated = F.col("treated")
    counted = value_counts(
        long_values(df, arm, metrics),
        "value",
        {"n_t": treated.cast("int"), "n_c": (~treated).cast("int")},
        by=["metric"],
    )

    def whole(c: Column) -> Column:
        return c.cast("decimal(20,0)")

    tied = whole(F.col("n_t") + F.col("n_c"))
    summed = counted.groupBy("metric").agg(
        F.max("total_n_t").alias("n1"),
        F.max("total_n_c").alias("n0"),
        F.sum(
            (whole(F.col("n_t")) * whole(2 * F.col("before_n_c") + F.col("n_c"))).cast(
                "decimal(38,0)"
            )
        ).alias("u2"),
        F.sum(((tied * tied).cast("decimal(38,0)") * tied - tied).cast("decimal(38,0)")).alias(
            "ties"
        ),
    )
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    n = n1 + n0
    u = F.when((n1 > 0) & (n0 > 0), F.col("u2").cast("double") / 2)
    spread = F.sqrt(
        n1 * n0 / 12 * ((n + 1) - F.try_divide(F.col("ties").cast("double"), n * (n - 1)))
    )
    upper = F.greatest(u, n1 * n0 - u)
    z = F.try_divide(upper - n1 * n0 / 2 - 0.5, spread)
    two_sided = F.when(z >= 0, tails.normal_p(z)).otherwise(F.lit(1.0))
    # No spread at all (every value tied) is no evidence: p is 1.
    p = F.when(u.isNotNull(), F.coalesce(two_sided, F.lit(1.0)))
    return summed.select("metric", u.alias("mw_u"), p.alias("mw_p"))


# ---------------------------------------------------------------- reports


def with_verdict(df: DataFrame, p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """Adds ``significant``; a test without a p-value shows nothing, so it is False."""
    return df.withColumn("significant", F.coalesce(F.col(p) < alpha, F.lit(False)))


def intervention_test(df: DataFrame, arm: str = "intervention_active") -> DataFrame:
    """Risky-event rate per arm with the pooled z-test; one row per arm."""
    treated, event = F.col(arm).cast("boolean"), risky_event()
    wide = df.agg(
        F.avg(F.when(treated, event)).alias("p1"),
        F.avg(F.when(~treated, event)).alias("p0"),
        F.count_if(treated).alias("n1"),
        F.count_if(~treated).alias("n0"),
    )
    p1, p0, n1, n0 = (F.col(c) for c in ("p1", "p0", "n1", "n0"))
    tested = wide.withColumn("z_score", z_test(p1, n1, p0, n0)).withColumn(
        "p_value", tails.normal_p(F.col("z_score"))
    )
    arms = F.array(
        F.struct(F.lit("intervention").alias("group"), p1.alias("avg_risky_rate"), n1.alias("n")),
        F.struct(F.lit("control").alias("group"), p0.alias("avg_risky_rate"), n0.alias("n")),
    )
    return tested.select(
        F.inline(arms), (p1 - p0).alias("diff"), "z_score", "p_value"
    )


def ab_report(
    df: DataFrame, arm: str, rates: Sequence[str], means: Sequence[str], alpha: float = 0.05
) -> DataFrame:
    """Yates chi-square rows for event rates, Welch rows with the rank test beside it for means.

    All cells and moments of both arms come from one pass; the rank test adds one more over the
    mean metrics only.
    """
    long = arm_records(df, arm, means, rates)
    t1, t0, c1, c0 = (F.col(c) for c in CELLS)
    m1, v1, n1, m0, v0, n0 = (F.col(f"{s}_{a}") for a in "tc" for s in "mvn")
    is_rate = F.col("metric").isin(list(rates))
    t, freedom = welch(m1, v1, n1, m0, v0, n0)
    tested = long.withColumns(
        {
            "treatment_mean": F.when(is_rate, _ratio(t1, t1 + t0)).otherwise(m1),
            "control_mean": F.when(is_rate, _ratio(c1, c1 + c0)).otherwise(m0),
            "stat": F.when(is_rate, yates_chi2(t1, t0, c1, c0)).otherwise(t),
            "_df": F.when(~is_rate, freedom),
        }
    )
    ranked = rank_sums(df, arm, means)
    p = F.when(is_rate, tails.chi2_p(F.when(is_rate, F.col("stat")))).otherwise(
        tails.student_p(F.col("stat"), F.col("_df"))
    )
    report = tested.withColumn("p_value", p).join(ranked, "metric", "left").select(
        F.concat("metric", F.when(is_rate, "_rate").otherwise("_mean")).alias("metric"),
        "treatment_mean",
        "control_mean",
        (F.col("treatment_mean") - F.col("control_mean")).alias("diff_t_minus_c"),
        F.when(is_rate, "chi2").otherwise("welch_t").alias("test"),
        "stat",
        "p_value",
        F.col("rows_t").alias("n_treat"),
        F.col("rows_c").alias("n_control"),
        "mw_u",
        "mw_p",
    )
    return with_verdict(report, alpha=alpha)


def rate_tests(df: DataFrame, arm: str, events: Sequence[str]) -> DataFrame:
    """Cells, chi-square and p per event."""
    t1, t0, c1, c0 = (F.col(c) for c in CELLS)
    tables = contingency(df, arm, events).withColumn("chi2", yates_chi2(t1, t0, c1, c0))
    return tables.withColumn("p_value", tails.chi2_p(F.col("chi2")))


def welch_tests(df: DataFrame, arm: str, metrics: Sequence[str]) -> DataFrame:
    """Moments per arm, Welch t with its df and p, and the 95 % interval, per metric."""
    m1, v1, n1, m0, v0, n0 = (F.col(f"{s}_{a}") for a in "tc" for s in "mvn")
    t, freedom = welch(m1, v1, n1, m0, v0, n0)
    low, high = mean_diff_ci(m1, v1, n1, m0, v0, n0)
    tested = moments(df, arm, metrics).withColumns(
        {"t_stat": t, "df": freedom, "ci95_low": low, "ci95_high": high}
    )
    return tested.withColumn("p_value", tails.student_p(F.col("t_stat"), F.col("df")))


def _grain_report(df: DataFrame, grain: str, metrics: dict[str, str]) -> DataFrame:
    """Welch, rank test and interval of predictive (A) minus scheduled (B)."""
    m1, v1, n1, m0, v0, n0 = (F.col(f"{s}_{a}") for a in "tc" for s in "mvn")
    t, freedom = welch(m1, v1, n1, m0, v0, n0)
    low, high = mean_diff_ci(m1, v1, n1, m0, v0, n0)
    columns = list(metrics)
    named = df.select(
        "is_predictive", *[F.col(c).cast("double").alias(metrics[c]) for c in columns]
    )
    tested = moments(named, "is_predictive", list(metrics.values())).withColumns(
        {"t_stat": t, "_df": freedom}
    )
    ranked = rank_sums(named, "is_predictive", list(metrics.values()))
    return tested.join(ranked, "metric", "left").select(
        F.lit(grain).alias("grain"),
        "metric",
        F.lit("predictive").alias("group_A"),
        F.lit("scheduled").alias("group_B"),
        m1.alias("A_mean"),
        m0.alias("B_mean"),
        (m1 - m0).alias("mean_diff_A_minus_B"),
        low.alias("ci95_low"),
        high.alias("ci95_high"),
        "t_stat",
        tails.student_p(F.col("t_stat"), F.col("_df")).alias("t_pvalue"),
        F.col("mw_u").alias("mannwhitney_u"),
        F.col("mw_p").alias("mw_pvalue"),
        F.col("rows_t").alias("n_A"),
        F.col("rows_c").alias("n_B"),
    )


def _predictive_arm(df: DataFrame, c: str) -> DataFrame:
    """Rows of the two compared maintenance types with the arm as a boolean."""
    kind = F.lower(F.col(c))
    return df.filter(kind.isin("predictive", "scheduled")).withColumn(
        "is_predictive", kind == "predictive"
    )


def maintenance_report(df: DataFrame) -> DataFrame:
    """Predictive against scheduled maintenance at vehicle and at record grain."""
    # Moments and ranks both read the vehicle rows; the trips behind them are read once.
    vehicles = _predictive_arm(durable(vehicle_summary(df)), "maintenance_type_mode")
    records = _predictive_arm(df, "maintenance_type").withColumn(
        "breakdown_event", F.col("breakdown_event").cast("boolean").cast("int")
    )
    return _grain_report(
        vehicles,
        "vehicle",
        {"mean_downtime": "mean_downtime_hours", "breakdown_rate": "breakdown_rate"},
    ).unionByName(
        _grain_report(
            records,
            "record",
            {"downtime_hours": "downtime_hours", "breakdown_event": "breakdown_event_rate"},
        )
    )


def savings_estimate(df: DataFrame) -> DataFrame:
    """Hours saved per record and per 1000 records by moving to predictive maintenance."""
    vehicles = durable(vehicle_summary(df))
    size = vehicles.agg(F.avg("n_records"))
    m1, v1, n1, m0, v0, n0 = (F.col(f"{s}_{a}") for a in "tc" for s in "mvn")
    low, high = mean_diff_ci(m1, v1, n1, m0, v0, n0)
    saved = F.greatest(F.lit(0.0), m0 - m1)
    arms = _predictive_arm(vehicles, "maintenance_type_mode")
    effect = moments(arms, "is_predictive", ["mean_downtime"]).select(
        saved.alias("hours_saved_per_vehicle_record"),
        (saved * 1000.0).alias("hours_saved_per_1000_records"),
        low.alias("ci95_low_on_A_minus_B"),
        high.alias("ci95_high_on_A_minus_B"),
    )
    return effect.select(size.scalar().alias("avg_records_per_vehicle"), "*")


def route_report(
    df: DataFrame,
    arm: str = "optimized_route_flag",
    value: str = "fuel_consumption_liters",
    with_median: bool = False,
) -> DataFrame:
    """Mean, spread and count per arm and the Welch test of control minus optimized."""
    known = df.filter(F.col(value).isNotNull() & F.col(arm).isNotNull())
    m1, v1, n1, m0, v0, n0 = (F.col(f"{s}_{a}") for a in "tc" for s in "mvn")
    t, freedom = welch(m0, v0, n0, m1, v1, n1)
    wide = moments(known, arm, [value]).withColumns({"t_stat": t, "_df": freedom})
    wide = wide.withColumn("p_value", tails.student_p(F.col("t_stat"), F.col("_df")))
    arms = F.array(
        *[
            F.struct(
                F.lit(flag).alias(arm), m.alias("avg_fuel"), F.sqrt(v).alias("std_fuel"),
                n.alias("count"),
            )
            for flag, m, v, n in ((False, m0, v0, n0), (True, m1, v1, n1))
        ]
    )
    report = wide.select(F.inline(arms), "t_stat", "p_value")
    if with_median:
        medians = quantiles(known, value, [0.5], by=[arm])
        report = report.join(medians.select(arm, F.col("q0").alias("median_fuel")), arm, "left")
    return with_verdict(report)


