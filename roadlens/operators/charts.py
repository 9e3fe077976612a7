"""The numbers behind the figures: histograms, density curves, boxes, bars."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.operators.ordered import quantiles


def _known(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).withColumn("_v", v)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins included."""
    known = _known(df, value).select("_v")
    span = known.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    share = F.try_divide(F.col("_v") - F.col("s.lo"), F.col("s.hi") - F.col("s.lo"))
    number = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    counted = known.withColumn("s", span).groupBy(number.cast("int").alias("bin_no")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin_no"))
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    return (
        every.join(counted, "bin_no", "left")
        .withColumn("s", span)
        .select(
            "bin_no",
            (F.col("s.lo") + F.col("bin_no") * width).alias("bin_start"),
            (F.col("s.lo") + (F.col("bin_no") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        )
    )


def density(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on an even grid from minimum to maximum.

    Equal values are counted first; every distinct value then adds its kernel to the grid inside
    the scan stage, and only grid sums are shuffled. Exact, no pre-binning.
    """
    known = _known(df, value).select("_v")
    shape = known.agg(
        F.struct(
            F.min("_v").alias("lo"),
            F.max("_v").alias("hi"),
            F.count("_v").cast("double").alias("n"),
            (F.stddev_samp("_v") * F.pow(F.count("_v").cast("double"), F.lit(-0.2))).alias("h"),
        )
    ).scalar()
    counted = known.groupBy("_v").agg(F.count(F.lit(1)).alias("k")).withColumn("s", shape)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    x = F.col("s.lo") + F.col("point") * ((F.col("s.hi") - F.col("s.lo")) / (points - 1))
    kernel = F.exp(-0.5 * F.pow(F.try_divide(F.col("x") - F.col("_v"), F.col("s.h")), F.lit(2)))
    spread = counted.select("_v", "k", "s", grid).withColumn("x", x)
    return spread.groupBy("point").agg(
        F.max("x").alias("x"),
        F.try_divide(
            F.sum(F.col("k") * kernel), F.max(F.col("s.n") * F.col("s.h")) * math.sqrt(2 * math.pi)
        ).alias("density"),
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: quartiles, whiskers at the last value within 1.5 IQR, number of outliers."""
    known = _known(df.filter(F.col(group).isNotNull()), value).select(group, "_v")
    boxes = quantiles(known, "_v", [0.25, 0.5, 0.75], by=[group]).select(
        group, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"), "n"
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    # Values are counted before the join, so a group that holds most rows stays small.
    counted = known.groupBy(group, "_v").agg(F.count(F.lit(1)).alias("k"))
    return (
        counted.join(boxes, group)
        .groupBy(group, "q1", "median", "q3", "n")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("k"))).alias("n_outliers"),
        )
    )


def category_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def group_bars(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """The bars of a figure: per group and value column its mean, and the half width of the mean's 95 %
    interval as the whisker. NULL groups have no bar; a group of one row has no whisker."""
    numbers = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in values}
    known = df.filter(F.col(group).isNotNull())
    wide = known.groupBy(group).agg(
        *[
            F.struct(F.lit(v).alias("metric"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")).alias(f"_{i}")
            for i, (v, x) in enumerate(numbers.items())
        ]
    )
    bars = wide.select(group, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(values))])))
    whisker = F.try_divide(F.lit(1.959963984540054) * F.col("sd"), F.sqrt(F.col("n").cast("double")))
    return bars.select(group, "metric", "mean", whisker.alias("whisker"), "n")


def decile_line(deciles: DataFrame, effect: str = "obs_effect") -> DataFrame:
    """The line of observed effect over deciles, highest uplift first, with the marks' weights and the
    level of the whole as a reference."""
    size = F.sum("n_bin").over(Window.partitionBy(F.lit(0)))
    level = F.sum(F.col(effect) * F.col("n_bin")).over(Window.partitionBy(F.lit(0)))
    return deciles.select(
        (F.max("bin_no").over(Window.partitionBy(F.lit(0))) - F.col("bin_no") + 1).alias("position"), "uplift_decile",
        F.col(effect).alias("y"), F.try_divide(F.col("n_bin"), size).alias("weight"), F.try_divide(level, size).alias("level"),
    ).orderBy("position")


def predicted_against_actual(
    df: DataFrame, actual: str, predicted: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Every (actual, predicted) pair and the ends of the identity line."""
    pairs = df.select(*keep, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
    ends = pairs.agg(F.struct(F.min("actual").alias("lo"), F.max("actual").alias("hi"))).scalar()
    return pairs.withColumn("s", ends).select(
        *keep, "actual", "predicted", F.col("s.lo").alias("line_from"), F.col("s.hi").alias("line_to")
    )
