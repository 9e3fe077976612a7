"""Grouped summaries of the trip table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.derive import flag


def event_summary(df: DataFrame) -> DataFrame:
    """Per event type: rows and mean speed, battery and efficiency."""
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.avg("speed").alias("avg_speed"),
        F.avg("sensor_battery").alias("avg_battery"),
        F.avg("fuel_efficiency_l_per_km").alias("avg_fuel_efficiency"),
    )


def _vehicle_category_parts(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy("vehicle_id", category).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("downtime_hours").alias("downtime"),
        F.count("downtime_hours").alias("n_downtime"),
        F.sum(flag("breakdown_event")).alias("breakdowns"),
        F.count("breakdown_event").alias("n_breakdown"),
    )


def _dominant(category: str) -> Column:
    known = F.col(category).isNotNull()
    return F.min_by(
        F.when(known, F.col(category)),
        F.when(known, F.struct(-F.col("n"), F.col(category))),
    )


def vehicle_summary(df: DataFrame, category: str = "maintenance_type") -> DataFrame:
    """Per vehicle: mean downtime, breakdown rate, rows and the dominant category.

    One scan and one wide shuffle: per (vehicle, category) parts first, vehicles from the parts.
    Vehicles without any known category keep a NULL one.
    """
    parts = _vehicle_category_parts(df, category)
    return parts.groupBy("vehicle_id").agg(
        (F.try_divide(F.sum("downtime"), F.sum("n_downtime"))).alias("mean_downtime"),
        (F.try_divide(F.sum("breakdowns"), F.sum("n_breakdown"))).alias("breakdown_rate"),
        F.sum("n").alias("n_records"),
        _dominant(category).alias(f"{category}_mode"),
    )


def vehicle_means(df: DataFrame) -> DataFrame:
    """Per vehicle: mean downtime, breakdown rate, rows."""
    return df.groupBy("vehicle_id").agg(
        F.avg("downtime_hours").alias("mean_downtime"),
        F.avg(flag("breakdown_event")).alias("breakdown_rate"),
        F.count(F.lit(1)).alias("n_records"),
    )


def dominant_category(
    df: DataFrame, key: str = "vehicle_id", category: str = "maintenance_type"
) -> DataFrame:
    """Most frequent category per key, ties to the first in text order."""
    counts = df.filter(F.col(category).isNotNull()).groupBy(key, category).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.groupBy(key).agg(_dominant(category).alias(f"{category}_mode"))


def with_dominant_category(df: DataFrame) -> DataFrame:
    """Vehicle means LEFT JOIN dominant category, the join form of ``vehicle_summary``."""
    return vehicle_means(df).join(dominant_category(df), "vehicle_id", "left")


def arm_summary(df: DataFrame, arm: str, value: str) -> DataFrame:
    """Per arm: mean, sample standard deviation and count of known values."""
    return df.groupBy(arm).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count(value).alias("count"),
    )


def uplift_by_key(df: DataFrame, key: str, uplifts: Sequence[str]) -> DataFrame:
    """Mean of each uplift column per key and the number of trips."""
    return df.groupBy(key).agg(
        *[F.avg(u).alias(f"mean_{u}") for u in uplifts], F.count(F.lit(1)).alias("n_trips")
    )


def event_rate(df: DataFrame, group: str, event: str) -> DataFrame:
    """Share of rows with the event per group; rows without a group are left out."""
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.avg(flag(event)).alias("event_rate"), F.count(F.lit(1)).alias("n"))
    )


def cell_counts(treated: Column, event: str) -> list[Column]:
    """The four counts of event against arm: t1, t0 (treated with, without), c1, c0."""
    hit = F.col(event).cast("boolean")
    return [
        F.count_if(treated & hit).alias(f"t1_{event}"),
        F.count_if(treated & ~hit).alias(f"t0_{event}"),
        F.count_if(~treated & hit).alias(f"c1_{event}"),
        F.count_if(~treated & ~hit).alias(f"c0_{event}"),
    ]


def contingency(df: DataFrame, arm: str, events: Sequence[str]) -> DataFrame:
    """2x2 counts of every event against the arm, all from one pass."""
    treated = F.col(arm).cast("boolean")
    wide = df.agg(*[a for e in events for a in cell_counts(treated, e)])
    rows = [
        F.struct(
            F.lit(e).alias("metric"),
            *[F.col(f"{cell}_{e}").alias(cell) for cell in ("t1", "t0", "c1", "c0")],
        )
        for e in events
    ]
    return wide.select(F.inline(F.array(*rows)))


def pooled_rate(df: DataFrame, arm: str, event: Column) -> DataFrame:
    """Event probability of both arms together and of each arm."""
    treated = F.col(arm).cast("boolean")
    return df.agg(
        F.avg(event).alias("pooled_rate"),
        F.avg(F.when(treated, event)).alias("treated_rate"),
        F.avg(F.when(~treated, event)).alias("control_rate"),
        F.count_if(treated).alias("n_treated"),
        F.count_if(~treated).alias("n_control"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values (NULL or NaN) per column, one pass."""
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        nan = F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False)
        return F.col(c).isNull() | nan

    wide = df.agg(*[F.count_if(missing(c)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "n_null")


def sanity_rates(df: DataFrame) -> DataFrame:
    """Event rates and mean fuel and downtime (2 digits) over the raw rows, one row."""
    events = ("collision_alert", "sensor_fault_event", "harsh_acceleration_event", "braking_event")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(flag(e)).alias(f"{e}_rate") for e in events],
        F.round(F.avg("fuel_consumption_liters"), 2).alias("mean_fuel"),
        F.round(F.avg("downtime_hours"), 2).alias("mean_downtime"),
    )


def long_values(df: DataFrame, arm: str, metrics: Sequence[str]) -> DataFrame:
    """One row per (metric, value, arm) with a known value and arm."""
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return (
        df.filter(F.col(arm).isNotNull())
        .select(F.col(arm).cast("boolean").alias("treated"), F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
