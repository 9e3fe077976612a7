"""Dashboard tables over the processed trip table. Every panel takes an optional time range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.derive import label_for
from roadlens.functions.rules import time_range

TS = "timestamp"


def _rush_status() -> Column:
    return label_for("rush_hour", "Rush Hour", "Non-Rush Hour").alias("rush_status")


def driver_labels(df: DataFrame, start=None, end=None, risky_value: bool = True) -> DataFrame:
    """Labelled events per driver, most first.

    The stored label is True for SAFE trips; the panel counts True. ``risky_value=False`` counts
    the trips that are labelled risky.
    """
    keys = ["driver_id", "driver_experience_years", "driver_training"]
    counted = time_range(df, start, end).groupBy(*keys).agg(
        F.count_if(F.col("risk_label") == risky_value).alias("total_risk_events")
    )
    return counted.orderBy(F.desc("total_risk_events"), *keys)


def hourly_labels(df: DataFrame, start=None, end=None, risky_value: bool = True) -> DataFrame:
    return (
        time_range(df, start, end)
        .groupBy(F.date_trunc("hour", TS).alias("time"))
        .agg(F.count_if(F.col("risk_label") == risky_value).alias("risk_events"))
        .orderBy("time")
    )


def driving_flags(df: DataFrame, start=None, end=None) -> DataFrame:
    """Harsh acceleration and lane change per record in time order."""
    return (
        time_range(df, start, end)
        .select(
            F.col(TS).alias("time"), "driver_id", "harsh_acceleration_event", "lane_change_event"
        )
        .orderBy("time")
    )


def fuel_by_vehicle_type(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        time_range(df, start, end)
        .groupBy("vehicle_type")
        .agg(
            F.avg("fuel_consumption_liters").alias("avg_fuel_consumption"),
            F.avg("fuel_efficiency_l_per_km").alias("avg_fuel_efficiency"),
            F.max(TS).alias("last_recorded"),
        )
        .orderBy("vehicle_type")
    )


def average_efficiency(df: DataFrame, start=None, end=None) -> DataFrame:
    return time_range(df, start, end).agg(
        F.avg("fuel_efficiency_l_per_km").alias("avg_fuel_efficiency")
    )


def bucket_summary(
    df: DataFrame, unit: str, keys: Sequence[str], aggs: Sequence[Column], start=None, end=None
) -> DataFrame:
    """Aggregates per time bucket (``hour``, ``day``) and keys, in time order."""
    return (
        time_range(df, start, end)
        .groupBy(F.date_trunc(unit, TS).alias("time"), *keys)
        .agg(*aggs)
        .orderBy("time", *keys)
    )


def hourly_fuel(df: DataFrame, start=None, end=None) -> DataFrame:
    mean = F.avg("fuel_consumption_liters").alias("avg_fuel_consumption")
    return bucket_summary(df, "hour", ["vehicle_type"], [mean], start, end)


def bucket_counts(df: DataFrame, unit: str, key: str, start=None, end=None) -> DataFrame:
    return bucket_summary(df, unit, [key], [F.count(F.lit(1)).alias("count")], start, end)


def daily_maintenance(df: DataFrame, start=None, end=None) -> DataFrame:
    return bucket_counts(df, "day", "maintenance_type", start, end)


def daily_road_types(df: DataFrame, start=None, end=None) -> DataFrame:
    return bucket_counts(df, "day", "road_type", start, end)


def hourly_traffic(df: DataFrame, start=None, end=None) -> DataFrame:
    return bucket_counts(df, "hour", "traffic_density", start, end)


def latest_breakdowns(df: DataFrame, start=None, end=None, k: int = 100) -> DataFrame:
    """The ``k`` latest breakdowns; ties in time are ordered by vehicle and the other columns."""
    return (
        time_range(df, start, end)
        .filter("breakdown_event")
        .select(
            TS, "vehicle_id", "maintenance_type", "downtime_hours", "maintenance_cost_usd",
            "breakdown_event",
        )
        .orderBy(F.desc(TS), "vehicle_id", "downtime_hours", "maintenance_cost_usd")
        .limit(k)
    )


def downtime_series(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        time_range(df, start, end)
        .select(F.col(TS).alias("time"), "downtime_hours", "maintenance_cost_usd")
        .orderBy("time")
    )


def event_counts_by_time(df: DataFrame, start=None, end=None) -> DataFrame:
    """Braking and collision counts per exact time, latest first."""
    return (
        time_range(df, start, end)
        .groupBy(F.col(TS).alias("time"))
        .agg(
            F.count_if("braking_event").alias("braking_events"),
            F.count_if("collision_alert").alias("collision_alerts"),
        )
        .orderBy(F.desc("time"))
    )


def rush_counts(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        time_range(df, start, end)
        .groupBy(_rush_status())
        .agg(F.count(F.lit(1)).alias("count"))
    )


def vehicle_activity(df: DataFrame, start=None, end=None) -> DataFrame:
    """Time, vehicle, speed and rush label, latest first; also the activity series."""
    return (
        time_range(df, start, end)
        .select(F.col(TS).alias("time"), "vehicle_id", "speed", _rush_status())
        .orderBy(F.desc("time"))
    )
