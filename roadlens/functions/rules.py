"""Row predicates: the validity rules of the fact table and the filters the analyses share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ranges.
LATITUDE = (40.4774, 40.9176)
LONGITUDE = (-74.2591, -73.7004)
SPEED = (0, 160)
BATTERY = (0, 100)


def in_gps_box(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).between(*LATITUDE) & F.col(lon).between(*LONGITUDE)


def speed_in_range(c: str = "speed") -> Column:
    return F.col(c).between(*SPEED)


def battery_in_range(c: str = "sensor_battery") -> Column:
    return F.col(c).between(*BATTERY)


def fuel_positive_or_unknown(c: str = "fuel_consumption_liters") -> Column:
    return F.col(c).isNull() | (F.col(c) > 0)


def downtime_not_negative(c: str = "downtime_hours") -> Column:
    return F.col(c).isNull() | (F.col(c) >= 0)


def moving(c: str = "speed") -> Column:
    return F.col(c) > 0


def same_category(c: str, name: str) -> Column:
    """Case-insensitive category match."""
    return F.lower(F.col(c)) == name.lower()


def validity_rules() -> dict[str, Column]:
    """Rule name -> predicate a valid row satisfies."""
    return {
        "gps_box": in_gps_box(),
        "speed_range": speed_in_range(),
        "battery_range": battery_in_range(),
        "fuel_positive_or_null": fuel_positive_or_unknown(),
        "downtime_not_negative": downtime_not_negative(),
    }


def keep_valid(df: DataFrame) -> DataFrame:
    """Rows that satisfy every rule; plain filters, so they reach the scan."""
    for predicate in validity_rules().values():
        df = df.filter(predicate)
    return df


def time_range(df: DataFrame, start=None, end=None, ts: str = "timestamp") -> DataFrame:
    """Closed time range; an open side is not filtered."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) <= F.lit(end).cast("timestamp"))
    return df


def recent(df: DataFrame, hours: int = 6, now=None, ts: str = "timestamp") -> DataFrame:
    """The dashboards' default range: the last ``hours`` before ``now`` (the clock if not given)."""
    end = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.filter(F.col(ts).between(end - F.expr(f"interval {int(hours)} hours"), end))


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value (neither NULL nor NaN) in all ``columns``."""
    return df.dropna(how="any", subset=list(columns))


def reject_report(df: DataFrame) -> DataFrame:
    """One row per rule: how many rows break it, out of how many, in one pass."""
    rules = validity_rules()
    broken = {name: ~F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}
    any_broken = None
    for flag in broken.values():
        any_broken = flag if any_broken is None else any_broken | flag
    broken["any_rule"] = any_broken
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        *[F.count_if(flag).alias(name) for name, flag in broken.items()],
    )
    return counts.unpivot(["rows_total"], list(broken), "rule", "rows_rejected")
