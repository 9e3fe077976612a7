"""Live panels: time buckets kept up to date while they are open.

The stream's aggregate runs in update mode, so every micro-batch gives the buckets that changed, with their
new values. They are added to a table with a manifest, as versions of their bucket; a reader takes the
newest version of each, and a compaction keeps that one alone. Buckets are small rows: a month of them is one
folder. State holds the buckets that may still change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlens.streaming import manifest
from roadlens.streaming.buckets import bucket_stream

VERSION = "version"


@dataclass(frozen=True)
class LivePanel:
    """A panel by time bucket (``hour`` or ``day``) and keys; ``aggs`` are named aggregates."""

    unit: str
    keys: tuple[str, ...]
    aggs: tuple[Column, ...]

    def stream(self, rows: DataFrame, late: str) -> DataFrame:
        return bucket_stream(rows, self.unit, self.keys, self.aggs, late)


def _count() -> tuple[Column, ...]:
    return (F.count(F.lit(1)).alias("count"),)


def panels(risky_value: bool = True) -> dict[str, LivePanel]:
    """The five bucketed dashboard panels."""
    labels = F.count_if(F.col("risk_label") == risky_value).alias("risk_events")
    return {
        "hourly_labels": LivePanel("hour", (), (labels,)),
        "hourly_fuel": LivePanel("hour", ("vehicle_type",), (F.avg("fuel_consumption_liters").alias("avg_fuel_consumption"),)),
        "daily_maintenance": LivePanel("day", ("maintenance_type",), _count()),
        "daily_road_types": LivePanel("day", ("road_type",), _count()),
        "hourly_traffic": LivePanel("hour", ("traffic_density",), _count()),
    }


def versioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])


def start(
    panel: LivePanel, rows: DataFrame, path: str, checkpoint: str, late: str = "1 hour", interval: str | None = "5 seconds",
    compact_every: int = 100,
) -> StreamingQuery:
    """Keeps the panel's table at ``path`` up to date from the stream ``rows``. Rows later than ``late`` are
    dropped; ``interval=None`` processes what is there and stops. Versions are times of writing, not epochs, so
    that a query with a new checkpoint goes on from the old table."""
    buckets = panel.stream(rows, late)
    schema = versioned(buckets.schema)

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        number, _ = manifest.Manifest(spark, path).read()
        stamped = batch.withColumn(VERSION, F.lit(number + 1).cast("long"))
        if manifest.write_batch(stamped, epoch, path, F.trunc("time", "month")) and (epoch + 1) % compact_every == 0:
            compact(panel, spark, path, schema)

    out = buckets.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    out = out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)
    return out.start()


def newest(panel: LivePanel, rows: DataFrame, *more: str) -> DataFrame:
    """The newest version of every bucket."""
    keys = ["time", *panel.keys, *more]
    values = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*values), VERSION).alias("newest")
    return rows.groupBy(*keys).agg(best).select(*keys, "newest.*")


def read(
    panel: LivePanel, spark: SparkSession, path: str, schema: T.StructType, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The panel as it stands, in time order, for the days between two days. ``schema`` is that of ``stream``."""
    rows = manifest.read(spark, path, versioned(schema), start and start.replace(day=1), end)
    day = F.to_date("time")
    rows = rows.filter(day >= F.lit(start)) if start else rows
    rows = rows.filter(day <= F.lit(end)) if end else rows
    return newest(panel, rows).drop(VERSION).orderBy("time", *panel.keys)


def compact(panel: LivePanel, spark: SparkSession, path: str, schema: T.StructType) -> None:
    """One folder with the newest versions alone."""
    manifest.compact(spark, path, schema, lambda rows: newest(panel, rows, manifest.DAY))
