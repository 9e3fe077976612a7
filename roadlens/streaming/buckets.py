"""Time-bucket tables kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WIDTH = {"hour": "1 hour", "day": "1 day"}


def bucket_stream(
    rows: DataFrame,
    unit: str,
    keys: Sequence[str],
    aggs: Sequence[Column],
    late: str = "1 hour",
    ts: str = "timestamp",
) -> DataFrame:
    """Aggregates per tumbling bucket and keys; rows later than ``late`` are dropped.

    State holds open buckets only and is spread by (bucket, keys).
    """
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return (
        timed.groupBy(F.window(ts, WIDTH[unit]).alias("_w"), *keys)
        .agg(*aggs)
        .select(F.col("_w.start").alias("time"), *keys, *_names(aggs, unit, rows, keys, ts))
    )


def _names(aggs: Sequence[Column], unit: str, rows: DataFrame, keys: Sequence[str], ts: str):
    shape = rows.withColumn(ts, F.col(ts).cast("timestamp")).groupBy(*keys).agg(*aggs)
    return [c for c in shape.columns if c not in keys]


def start_append(
    buckets: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Appends closed buckets to a Parquet folder, each exactly once."""
    out = buckets.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    out = out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)
    return out.start()
