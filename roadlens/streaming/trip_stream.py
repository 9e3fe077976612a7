"""Streaming job: JSON messages to the processed trip table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.functions.derive import stream_transform
from roadlens.plans import run_metrics
from roadlens.sources.messages import decode_trips
from roadlens.streaming import manifest

EPOCH = "epoch_id"
PREVIEW = ("vehicle_id", "timestamp", "speed", "event_type")


def processed(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Decode, add efficiency, keep moving records; the same for a batch and a stream."""
    return stream_transform(decode_trips(messages, keep))


def epoch_writer(
    path: str,
    metrics_path: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch into the folder of its epoch.

    A replayed epoch replaces its folder, so a restart neither loses nor repeats rows; a failed
    write stops the query. The row count comes from the write itself. ``on_batch`` is a user
    function called with the stored batch.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        started = time.monotonic()
        counted, seen = run_metrics.counted(batch, f"epoch_{epoch}")
        folder = f"{path}/{EPOCH}={epoch}"
        counted.write.mode("overwrite").parquet(folder)
        if metrics_path:
            values = {
                "epoch": epoch,
                "rows": seen.get["rows"],
                "duration_seconds": time.monotonic() - started,
            }
            run_metrics.metric_rows(spark, f"stream_{epoch}", values).coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{metrics_path}/{EPOCH}={epoch}")
        if on_batch is not None:
            on_batch(spark.read.schema(batch.schema).parquet(folder), epoch)

    return write


def dated_writer(
    path: str, compact_every: int = 100, ts: str = "timestamp"
) -> Callable[[DataFrame, int], None]:
    """Writes micro-batches into a table split by day with a manifest (``streaming.manifest``), which is
    compacted every ``compact_every`` batches. A replayed batch is not written twice."""

    def write(batch: DataFrame, epoch: int) -> None:
        if manifest.write_batch(batch, epoch, path, F.to_date(ts)) and (epoch + 1) % compact_every == 0:
            manifest.compact(batch.sparkSession, path, batch.schema)

    return write


def start(
    rows: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Starts the append query; ``interval=None`` processes what is there and stops."""
    out = rows.writeStream.foreachBatch(writer).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    out = out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)
    return out.start()


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows of the stream."""
    return spark.read.parquet(path).drop(EPOCH)


def preview(batch: DataFrame, k: int = 3) -> DataFrame:
    return batch.select(*PREVIEW).limit(k)
