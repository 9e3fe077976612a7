"""Streams against batch, restarts, late rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_sinks import trips
from roadlens.operators import panels
from roadlens.sources import messages
from roadlens.streaming import buckets, trip_stream


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    feed, out, marks, metrics = (str(tmp_path / n) for n in ("feed", "out", "marks", "metrics"))
    raw = messages.encode(trips(spark, 60))
    raw.repartition(6).write.parquet(feed)
    seen = []

    def run():
        source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).parquet(feed)
        writer = trip_stream.epoch_writer(
            out, metrics, lambda b, e: seen.append((e, trip_stream.preview(b).count()))
        )
        query = trip_stream.start(trip_stream.processed(source), writer, marks, interval=None)
        query.awaitTermination()
        return rows(trip_stream.read_processed(spark, out))

    first = run()
    assert first == rows(trip_stream.processed(raw))
    assert len(first) == 59
    assert len(seen) > 1 and all(n <= 3 for _, n in seen)
    counts = spark.read.parquet(metrics).filter("metric = 'rows'")
    assert counts.agg(F.sum("value")).first()[0] == 59
    assert run() == first


def test_replayed_epoch_replaces_its_rows(spark, tmp_path):
    write = trip_stream.epoch_writer(str(tmp_path / "out"))
    write(trips(spark, 10), 0)
    write(trips(spark, 10), 0)
    write(trips(spark, 4), 1)
    assert trip_stream.read_processed(spark, str(tmp_path / "out")).count() == 14


def test_closed_buckets_equal_the_panel(spark, tmp_path):
    feed = str(tmp_path / "feed")
    trips(spark, 100).repartition(3).write.parquet(feed)
    source = spark.readStream.schema(trips(spark, 1).schema).parquet(feed)
    count = [F.count(F.lit(1)).alias("count")]
    rows_ = buckets.bucket_stream(source, "day", ["maintenance_type"], count, "1 hour")
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    buckets.start_append(rows_, out, marks, None).awaitTermination()
    got = rows(spark.read.parquet(out))
    batch = spark.read.parquet(feed)
    last = batch.agg(F.max("timestamp")).first()[0] - timedelta(hours=1)
    want = [r for r in rows(panels.daily_maintenance(batch)) if r[0] + timedelta(days=1) <= last]
    assert got == want and got
    buckets.start_append(
        buckets.bucket_stream(source, "day", ["maintenance_type"], count, "1 hour"), out, marks, None
    ).awaitTermination()
    assert rows(spark.read.parquet(out)) == want


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    feed, out, marks = (str(tmp_path / n) for n in ("feed", "out", "marks"))
    ddl = "timestamp timestamp, k string"
    noon = datetime(2024, 1, 1, 12)

    def step(*hours):
        spark.createDataFrame([(noon + timedelta(hours=h), "a") for h in hours], ddl).coalesce(
            1
        ).write.mode("append").parquet(feed)
        source = spark.readStream.schema(ddl).parquet(feed)
        made = buckets.bucket_stream(source, "hour", ["k"], [F.count(F.lit(1)).alias("n")], "1 hour")
        buckets.start_append(made, out, marks, None).awaitTermination()

    step(0, 0, 5)
    step(0, 6)
    got = {r.time.hour: r.n for r in spark.read.parquet(out).collect()}
    assert got == {12: 2}
    step(9)
    got = {r.time.hour: r.n for r in spark.read.parquet(out).collect()}
    assert got == {12: 2, 17: 1, 18: 1}
