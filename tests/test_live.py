"""Tables with a manifest and live panels: replays, late rows, restarts, compaction, reading by day."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from roadlens.operators import panels
from roadlens.streaming import live, manifest, trip_stream
from tests.conftest import rows

SCHEMA = "timestamp timestamp, road_type string, n int"


def batch(spark, day, k, n=3):
    return spark.createDataFrame([(datetime(2024, 5, day, h), "city", k) for h in range(n)], SCHEMA)


def days(df):
    return sorted({(r.timestamp.day, r.n) for r in df.collect()})


def test_manifest_names_the_rows_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.to_date("timestamp")
    schema = batch(spark, 1, 0).schema
    assert manifest.read(spark, path, schema).count() == 0
    for epoch, (d, k) in enumerate([(1, 10), (2, 20), (3, 30)]):
        assert manifest.write_batch(batch(spark, d, k), epoch, path, day)
    assert not manifest.write_batch(batch(spark, 1, 99), 0, path, day)
    assert days(manifest.read(spark, path, schema)) == [(1, 10), (2, 20), (3, 30)]
    # A folder that no manifest names is no part of the table.
    batch(spark, 4, 40).withColumn("event_date", F.lit("2024-05-04")).write.partitionBy("event_date").parquet(f"{path}/data/batch-9")
    some = manifest.read(spark, path, schema, date(2024, 5, 2), date(2024, 5, 4))
    assert days(some) == [(2, 20), (3, 30)]
    assert all("event_date=2024-05-01" not in f for f in some.inputFiles())
    before = manifest.read(spark, path, schema)
    manifest.compact(spark, path, schema)
    assert rows(manifest.read(spark, path, schema)) == rows(before)
    version, entries = manifest.Manifest(spark, path).read()
    assert [e["last"] for e in entries] == [{"batch": 2}] and len(entries[0]["days"]) == 3
    assert not manifest.write_batch(batch(spark, 1, 99), 2, path, day)
    assert sorted(manifest.vacuum(spark, path)) == ["batch-0", "batch-1", "batch-2", "batch-9"]
    assert days(manifest.read(spark, path, schema)) == [(1, 10), (2, 20), (3, 30)]


def test_empty_batch_and_rows_without_day(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = batch(spark, 1, 0).schema
    assert manifest.write_batch(batch(spark, 1, 0).limit(0), 0, path, F.to_date("timestamp"))
    assert manifest.write_batch(spark.createDataFrame([(None, "x", 1)], SCHEMA), 1, path, F.to_date("timestamp"))
    assert manifest.read(spark, path, schema).count() == 1
    assert manifest.read(spark, path, schema, date(2024, 1, 1), date(2025, 1, 1)).count() == 0
    manifest.compact(spark, path, schema)
    assert manifest.read(spark, path, schema).count() == 1


def test_old_manifests_go(spark, tmp_path):
    path = str(tmp_path / "t")
    held = manifest.Manifest(spark, path)
    for i in range(manifest.KEPT_VERSIONS + 5):
        held.commit({"folder": f"f{i}", "days": [], "last": {"q": i}})
    assert len(held._versions()) == manifest.KEPT_VERSIONS and len(held.read()[1]) == manifest.KEPT_VERSIONS + 5


@pytest.fixture
def feed(spark, tmp_path):
    folder = str(tmp_path / "feed")

    def add(*times):
        spark.createDataFrame([(datetime.fromisoformat(t), road, 1) for t, road in times], SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    return folder, add


def test_live_panel_after_restart_and_late_rows(spark, tmp_path, feed):
    folder, add = feed
    panel = live.panels()["daily_road_types"]
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")

    def run():
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        live.start(panel, source, out, offsets, late="2 days", interval=None, compact_every=2).awaitTermination()
        return panel.stream(source, "2 days").schema

    add(("2024-05-01T01:00:00", "city"), ("2024-05-01T02:00:00", "city"), ("2024-05-02T05:00:00", None))
    schema = run()
    # The bucket of the second day is open and already there.
    assert [(r.time.day, r.road_type, r["count"]) for r in live.read(panel, spark, out, schema).collect()] == [(1, "city", 2), (2, None, 1)]
    add(("2024-05-02T23:00:00", None), ("2024-05-01T23:00:00", "city"), ("2024-05-09T00:00:00", "rural"))
    run()
    run()
    add(("2024-05-01T12:00:00", "city"), ("2024-05-09T12:00:00", "rural"))  # the first is later than the watermark
    run()
    got = [(r.time.day, r.road_type, r["count"]) for r in live.read(panel, spark, out, schema).collect()]
    assert got == [(1, "city", 3), (2, None, 2), (9, "rural", 2)]
    batchwise = panels.daily_road_types(spark.read.parquet(folder)).filter("time > '2024-05-01 12:00:00'")
    part = live.read(panel, spark, out, schema, date(2024, 5, 2), date(2024, 5, 31))
    assert rows(part) == rows(batchwise.select(part.columns))
    live.compact(panel, spark, out, live.versioned(schema))
    assert manifest.read(spark, out, live.versioned(schema)).count() == 3
    assert rows(live.read(panel, spark, out, schema, date(2024, 5, 2))) == rows(part)


def test_dated_writer_of_the_trip_stream(spark, tmp_path, feed):
    folder, add = feed
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    add(("2024-05-01T01:00:00", "a"), ("2024-05-02T02:00:00", "b"))
    add(("2024-05-02T03:00:00", "c"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):
        trip_stream.start(source, trip_stream.dated_writer(out, compact_every=2), offsets, interval=None).awaitTermination()
    kept = manifest.read(spark, out, spark.read.parquet(folder).schema)
    assert rows(kept) == rows(spark.read.parquet(folder))
    assert len(manifest.Manifest(spark, out).read()[1]) == 1
    assert manifest.read(spark, out, kept.schema, date(2024, 5, 2), date(2024, 5, 2)).count() == 2
