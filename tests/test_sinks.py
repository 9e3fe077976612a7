"""Written tables, retention, the batch job and its metrics."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from roadlens.plans import batch_etl
from roadlens.schema import TRIP_DDL, TRIP_SCHEMA
from roadlens.sources import sinks
from roadlens.sources.tables import read_trips, retain_since


def trips(spark, n=40):
    base = {f.name: F.lit(None).cast(f.dataType) for f in TRIP_SCHEMA.fields}
    i = F.col("id")
    base.update(
        vehicle_id=F.concat(F.lit("V"), (i % 5).cast("string")),
        timestamp=F.timestamp_seconds(1_700_000_000 + i * 7200),
        latitude=F.lit(40.7), longitude=F.when(i % 10 != 0, F.lit(-74.0)),
        speed=i.cast("double"), sensor_battery=F.lit(50.0),
        fuel_consumption_liters=F.lit(2.0), distance_traveled_km=i.cast("double"),
        vehicle_age_years=(i % 12).cast("int"), event_type=F.lit("normal"),
        breakdown_event=i % 4 == 0, downtime_hours=F.lit(0.0), maintenance_type=F.lit("scheduled"),
    )
    return spark.range(n).select(*[base[f.name].alias(f.name) for f in TRIP_SCHEMA.fields])


def test_dated_parquet_and_pruned_reading(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(trips(spark), path)
    assert rows(spark.read.parquet(path).select(*TRIP_SCHEMA.names)) == rows(trips(spark))
    day = read_trips(spark, path, ["vehicle_id", "speed", "event_date"], valid_only=False)
    plan = day.filter("event_date = '2023-11-15'").select("speed")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<speed:double>" in text


def test_rules_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(trips(spark), path, by_date=False)
    df = read_trips(spark, path, ["vehicle_id"], valid_only=True)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(latitude)" in text
    assert df.count() == 36


def test_purge_drops_days_and_rewrites_the_boundary(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(trips(spark), path)
    as_of = datetime(2023, 11, 18, 5)
    want = rows(retain_since(trips(spark), as_of, 3))
    sinks.purge_before(spark, path, as_of, 3)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select(*TRIP_SCHEMA.names)) == want
    sinks.purge_before(spark, path, as_of, 3)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select(*TRIP_SCHEMA.names)) == want


def test_tables(spark):
    sinks.ensure_table(spark, "raw_trips", TRIP_DDL)
    sinks.ensure_table(spark, "raw_trips", TRIP_DDL)
    sinks.append_table(trips(spark, 10), "raw_trips")
    sinks.append_table(trips(spark, 10), "raw_trips")
    assert spark.table("raw_trips").count() == 20
    with pytest.raises(ValueError, match="speed"):
        sinks.append_table(trips(spark, 5).withColumn("speed", F.lit("x")), "raw_trips")
    sinks.write_table(trips(spark, 3), "other_trips")
    sinks.write_table(trips(spark, 4), "other_trips")
    assert read_trips(spark, "other_trips").count() == 4


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "metric string, value double")
    sinks.export(df, str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "r.parquet"))) == rows(df)
    back = spark.read.option("header", True).csv(str(tmp_path / "r.csv"))
    assert back.columns == ["metric", "value"] and back.count() == 2


def test_batch_job(spark, tmp_path):
    target, metrics = str(tmp_path / "clean"), str(tmp_path / "metrics")
    summary = batch_etl.run(spark, trips(spark), target, metrics)
    assert [(r.event_type, r.event_count) for r in summary.collect()] == [("normal", 36)]
    seen = {r.metric: r.value for r in spark.read.parquet(metrics).collect()}
    assert (seen["rows_read"], seen["rows_cleaned"], seen["failures"]) == (40, 36, 0)
    assert seen["duration_seconds"] > 0


def test_failed_batch_job_is_counted_and_raised(spark, tmp_path):
    metrics = str(tmp_path / "metrics")
    broken = trips(spark).withColumn("speed", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        batch_etl.run(spark, broken, str(tmp_path / "clean"), metrics)
    assert spark.read.parquet(metrics).filter("metric = 'failures'").first().value == 1
