"""Streaming queries over files, run to the end of the input, and the written tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.base import Context, check, r6
from roadlens.plans import batch_etl
from roadlens.session import scratch_path
from roadlens.sources import messages
from roadlens.streaming import buckets, live, manifest, trip_stream


@check(
    "t1_t4_processed_stream",
    'select trip_key, vehicle_id, "timestamp", speed, event_type, fuel_efficiency_l_per_km'
    " from stream",
    keep_digits=True,
)
def _(c: Context):
    feed, out = scratch_path(c.spark, "feed"), scratch_path(c.spark, "processed")
    messages.encode(c.trips, keep=["trip_key"]).write.parquet(feed)
    source = (
        c.spark.readStream.schema("trip_key string, value string")
        .option("maxFilesPerTrigger", 4)
        .parquet(feed)
    )
    rows = trip_stream.processed(source, keep=["trip_key"])
    query = trip_stream.start(
        rows, trip_stream.epoch_writer(out), scratch_path(c.spark, "offsets"), interval=None
    )
    query.awaitTermination()
    return trip_stream.read_processed(c.spark, out).select(
        "trip_key", "vehicle_id", "timestamp", "speed", "event_type", "fuel_efficiency_l_per_km"
    )


@check(
    "t2_t3_t5_hourly_event_buckets",
    f"""select date_trunc('hour', ts) as "time", event_type, count(*) as n,
  {r6('avg(value)')} as avg_value
from events group by 1, 2
having date_trunc('hour', ts) + interval 1 hour
  <= date_trunc('milliseconds', (select max(ts) from events)) - interval 1 hour""",
)
def _(c: Context):
    folder = c.sf_dir
    source = c.spark.readStream.schema(c.table("events").schema).parquet(f"{folder}/events*.parquet")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value")]
    closed = buckets.bucket_stream(source, "hour", ["event_type"], aggs, "1 hour", "ts")
    out = scratch_path(c.spark, "buckets")
    buckets.start_append(closed, out, scratch_path(c.spark, "offsets"), None).awaitTermination()
    return c.spark.read.parquet(out)


@check(
    "s6_s7_batch_job_table",
    "select trip_key, strftime(\"timestamp\", '%Y-%m-%d') as event_date, vehicle_age_group, downtime_flag,"
    " fuel_efficiency_l_per_km from clean",
    keep_digits=True,
)
def _(c: Context):
    out = scratch_path(c.spark, "cleaned")
    batch_etl.run(c.spark, c.trips, out, by_date=False)
    return c.spark.read.parquet(out).select(
        "trip_key", F.date_format("timestamp", "yyyy-MM-dd").alias("event_date"), "vehicle_age_group",
        "downtime_flag", "fuel_efficiency_l_per_km",
    )


@check(
    "r1_run_metrics",
    """select 'rows_read' as metric, cast((select count(*) from trips) as double) as value
union all select 'rows_cleaned', cast((select count(*) from clean) as double)
union all select 'failures', 0e0""",
)
def _(c: Context):
    out, metrics = scratch_path(c.spark, "cleaned"), scratch_path(c.spark, "metrics")
    batch_etl.run(c.spark, c.trips, out, metrics, by_date=False)
    return (
        c.spark.read.parquet(metrics)
        .filter("metric <> 'duration_seconds'")
        .select("metric", "value")
    )


# ---------------------------------------------------------------- live panels and dated stream tables

LIVE_SQL = {
    "hourly_labels": ("d2", "date_trunc('hour', \"timestamp\") as \"time\", cast(count(*) filter (where risk_label) as bigint) as risk_events", "1"),
    "hourly_fuel": (
        "d6", "date_trunc('hour', \"timestamp\") as \"time\", vehicle_type,"
        f" {r6('avg(fuel_consumption_liters)')} as avg_fuel_consumption", "1, 2",
    ),
    "daily_maintenance": ("d7", "cast(date_trunc('day', \"timestamp\") as timestamp) as \"time\", maintenance_type, count(*) as \"count\"", "1, 2"),
    "daily_road_types": ("d11", "cast(date_trunc('day', \"timestamp\") as timestamp) as \"time\", road_type, count(*) as \"count\"", "1, 2"),
    "hourly_traffic": ("d12", "date_trunc('hour', \"timestamp\") as \"time\", traffic_density, count(*) as \"count\"", "1, 2"),
}


def _feed_halves(c: Context, columns):
    """The stream's rows in two parts, dealt by key and not by time: the second is full of late rows for buckets
    that the first has opened."""
    rows = c.stream.select("trip_key", *columns)
    second = F.pmod(F.xxhash64("trip_key"), F.lit(2)) == 1
    return [rows.filter(~second).drop("trip_key"), rows.filter(second).drop("trip_key")]


def _live(name: str):
    def run(c: Context):
        panel = live.panels()[name]
        columns = ["timestamp", "risk_label", "fuel_consumption_liters", "vehicle_type", "maintenance_type", "road_type", "traffic_density"]
        feed, out, offsets = (scratch_path(c.spark, n) for n in ("feed", name, "offsets"))
        for part in _feed_halves(c, columns):
            # The query stops after the first part and goes on from its checkpoint with the second.
            part.write.mode("append").parquet(feed)
            source = c.spark.readStream.schema(part.schema).parquet(feed)
            live.start(panel, source, out, offsets, late="4000 days", interval=None).awaitTermination()
        schema = panel.stream(source, "4000 days").schema
        live.compact(panel, c.spark, out, live.versioned(schema))
        return live.read(panel, c.spark, out, schema)

    return run


for _name, (_id, _columns, _groups) in LIVE_SQL.items():
    check(f"t5_{_id}_live_{_name}", f"select {_columns} from stream group by {_groups}")(_live(_name))


@check(
    "s8_f9_dated_stream_range",
    'select trip_key, vehicle_id, "timestamp", speed from stream'
    " where cast(\"timestamp\" as date) between date '1995-03-01' and date '1995-05-31'",
    keep_digits=True,
)
def _(c: Context):
    """Micro-batches into a table split by day, compacted, and a range of days read from it."""
    columns = ["trip_key", "vehicle_id", "timestamp", "speed"]
    feed, out, offsets = (scratch_path(c.spark, n) for n in ("feed", "dated", "offsets"))
    rows = c.stream.select(*columns).filter("timestamp >= '1995-01-01' and timestamp < '1995-07-01'")
    rows.repartition(4, "trip_key").write.parquet(feed)
    source = c.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    trip_stream.start(source, trip_stream.dated_writer(out), offsets, interval=None).awaitTermination()
    manifest.compact(c.spark, out, rows.schema)
    return manifest.read(c.spark, out, rows.schema, date(1995, 3, 1), date(1995, 5, 31))
