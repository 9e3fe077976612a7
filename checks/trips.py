"""Trip records made from the given tables: the same expressions for Spark and for the SQL check.

lineitem joined with orders, part and customer; vehicles are parts, drivers are customers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.schema import TRIP_SCHEMA
from roadlens.session import scratch_path

STORED_SCHEMA = T.StructType([T.StructField("trip_key", T.StringType()), *TRIP_SCHEMA.fields])

DRAWS = {
    "u1": "(l_orderkey*31 + l_partkey*17 + l_suppkey*13 + l_linenumber*101) % 1009",
    "u2": "(l_orderkey*37 + l_partkey*41 + l_suppkey*7 + l_linenumber*211) % 1013",
    "u3": "(l_orderkey*43 + l_partkey*29 + l_suppkey*53 + l_linenumber*307) % 1019",
    "u4": "(l_orderkey*59 + l_partkey*61 + l_suppkey*67 + l_linenumber*401) % 1021",
    "u5": "(l_orderkey*71 + l_partkey*73 + l_suppkey*79 + l_linenumber*503) % 1031",
    "u6": "(l_orderkey*83 + l_partkey*89 + l_suppkey*97 + l_linenumber*601) % 1033",
    "sec": "(l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709 + l_linenumber*15485863)"
    " % 86400",
    "typ": "case when p_size % 20 < 9 then 'car' when p_size % 20 < 14 then 'van'"
    " else 'truck' end",
    "age": "p_size % 13",
    "gen": "cast(1 + l_partkey % 3 as int)",
    "pred": "l_partkey % 5 < 3",
    "untrained": "c_acctbal <= 2000",
}
PARTS = {
    "ts": "o_orderdate + sec * interval '1' second",
    "dist10": "20 + (u1*u2) % 600",
    "idle10": "10 + (u2*u3) % 110",
    "ratec": "case typ when 'car' then 750 when 'van' then 1200 else 2800 end"
    " + age*12 + u5 % 200 - 25*gen",
    "burnc": "case typ when 'car' then 4 when 'van' then 6 else 10 end",
    "optz": "u6 % 10 < 6",
    "interv": "u3 % 100 < 55",
    "coll": "u2 < 6",
}
_BROKEN = "(u4 + u6) % 1000 < (case when pred then 6 else 15 end) + age"
COLUMNS = {
    "trip_key": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,"
    " cast(round(l_extendedprice * 100) as bigint))",
    "vehicle_id": "concat('VEH', lpad(cast(l_partkey as string), 7, '0'))",
    "driver_id": "concat('DRV', lpad(cast(o_custkey as string), 7, '0'))",
    "route_id": "concat('RTE', cast(100 + l_orderkey % 900 as string))",
    "timestamp": "ts",
    "latitude": "case when u4 < 5 then null else cast(4046000 + u4*46 as double)/100000 end",
    "longitude": "case when u4 < 5 then null else cast(-7427000 + u5*56 as double)/100000 end",
    "hour_of_day": "cast(extract(hour from ts) as int)",
    "weather": "case when (u1*7+u2) % 10 < 5 then 'Sunny' when (u1*7+u2) % 10 < 7 then 'rainy'"
    " when (u1*7+u2) % 10 < 8 then 'foggy' when (u1*7+u2) % 10 < 9 then 'SNOWY'"
    " else 'cloudy' end",
    "road_type": "case when u1 % 20 < 9 then 'highway' when u1 % 20 < 17 then 'City'"
    " else 'rural' end",
    "traffic_density": "case when u2 % 10 < 3 then 'low' when u2 % 10 < 8 then 'medium'"
    " else 'HIGH' end",
    "rush_hour": "extract(hour from ts) between 7 and 9 or extract(hour from ts) between 16 and 18",
    "vehicle_type": "typ",
    "vehicle_age_years": "age",
    "device_generation": "gen",
    "device_cost_usd": "p_retailprice",
    "driver_experience_years": "cast(o_custkey % 21 as int)",
    "driver_training": "case when untrained then 'untrained' else 'Trained' end",
    "optimized_route_flag": "optz",
    "speed": "cast((u3*1009 + u1) % 16400 as double)/100",
    "distance_traveled_km": "cast(dist10 as double)/10",
    "idle_time_minutes": "cast(idle10 as double)/10",
    "fuel_consumption_liters": "case when u6 < 2 then null when u6 = 3 then 0.0e0"
    " else cast((dist10*ratec + idle10*burnc*100) * (case when optz then 94 else 100 end)"
    " as double)/10000000 end",
    "fuel_rate_l_per_100km": "case when u6 < 2 then null else cast(ratec as double)/100 end",
    "sensor_battery": "cast(2000 + (u4*u5) % 8200 as double)/100",
    "sensor_signal_strength": "cast(120 + u5 % 380 as double)/100",
    "data_latency_ms": "cast(case gen when 1 then 18000 when 2 then 11000 else 6500 end"
    " + (u1*u4) % 6000 - 3000 as double)/100",
    "gps_accuracy_meters": "cast(case gen when 1 then 1400 when 2 then 900 else 500 end"
    " + (u2*u5) % 300 - 150 as double)/100",
    "packet_loss_rate": "cast(case gen when 1 then 80 when 2 then 40 else 10 end"
    " + (u3*u4) % 100 as double)/10000",
    "braking_event": "u1 % 100 < 8 + (case when u2 % 10 >= 8 then 6 else 0 end)",
    "collision_alert": "coll",
    "lane_change_event": "u3 % 10 = 0",
    "harsh_acceleration_event": "(u4 % 1000) * 100 < (case when untrained then 80 else 40 end)"
    " * (case when interv then 55 else 100 end)",
    "sensor_fault_event": "u5*gen < 8",
    "network_delay_event": "u6*gen < 6",
    "gps_loss_event": "((u1 + u2) % 1000)*gen < 5",
    "maintenance_type": "case when pred then 'Predictive' else 'scheduled' end",
    "time_since_last_maintenance_days": "cast(case when pred then 220 else 450 end + u3 % 200 - 100"
    " as double)/10",
    "breakdown_event": _BROKEN,
    "downtime_hours": f"case when u2 = 500 then null else (case when {_BROKEN}"
    " then cast(case when pred then 350 else 650 end + u6 % 200 as double)/100 else 0.0e0 end)"
    " + (case when coll then cast(800 + u6*2 as double)/100 else 0.0e0 end) end",
    "intervention_active": "interv",
    "risk_label": f"(not (coll or u5*gen < 8 or {_BROKEN})) <> (u1 = 7)",
}
EXTRA = {
    "event_type": "case when collision_alert then 'collision'"
    " when sensor_fault_event then 'sensor_fault' when gps_loss_event then 'gps_loss'"
    " when network_delay_event then 'network_delay'"
    " when harsh_acceleration_event then 'harsh_acceleration' when braking_event then 'braking'"
    " when lane_change_event then 'lane_change' else 'normal' end",
    "maintenance_cost_usd": "(case when maintenance_type = 'Predictive' then 15.0e0 else 10.0e0 end)"
    " + coalesce(downtime_hours, 0.0e0) * 80",
}


_STORED: dict[tuple[str, str, str], str] = {}


#: Methods beyond this many bytes of code are not compiled by the JVM but interpreted.
METHOD_BYTES = 8000


def is_stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, name) in _STORED


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table made from a data folder, written once per application as users keep theirs."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
        # The expressions of all columns in one method would be interpreted, row by row.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)
        try:
            # Small row groups: a table of one file is still read by all cores.
            writer = build().write.option("parquet.block.size", 4 << 20).option("compression", "zstd")
            writer.parquet(path)
        finally:
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trip table of a data folder."""
    return stored(spark, sf_dir, "trips", lambda: build_trips(spark, sf_dir))


def build_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    joined = (
        lines.join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    drawn = joined.selectExpr("*", *_named(DRAWS))
    parts = drawn.selectExpr("*", *_named(PARTS))
    facts = parts.selectExpr(*_named(COLUMNS)).selectExpr("*", *_named(EXTRA))
    return facts.select([F.col(f.name).cast(f.dataType) for f in STORED_SCHEMA])


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} as `{name}`" for name, text in expressions.items()]


def _sql(expressions: dict[str, str]) -> str:
    return ", ".join(f'{text} as "{name}"' for name, text in expressions.items())


TRIPS_CTE = (
    f"drawn as (select *, {_sql(DRAWS)} from lineitem join orders on l_orderkey = o_orderkey"
    " join part on l_partkey = p_partkey join customer on o_custkey = c_custkey),\n"
    f"parts as (select *, {_sql(PARTS)} from drawn),\n"
    f"facts as (select {_sql(COLUMNS)} from parts),\n"
    f"trips as (select *, {_sql(EXTRA)} from facts)"
)
