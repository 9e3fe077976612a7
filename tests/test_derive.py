"""Edge cases of rules, derived columns and messages."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from roadlens.functions import derive, rules
from roadlens.schema import EVENT_PRIORITY, TRIP_SCHEMA
from roadlens.sources import messages

NAN = float("nan")


def test_validity_rules_treat_unknown_strictly_or_kindly(spark):
    ddl = "id int, latitude double, longitude double, speed double, sensor_battery double," \
        " fuel_consumption_liters double, downtime_hours double"
    good = (40.7, -74.0, 50.0, 80.0, 5.0, 0.0)
    cases = [
        (1, *good),
        (2, 40.7, -74.0, 50.0, 80.0, None, None),
        (3, None, -74.0, 50.0, 80.0, 5.0, 0.0),
        (4, 40.7, -74.0, None, 80.0, 5.0, 0.0),
        (5, 40.7, -74.0, 160.0, 100.0, 5.0, 0.0),
        (6, 40.7, -74.0, 160.01, 80.0, 5.0, 0.0),
        (7, 40.7, -74.0, 50.0, 100.5, 5.0, 0.0),
        (8, 40.7, -74.0, 50.0, 80.0, 0.0, 0.0),
        (9, 40.7, -74.0, 50.0, 80.0, 5.0, -1.0),
        (10, 41.0, -74.0, 50.0, 80.0, 5.0, 0.0),
        (11, 40.7, -74.0, NAN, 80.0, 5.0, 0.0),
    ]
    df = spark.createDataFrame(cases, ddl)
    assert [r.id for r in rules.keep_valid(df).orderBy("id").collect()] == [1, 2, 5]
    report = {r.rule: r.rows_rejected for r in rules.reject_report(df).collect()}
    assert report == {
        "gps_box": 2, "speed_range": 3, "battery_range": 1, "fuel_positive_or_null": 1,
        "downtime_not_negative": 1, "any_rule": 8,
    }


@pytest.mark.parametrize(
    ("age", "band"),
    [(0.0, "0-3"), (3.0, "0-3"), (4.0, "4-6"), (6.0, "4-6"), (7.0, "7-9"), (9.0, "7-9"),
     (10.0, "10+"), (None, "10+"), (3.5, "10+")],
)
def test_age_bands(spark, age, band):
    df = spark.createDataFrame([(age,)], "vehicle_age_years double")
    assert df.select(derive.age_band()).first()[0] == band


def test_efficiency_digits_and_zero_distance(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0), (1.0, 0.0), (None, 3.0)],
        "fuel_consumption_liters double, distance_traveled_km double",
    )
    got = df.select(derive.litres_per_km(2), derive.litres_per_km(3)).collect()
    assert [tuple(r) for r in got] == [(0.33, 0.333), (None, None), (None, None)]


def test_event_priority_of_every_pair(spark):
    flags = [c for c, _ in EVENT_PRIORITY]
    cases, want = [], []
    for i in range(len(flags)):
        for j in range(i, len(flags)):
            cases.append(tuple(k in (i, j) for k in range(len(flags))))
            want.append(EVENT_PRIORITY[i][1])
    cases.append(tuple(False for _ in flags))
    want.append("normal")
    df = spark.createDataFrame(cases, ", ".join(f"{c} boolean" for c in flags)).coalesce(1)
    assert [r[0] for r in df.select(derive.event_type()).collect()] == want


def test_clean_skips_columns_that_are_missing(spark):
    df = spark.createDataFrame([("Rainy", 12.0)], "weather string, speed double")
    assert derive.clean(df).columns == ["weather", "speed"]
    assert derive.clean(df).first().weather == "rainy"


def test_clean_derives_all(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 7, 17, 5), 5, 2.0, 8.0, None, "HIGH", "Predictive")],
        "timestamp timestamp, vehicle_age_years int, fuel_consumption_liters double,"
        " distance_traveled_km double, downtime_hours double, traffic_density string,"
        " maintenance_type string",
    )
    got = derive.clean(df).first()
    assert (got.hour_of_day, got.vehicle_age_group, got.fuel_efficiency_l_per_km) == (17, "4-6", 0.25)
    assert (got.downtime_flag, got.traffic_density, got.maintenance_type) == (0, "high", "Predictive")


def test_text_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "speed string")
    assert [r[0] for r in df.select(derive.to_number("speed")).collect()] == [1.5, None, None]


def test_weekday_starts_on_monday_and_dummies_drop_the_first(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), 10.0, 5.0, 2.0, True, 3, kind) for kind in ("car", "truck", None)],
        "timestamp timestamp, distance_traveled_km double, fuel_consumption_liters double,"
        " idle_time_minutes double, optimized_route_flag boolean, driver_experience_years int,"
        " vehicle_type string",
    )
    made = derive.route_features(df).orderBy("vehicle_type").collect()
    assert [r.day_of_week for r in made] == [0, 0, 0]
    assert [(r.vehicle_type_truck, r.vehicle_type_van) for r in made] == [(0, 0), (0, 0), (1, 0)]
    assert made[0].optimized_x_experience == 3


def test_json_records(spark):
    texts = [
        '{"vehicle_id":"A","speed":10.5,"fuel_consumption_liters":NaN,"rush_hour":true}',
        "not json",
        '{"vehicle_id":"B","speed":"fast","vehicle_age_years":3}',
        "{}",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    got = messages.decode_trips(df).collect()
    assert (got[0].vehicle_id, got[0].speed, got[0].fuel_consumption_liters) == ("A", 10.5, None)
    assert got[0].rush_hour is True
    assert all(v is None for v in got[1])
    assert (got[2].vehicle_id, got[2].speed) == ("B", None)
    assert all(v is None for v in got[3])
    moving = derive.stream_transform(messages.decode_trips(df))
    assert [r.vehicle_id for r in moving.collect()] == ["A"]


def test_encode_leaves_missing_fields_out_and_keeps_time(spark):
    values = {f.name: None for f in TRIP_SCHEMA.fields}
    values.update(vehicle_id="A", timestamp=datetime(2024, 1, 2, 3, 4, 5, 600000))
    df = spark.createDataFrame([tuple(values.values())], TRIP_SCHEMA)
    text = messages.encode(df).first().value
    assert "latitude" not in text and "2024-01-02T03:04:05.600" in text
    assert rows(messages.decode_trips(messages.encode(df)).select(*TRIP_SCHEMA.names)) == rows(df)


def test_flags_keep_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in df.select(derive.flag("b")).collect()] == [1, 0, None]


def test_time_range_is_closed(spark):
    df = spark.range(5).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp")
    )
    assert rules.time_range(df, "1970-01-01 01:00:00", "1970-01-01 03:00:00").count() == 3
    assert rules.time_range(df).count() == 5
