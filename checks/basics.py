"""Scans, filters, derived columns and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Context, check, r6
from roadlens.functions import derive, rules
from roadlens.operators import aggregates, quality
from roadlens.sources import messages
from roadlens.sources.tables import retain_since

VALID = {
    "gps_box": "latitude between 40.4774 and 40.9176 and longitude between -74.2591 and -73.7004",
    "speed_range": "speed between 0 and 160",
    "battery_range": "sensor_battery between 0 and 100",
    "fuel_positive_or_null": "fuel_consumption_liters is null or fuel_consumption_liters > 0",
    "downtime_not_negative": "downtime_hours is null or downtime_hours >= 0",
}

# ---------------------------------------------------------------- scans


@check(
    "s1_valid_scan",
    "select trip_key, latitude, longitude, speed, sensor_battery, fuel_consumption_liters,"
    " downtime_hours from valid",
    keep_digits=True,
)
def _(c: Context):
    return rules.keep_valid(c.trips).select(
        "trip_key", "latitude", "longitude", "speed", "sensor_battery",
        "fuel_consumption_liters", "downtime_hours",
    )


@check(
    "s2_clean_scan",
    'select trip_key, vehicle_id, driver_id, "timestamp", hour_of_day, weather, road_type,'
    " traffic_density, driver_training, maintenance_type, vehicle_age_group,"
    " fuel_efficiency_l_per_km, downtime_flag from clean",
    keep_digits=True,
)
def _(c: Context):
    return c.cleaned_now.select(
        "trip_key", "vehicle_id", "driver_id", "timestamp", "hour_of_day", "weather", "road_type",
        "traffic_density", "driver_training", "maintenance_type", "vehicle_age_group",
        "fuel_efficiency_l_per_km", "downtime_flag",
    )


@check(
    "s4_json_decode",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def _(c: Context):
    df = c.table("events").select("event_id", F.col("props").alias("value"))
    return messages.decode(df, "k bigint", keep=["event_id"])


@check(
    "s5_json_round_trip",
    'select trip_key, vehicle_id, "timestamp", latitude, speed, fuel_consumption_liters,'
    " vehicle_age_years, collision_alert, maintenance_type, risk_label from trips",
    keep_digits=True,
)
def _(c: Context):
    encoded = messages.encode(c.trips, keep=["trip_key"])
    return messages.decode_trips(encoded, keep=["trip_key"]).select(
        "trip_key", "vehicle_id", "timestamp", "latitude", "speed", "fuel_consumption_liters",
        "vehicle_age_years", "collision_alert", "maintenance_type", "risk_label",
    )


@check(
    "s13_retention",
    "select trip_key, \"timestamp\" from trips"
    " where \"timestamp\" >= timestamp '1999-06-30 12:00:00' - interval 3 days",
)
def _(c: Context):
    return retain_since(c.trips, "1999-06-30 12:00:00", 3).select("trip_key", "timestamp")


# ---------------------------------------------------------------- filters


def _filter(name: str, where: str, predicate, column: str, source: str = "trips") -> None:
    @check(name, f"select trip_key, {column} from {source} where {where}", keep_digits=True)
    def _(c: Context):
        return getattr(c, source).filter(predicate()).select("trip_key", column)


_filter("f1_gps_box", VALID["gps_box"], rules.in_gps_box, "latitude")
_filter("f2_speed_range", VALID["speed_range"], rules.speed_in_range, "speed")
_filter("f3_battery_range", VALID["battery_range"], rules.battery_in_range, "sensor_battery")
_filter(
    "f4_fuel_positive", VALID["fuel_positive_or_null"], rules.fuel_positive_or_unknown,
    "fuel_consumption_liters",
)
_filter(
    "f5_downtime_not_negative", VALID["downtime_not_negative"], rules.downtime_not_negative,
    "downtime_hours",
)
_filter("f6_moving", "speed > 0", rules.moving, "speed")
_filter(
    "f11_predictive_rows", "lower(maintenance_type) = 'predictive'",
    lambda: rules.same_category("maintenance_type", "predictive"), "maintenance_type", "clean",
)
_filter("f12_breakdown_rows", "breakdown_event", lambda: F.col("breakdown_event"), "downtime_hours")


@check(
    "f7_required_columns",
    "select trip_key from clean where fuel_rate_l_per_100km is not null and downtime_hours is not"
    " null and maintenance_cost_usd is not null and breakdown_event is not null"
    " and device_generation is not null",
)
def _(c: Context):
    needed = [
        "fuel_rate_l_per_100km", "downtime_hours", "maintenance_cost_usd", "breakdown_event",
        "device_generation",
    ]
    return rules.complete(c.clean, needed).select("trip_key")


FEATURES = [
    "driver_experience_years", "vehicle_age_years", "fuel_efficiency_l_per_km",
    "intervention_active",
]


@check(
    "f8_complete_cases",
    f"select trip_key, {', '.join(FEATURES)} from clean where "
    + " and ".join(f"{f} is not null" for f in FEATURES),
    keep_digits=True,
)
def _(c: Context):
    return rules.complete(c.clean, FEATURES).select("trip_key", *FEATURES)


@check(
    "f9_time_range",
    "select trip_key, \"timestamp\" from stream where \"timestamp\" between"
    " timestamp '1996-03-01 00:00:00' and timestamp '2000-02-29 23:59:59'",
)
def _(c: Context):
    return rules.time_range(c.stream, "1996-03-01 00:00:00", "2000-02-29 23:59:59").select(
        "trip_key", "timestamp"
    )


@check(
    "f9_last_hours",
    "select trip_key, \"timestamp\" from stream where \"timestamp\" between"
    " timestamp '1998-07-01 12:00:00' - interval 6 hours and timestamp '1998-07-01 12:00:00'",
)
def _(c: Context):
    return rules.recent(c.stream, 6, "1998-07-01 12:00:00").select("trip_key", "timestamp")


@check(
    "f10_arm_split",
    f"""select intervention_active, {r6('avg(fuel_rate_l_per_100km)')} as mean,
  {r6('stddev_samp(fuel_rate_l_per_100km)')} as std, count(fuel_rate_l_per_100km) as "count"
from clean group by 1""",
)
def _(c: Context):
    return aggregates.arm_summary(c.clean, "intervention_active", "fuel_rate_l_per_100km")


@check(
    "f13_reject_report",
    " union all ".join(
        f"select count(*) as rows_total, '{name}' as rule,"
        f" cast(count(*) filter (where not coalesce({rule}, false)) as bigint) as rows_rejected"
        " from trips"
        for name, rule in {
            **VALID,
            "any_rule": " and ".join(f"({v})" for v in VALID.values()),
        }.items()
    ),
)
def _(c: Context):
    return rules.reject_report(c.trips)


# ---------------------------------------------------------------- derived columns


def _derived(name: str, source: str, columns, sql: dict, digits: bool = False) -> None:
    items = ", ".join(f'{text} as "{alias}"' for alias, text in sql.items())

    @check(name, f"select trip_key, {items} from {source}", keep_digits=not digits)
    def _(c: Context):
        made = [col.alias(alias) for alias, col in columns().items()]
        return getattr(c, source).select("trip_key", *made)


_derived(
    "p1_numeric_casts",
    "trips",
    lambda: {
        "battery": derive.to_number("sensor_battery"),
        "route_no": F.substring("route_id", 4, 10).try_cast("double"),
        "bad_text": derive.to_number("route_id"),
    },
    {
        "battery": "cast(sensor_battery as double)",
        "route_no": "try_cast(substr(route_id, 4) as double)",
        "bad_text": "try_cast(route_id as double)",
    },
)
_derived(
    "p2_boolean_casts",
    "trips",
    lambda: {
        "braking": derive.to_boolean("braking_event"),
        "braking_flag": derive.flag("braking_event"),
        "from_number": F.col("device_generation").cast("boolean"),
    },
    {
        "braking": "cast(braking_event as boolean)",
        "braking_flag": "cast(braking_event as int)",
        "from_number": "device_generation <> 0",
    },
)
_derived(
    "p3_lower_case",
    "trips",
    lambda: {n: F.lower(n) for n in derive.LOWERED},
    {n: f"lower({n})" for n in derive.LOWERED},
)
_derived(
    "p4_hour_of_day",
    "trips",
    lambda: {"hour_of_day": F.hour("timestamp")},
    {"hour_of_day": 'cast(hour("timestamp") as int)'},
)
_derived(
    "p5_age_band",
    "trips",
    lambda: {"vehicle_age_group": derive.age_band()},
    {
        "vehicle_age_group": "case when vehicle_age_years <= 3 then '0-3'"
        " when vehicle_age_years in (4, 5, 6) then '4-6'"
        " when vehicle_age_years in (7, 8, 9) then '7-9' else '10+' end"
    },
)
_derived(
    "p6_litres_per_km_batch",
    "valid",
    lambda: {"l_per_km": derive.litres_per_km(2)},
    {
        "l_per_km": "cast(round(cast(cast(fuel_consumption_liters / nullif(distance_traveled_km, 0)"
        " as varchar) as decimal(38,20)), 2) as double)"
    },
)
_derived(
    "p7_litres_per_km_stream",
    "stream",
    lambda: {"l_per_km": derive.litres_per_km(3)},
    {
        "l_per_km": "cast(round(cast(cast(fuel_consumption_liters / nullif(distance_traveled_km, 0)"
        " as varchar) as decimal(38,20)), 3) as double)"
    },
)
_derived(
    "p8_downtime_flag",
    "trips",
    lambda: {"downtime_flag": derive.downtime_flag()},
    {"downtime_flag": "case when downtime_hours > 0 then 1 else 0 end"},
)
_derived(
    "p9_new_device",
    "trips",
    lambda: {"new_device": derive.new_device(2), "newest_device": derive.new_device(3)},
    {
        "new_device": "coalesce(device_generation >= 2, false)",
        "newest_device": "coalesce(device_generation >= 3, false)",
    },
)
_derived(
    "p10_risky_event",
    "trips",
    lambda: {"risky_event": derive.risky_event()},
    {
        "risky_event": "cast(collision_alert or harsh_acceleration_event or braking_event as int)",
    },
)
_derived(
    "p16_group_label",
    "trips",
    lambda: {
        "device_label": derive.label_for(derive.new_device(), "New Device", "Old Device"),
        "feedback_label": derive.label_for("intervention_active", "Feedback ON", "Feedback OFF"),
    },
    {
        "device_label": "case when device_generation >= 2 then 'New Device' else 'Old Device' end",
        "feedback_label": "case when intervention_active then 'Feedback ON'"
        " else 'Feedback OFF' end",
    },
)
_derived(
    "p17_title_case",
    "trips",
    lambda: {"title": derive.title_case("maintenance_type")},
    {"title": "upper(maintenance_type[1]) || lower(maintenance_type[2:])"},
)
_derived(
    "p18_rush_hour",
    "trips",
    lambda: {"rush": derive.rush_hour(F.hour("timestamp"))},
    {"rush": 'hour("timestamp") in (7, 8, 9, 16, 17, 18)'},
)
_derived(
    "p19_event_type",
    "trips",
    lambda: {"derived_event": derive.event_type()},
    {
        "derived_event": "coalesce(case when collision_alert then 'collision' end,"
        " case when sensor_fault_event then 'sensor_fault' end,"
        " case when gps_loss_event then 'gps_loss' end,"
        " case when network_delay_event then 'network_delay' end,"
        " case when harsh_acceleration_event then 'harsh_acceleration' end,"
        " case when braking_event then 'braking' end,"
        " case when lane_change_event then 'lane_change' end, 'normal')"
    },
)
_derived(
    "p20_safe_label",
    "trips",
    lambda: {"is_safe": derive.safe_label()},
    {"is_safe": "not collision_alert and not sensor_fault_event and not breakdown_event"},
)
_BURN = "case vehicle_type when 'car' then 0.04e0 when 'van' then 0.06e0 when 'truck' then 0.1e0 end"
_derived(
    "p22_expected_fuel",
    "trips",
    lambda: {"expected": derive.expected_fuel()},
    {
        "expected": r6(
            f"distance_traveled_km * fuel_rate_l_per_100km / 100 + idle_time_minutes * {_BURN}"
        )
    },
    digits=True,
)

ROUTE = [
    "fuel_per_km", "idle_ratio", "day_of_week", "optimized_x_experience", "vehicle_type_truck",
    "vehicle_type_van",
]


@check(
    "p11_p14_route_features",
    f"""select trip_key,
  {r6('fuel_consumption_liters / (distance_traveled_km + 0.001e0)')} as fuel_per_km,
  {r6('idle_time_minutes / (distance_traveled_km + 0.001e0)')} as idle_ratio,
  cast(isodow("timestamp") - 1 as int) as day_of_week,
  cast(optimized_route_flag as int) * driver_experience_years as optimized_x_experience,
  case when vehicle_type = 'truck' then 1 else 0 end as vehicle_type_truck,
  case when vehicle_type = 'van' then 1 else 0 end as vehicle_type_van
from clean""",
)
def _(c: Context):
    return derive.route_features(c.clean).select("trip_key", *ROUTE)


@check(
    "p15_m21_breakdown_features",
    """select trip_key, cast(rush_hour as int) as rush_hour,
  case when lower(maintenance_type) = 'predictive' then 1 else 0 end as maintenance_type,
  case when lower(maintenance_type) = 'predictive' then vehicle_age_years else 0 end
    as maintenance_x_vehicle_age,
  cast(breakdown_event as int) as label, vehicle_age_years, sensor_battery
from clean where vehicle_age_years is not null and sensor_battery is not null
  and packet_loss_rate is not null and breakdown_event is not null""",
    keep_digits=True,
)
def _(c: Context):
    needed = ["vehicle_age_years", "sensor_battery", "packet_loss_rate", "label"]
    made = rules.complete(derive.breakdown_features(c.clean), needed)
    return made.select(
        "trip_key", "rush_hour", "maintenance_type", "maintenance_x_vehicle_age", "label",
        "vehicle_age_years", "sensor_battery",
    )


@check(
    "p21_label_contradictions",
    f"""select event_type, count(*) as n,
  cast(count(*) filter (where risk_label = (collision_alert or sensor_fault_event
    or breakdown_event)) as bigint) as n_contradicting,
  {r6('''avg(case when risk_label = (collision_alert or sensor_fault_event or breakdown_event)
    then 1e0 else 0e0 end)''')} as contradiction_rate
from trips group by event_type""",
)
def _(c: Context):
    return quality.label_contradictions(c.trips)


@check(
    "p22_fuel_residuals",
    f"""select vehicle_type, count(f - x) as n, {r6('avg(x)')} as avg_expected,
  {r6('avg(f - x)')} as avg_residual, {r6('max(abs(f - x))')} as max_abs_residual
from (select vehicle_type, fuel_consumption_liters as f,
    distance_traveled_km * fuel_rate_l_per_100km / 100 + idle_time_minutes * {_BURN} as x
  from trips) group by vehicle_type""",
)
def _(c: Context):
    return quality.fuel_residuals(c.trips)


# ---------------------------------------------------------------- joins and aggregates


@check(
    "a1_event_summary",
    f"""select event_type, count(*) as event_count, {r6('avg(speed)')} as avg_speed,
  {r6('avg(sensor_battery)')} as avg_battery,
  {r6('avg(fuel_efficiency_l_per_km)')} as avg_fuel_efficiency
from clean group by event_type""",
)
def _(c: Context):
    return aggregates.event_summary(c.cleaned_now)


@check(
    "a2_vehicle_means",
    f"""select vehicle_id, {r6('avg(downtime_hours)')} as mean_downtime,
  {r6('avg(cast(breakdown_event as int))')} as breakdown_rate, count(*) as n_records
from clean group by vehicle_id""",
)
def _(c: Context):
    return aggregates.vehicle_means(c.clean)


DOMINANT = """
dominant as (
  select vehicle_id, {0} as category from (
    select vehicle_id, {0}, row_number() over (partition by vehicle_id
      order by count(*) desc, {0}) as place
    from clean where {0} is not null group by vehicle_id, {0}) where place = 1)"""


@check(
    "a3_w2_dominant_category",
    "select vehicle_id, category as road_type_mode from dominant",
    ctes=DOMINANT.format("road_type"),
)
def _(c: Context):
    return aggregates.dominant_category(c.clean, "vehicle_id", "road_type")


_JOINED = f"""select v.vehicle_id, {r6('avg(downtime_hours)')} as mean_downtime,
  {r6('avg(cast(breakdown_event as int))')} as breakdown_rate, count(*) as n_records,
  any_value(category) as maintenance_type_mode
from clean v left join dominant d on v.vehicle_id = d.vehicle_id group by v.vehicle_id"""


@check("j1_vehicle_left_join", _JOINED, ctes=DOMINANT.format("maintenance_type"))
def _(c: Context):
    return aggregates.with_dominant_category(c.clean)


@check("j1_vehicle_summary_one_pass", _JOINED, ctes=DOMINANT.format("maintenance_type"))
def _(c: Context):
    return aggregates.vehicle_summary(c.clean)


@check(
    "j3_treated_share",
    f"""select trip_key, {r6('''(select avg(cast(intervention_active as int)) from clean)''')}
  as treated_share from clean""",
)
def _(c: Context):
    share = c.clean.agg(F.avg(derive.flag("intervention_active")))
    return c.clean.select("trip_key", share.scalar().alias("treated_share"))


@check(
    "a4_arm_summary",
    f"""select optimized_route_flag, {r6('avg(fuel_consumption_liters)')} as mean,
  {r6('stddev_samp(fuel_consumption_liters)')} as std, count(fuel_consumption_liters) as "count"
from clean group by 1""",
)
def _(c: Context):
    return aggregates.arm_summary(c.clean, "optimized_route_flag", "fuel_consumption_liters")


@check(
    "a6_event_rate",
    f"""select maintenance_type, {r6('avg(cast(breakdown_event as int))')} as event_rate,
  count(*) as n from clean where maintenance_type is not null group by 1""",
)
def _(c: Context):
    return aggregates.event_rate(c.clean, "maintenance_type", "breakdown_event")


@check(
    "a7_conditional_counts",
    """select road_type, cast(sum(case when braking_event then 1 else 0 end) as bigint)
  as braking_events, cast(sum(case when collision_alert then 1 else 0 end) as bigint)
  as collision_alerts from clean group by road_type""",
)
def _(c: Context):
    return c.clean.groupBy("road_type").agg(
        F.count_if("braking_event").alias("braking_events"),
        F.count_if("collision_alert").alias("collision_alerts"),
    )


@check(
    "a8_contingency",
    " union all ".join(
        f"""select '{e}' as metric,
  cast(count(*) filter (where device_generation >= 2 and {e}) as bigint) as t1,
  cast(count(*) filter (where device_generation >= 2 and not {e}) as bigint) as t0,
  cast(count(*) filter (where device_generation < 2 and {e}) as bigint) as c1,
  cast(count(*) filter (where device_generation < 2 and not {e}) as bigint) as c0 from clean"""
        for e in ("breakdown_event", "collision_alert", "harsh_acceleration_event",
                  "braking_event", "sensor_fault_event", "gps_loss_event", "network_delay_event")
    ),
)
def _(c: Context):
    from roadlens.schema import DEVICE_RATES

    return aggregates.contingency(
        c.clean.withColumn("new_device", derive.new_device()), "new_device", DEVICE_RATES
    )


@check(
    "a9_pooled_rate",
    f"""select {r6('avg(y)')} as pooled_rate, {r6('avg(y) filter (where t)')} as treated_rate,
  {r6('avg(y) filter (where not t)')} as control_rate,
  cast(count(*) filter (where t) as bigint) as n_treated,
  cast(count(*) filter (where not t) as bigint) as n_control
from (select intervention_active as t,
    case when collision_alert or harsh_acceleration_event or braking_event then 1 else 0 end as y
  from clean)""",
)
def _(c: Context):
    return aggregates.pooled_rate(c.clean, "intervention_active", derive.risky_event())


@check(
    "a11_global_average",
    f"""select {r6('avg(fuel_efficiency_l_per_km)')} as avg_fuel_efficiency,
  max("timestamp") as last_recorded from stream""",
)
def _(c: Context):
    return c.stream.agg(
        F.avg("fuel_efficiency_l_per_km").alias("avg_fuel_efficiency"),
        F.max("timestamp").alias("last_recorded"),
    )


@check(
    "a12_class_counts",
    "select cast(breakdown_event as int) as label, count(*) as n from clean group by 1",
)
def _(c: Context):
    return aggregates.class_counts(derive.breakdown_features(c.clean), "label")


MISSING = ["latitude", "longitude", "fuel_consumption_liters", "downtime_hours", "speed"]


@check(
    "a13_null_counts",
    " union all ".join(
        f"select '{m}' as column_name, cast(count(*) - count({m}) as bigint) as n_null from trips"
        for m in MISSING
    ),
)
def _(c: Context):
    return aggregates.null_counts(c.trips, MISSING)


@check(
    "a16_sanity_rates",
    "select count(*) as n, "
    + ", ".join(
        f"{r6(f'avg(cast({e} as int))')} as {e}_rate"
        for e in ("collision_alert", "sensor_fault_event", "harsh_acceleration_event",
                  "braking_event")
    )
    + ", round(avg(fuel_consumption_liters), 2) as mean_fuel,"
    " round(avg(downtime_hours), 2) as mean_downtime from trips",
)
def _(c: Context):
    return aggregates.sanity_rates(c.trips)
