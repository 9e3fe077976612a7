"""Dashboard tables."""

from __future__ import annotations

from checks.base import Context, check, r6
from roadlens.operators import panels

RUSH = "case when rush_hour then 'Rush Hour' else 'Non-Rush Hour' end"


def _panel(name: str, sql: str, fn, keep_digits: bool = False) -> None:
    @check(name, sql, keep_digits=keep_digits)
    def _(c: Context):
        return fn(c.stream)


def _buckets(unit: str, key: str, agg: str) -> str:
    return (
        f'select date_trunc(\'{unit}\', "timestamp") as "time", {key}, {agg}'
        f" from stream group by 1, 2"
    )


_panel(
    "d1_driver_labels",
    "select driver_id, driver_experience_years, driver_training,"
    " cast(count(*) filter (where risk_label) as bigint) as total_risk_events"
    " from stream group by 1, 2, 3",
    panels.driver_labels,
)
_panel(
    "d1_driver_risky_trips",
    "select driver_id, driver_experience_years, driver_training,"
    " cast(count(*) filter (where not risk_label) as bigint) as total_risk_events"
    " from stream group by 1, 2, 3",
    lambda df: panels.driver_labels(df, risky_value=False),
)
_panel(
    "d2_hourly_labels",
    'select date_trunc(\'hour\', "timestamp") as "time",'
    " cast(count(*) filter (where risk_label) as bigint) as risk_events from stream group by 1",
    panels.hourly_labels,
)
_panel(
    "d3_driving_flags",
    'select "timestamp" as "time", driver_id, harsh_acceleration_event, lane_change_event'
    " from stream",
    panels.driving_flags,
    keep_digits=True,
)
_panel(
    "d4_fuel_by_vehicle_type",
    f"""select vehicle_type, {r6('avg(fuel_consumption_liters)')} as avg_fuel_consumption,
  {r6('avg(fuel_efficiency_l_per_km)')} as avg_fuel_efficiency,
  max("timestamp") as last_recorded from stream group by 1""",
    panels.fuel_by_vehicle_type,
)
_panel(
    "d5_average_efficiency",
    f"select {r6('avg(fuel_efficiency_l_per_km)')} as avg_fuel_efficiency from stream",
    panels.average_efficiency,
)
_panel(
    "d6_hourly_fuel",
    _buckets(
        "hour", "vehicle_type", f"{r6('avg(fuel_consumption_liters)')} as avg_fuel_consumption"
    ),
    panels.hourly_fuel,
)
_panel(
    "d7_daily_maintenance",
    _buckets("day", "maintenance_type", 'count(*) as "count"'),
    panels.daily_maintenance,
)
_panel(
    "d8_latest_breakdowns",
    'select "timestamp", vehicle_id, maintenance_type, downtime_hours, maintenance_cost_usd,'
    " breakdown_event from stream where breakdown_event"
    ' order by "timestamp" desc, vehicle_id, downtime_hours nulls first, maintenance_cost_usd'
    " limit 100",
    panels.latest_breakdowns,
    keep_digits=True,
)
_panel(
    "d9_downtime_series",
    'select "timestamp" as "time", downtime_hours, maintenance_cost_usd from stream',
    panels.downtime_series,
    keep_digits=True,
)
_panel(
    "d10_event_counts_by_time",
    'select "timestamp" as "time",'
    " cast(count(*) filter (where braking_event) as bigint) as braking_events,"
    " cast(count(*) filter (where collision_alert) as bigint) as collision_alerts"
    " from stream group by 1",
    panels.event_counts_by_time,
)
_panel(
    "d11_daily_road_types",
    _buckets("day", "road_type", 'count(*) as "count"'),
    panels.daily_road_types,
)
_panel(
    "d12_hourly_traffic",
    _buckets("hour", "traffic_density", 'count(*) as "count"'),
    panels.hourly_traffic,
)
_panel(
    "d13_rush_counts",
    f'select {RUSH} as rush_status, count(*) as "count" from stream group by 1',
    panels.rush_counts,
)
_panel(
    "d14_vehicle_snapshot",
    f'select "timestamp" as "time", vehicle_id, speed, {RUSH} as rush_status from stream',
    panels.vehicle_activity,
    keep_digits=True,
)
_panel(
    "d15_activity_series_in_range",
    f'select "timestamp" as "time", vehicle_id, speed, {RUSH} as rush_status from stream'
    " where \"timestamp\" >= timestamp '1997-01-01 00:00:00'",
    lambda df: panels.vehicle_activity(df, start="1997-01-01 00:00:00"),
    keep_digits=True,
)
