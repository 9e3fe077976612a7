"""Column contract of the trip fact table and the column lists of the reports.

All names, types and number ranges here are fixed values: they have to match the tables that
users already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip record, one row per trip.
TRIP_DDL = """
    vehicle_id string, driver_id string, route_id string, timestamp timestamp,
    latitude double, longitude double, hour_of_day int,
    weather string, road_type string, traffic_density string, rush_hour boolean,
    vehicle_type string, vehicle_age_years int, device_generation int, device_cost_usd double,
    driver_experience_years int, driver_training string, optimized_route_flag boolean,
    speed double, distance_traveled_km double, idle_time_minutes double,
    fuel_consumption_liters double, fuel_rate_l_per_100km double,
    sensor_battery double, sensor_signal_strength double, data_latency_ms double,
    gps_accuracy_meters double, packet_loss_rate double,
    braking_event boolean, collision_alert boolean, lane_change_event boolean,
    harsh_acceleration_event boolean, sensor_fault_event boolean,
    network_delay_event boolean, gps_loss_event boolean, event_type string,
    maintenance_type string, time_since_last_maintenance_days double,
    breakdown_event boolean, downtime_hours double, maintenance_cost_usd double,
    intervention_active boolean, risk_label boolean
"""
STREAM_DDL = TRIP_DDL + ", fuel_efficiency_l_per_km double"
CLEAN_DDL = STREAM_DDL + ", vehicle_age_group string, downtime_flag int"

_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
    "int": T.IntegerType(), "boolean": T.BooleanType(),
}


def _struct(ddl: str) -> T.StructType:
    fields = [field.split() for field in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


TRIP_SCHEMA = _struct(TRIP_DDL)
STREAM_SCHEMA = _struct(STREAM_DDL)
CLEAN_SCHEMA = _struct(CLEAN_DDL)

# Category domains.
WEATHER = ("sunny", "rainy", "foggy", "snowy", "cloudy")
ROAD_TYPES = ("highway", "city", "rural")
TRAFFIC = ("low", "medium", "high")
VEHICLE_TYPES = ("car", "van", "truck")
MAINTENANCE = ("predictive", "scheduled")

# Event flags in priority order with the name each one gives to event_type.
EVENT_PRIORITY = (
    ("collision_alert", "collision"),
    ("sensor_fault_event", "sensor_fault"),
    ("gps_loss_event", "gps_loss"),
    ("network_delay_event", "network_delay"),
    ("harsh_acceleration_event", "harsh_acceleration"),
    ("braking_event", "braking"),
    ("lane_change_event", "lane_change"),
)

# Litres burnt per idle minute.
IDLE_BURN_L_PER_MIN = {"car": 0.04, "van": 0.06, "truck": 0.10}

# Metrics of the A/B reports.
DEVICE_RATES = (
    "breakdown_event", "collision_alert", "harsh_acceleration_event", "braking_event",
    "sensor_fault_event", "gps_loss_event", "network_delay_event",
)
DEVICE_MEANS = (
    "fuel_rate_l_per_100km", "downtime_hours", "maintenance_cost_usd",
    "data_latency_ms", "gps_accuracy_meters", "packet_loss_rate",
)
FEEDBACK_RATES = ("harsh_acceleration_event", "braking_event")
FEEDBACK_MEANS = ("maintenance_cost_usd", "downtime_hours")

# Covariates of the propensity and uplift models.
CONTEXT_CATEGORIES = ("road_type", "traffic_density", "weather", "vehicle_type", "driver_training")
DEVICE_IPW_NUMERIC = (
    "hour_of_day", "rush_hour", "driver_experience_years", "vehicle_age_years", "speed",
    "idle_time_minutes", "distance_traveled_km", "time_since_last_maintenance_days",
)
DEVICE_IPW_OUTCOMES = (
    "fuel_rate_l_per_100km", "downtime_hours", "maintenance_cost_usd", "breakdown_event",
)
FEEDBACK_IPW_NUMERIC = (
    "hour_of_day", "driver_experience_years", "speed", "idle_time_minutes", "vehicle_age_years",
    "device_generation", "data_latency_ms", "gps_accuracy_meters", "packet_loss_rate",
    "sensor_battery", "distance_traveled_km", "fuel_rate_l_per_100km",
    "time_since_last_maintenance_days",
)
FEEDBACK_IPW_OUTCOMES = ("harsh_acceleration_event", "maintenance_cost_usd", "downtime_hours")
FEEDBACK_UPLIFT_NUMERIC = FEEDBACK_IPW_NUMERIC + ("rush_hour",)

# Features of the supervised models.
BREAKDOWN_FEATURES = (
    "vehicle_age_years", "device_generation", "time_since_last_maintenance_days", "speed",
    "idle_time_minutes", "data_latency_ms", "gps_accuracy_meters", "packet_loss_rate",
    "sensor_battery", "rush_hour", "maintenance_type", "maintenance_x_vehicle_age",
)
RISK_FEATURES = (
    "driver_experience_years", "vehicle_age_years", "fuel_efficiency_l_per_km",
    "intervention_active",
)
FUEL_FEATURES = (
    "speed", "distance_traveled_km", "idle_time_minutes", "vehicle_age_years",
    "fuel_efficiency_l_per_km", "optimized_route_flag", "fuel_per_km", "idle_ratio",
    "optimized_x_experience", "hour_of_day", "day_of_week",
    "vehicle_type_truck", "vehicle_type_van",
)
FUEL_LEAKY = ("fuel_per_km", "fuel_efficiency_l_per_km")
