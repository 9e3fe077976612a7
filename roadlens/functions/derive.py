"""Derived columns, as Column builders and DataFrame steps shared by batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.schema import EVENT_PRIORITY, IDLE_BURN_L_PER_MIN

NUMERIC_CASTS = ("sensor_battery", "speed", "fuel_consumption_liters", "downtime_hours")
LOWERED = ("weather", "road_type", "traffic_density", "driver_training")


def flag(c: str | Column) -> Column:
    """Boolean as 0/1, NULL stays NULL."""
    return (F.col(c) if isinstance(c, str) else c).cast("boolean").cast("int")


def to_number(c: str) -> Column:
    """Numeric cast where text that is no number becomes NULL."""
    return F.col(c).try_cast("double")


def to_boolean(c: str) -> Column:
    return F.col(c).try_cast("boolean")


def age_band(c: str = "vehicle_age_years") -> Column:
    """0-3 / 4-6 / 7-9 / 10+; NULL and values between the bands fall into 10+."""
    age = F.col(c)
    return (
        F.when(age <= 3, "0-3")
        .when(age.between(4, 6), "4-6")
        .when(age.between(7, 9), "7-9")
        .otherwise("10+")
    )


def litres_per_km(
    digits: int, fuel: str = "fuel_consumption_liters", distance: str = "distance_traveled_km"
) -> Column:
    """Litres per km, NULL for distance zero; 2 digits in batch, 3 in the stream."""
    return F.round(F.try_divide(F.col(fuel), F.col(distance)), digits)


def downtime_flag(c: str = "downtime_hours") -> Column:
    return F.when(F.col(c) > 0, 1).otherwise(0)


def new_device(threshold: int = 2, c: str = "device_generation") -> Column:
    return F.coalesce(F.col(c) >= F.lit(threshold), F.lit(False))


def risky_event() -> Column:
    either = F.col("collision_alert") | F.col("harsh_acceleration_event") | F.col("braking_event")
    return either.cast("int")


def rush_hour(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(16, 18)


def event_type() -> Column:
    """Name of the first raised flag in priority order, else normal."""
    return F.coalesce(
        *[F.when(F.col(c), F.lit(name)) for c, name in EVENT_PRIORITY], F.lit("normal")
    )


def safe_label() -> Column:
    return ~(F.col("collision_alert") | F.col("sensor_fault_event") | F.col("breakdown_event"))


def expected_fuel() -> Column:
    """Litres a trip should take: motion at the recorded rate plus idle burn by vehicle type."""
    burn = F.lit(None).cast("double")
    for kind, rate in IDLE_BURN_L_PER_MIN.items():
        burn = F.when(F.col("vehicle_type") == kind, F.lit(rate)).otherwise(burn)
    motion = F.col("distance_traveled_km") * F.col("fuel_rate_l_per_100km") / 100
    return motion + F.col("idle_time_minutes") * burn


def fuel_audit(df: DataFrame) -> DataFrame:
    """Expected litres and how far the recorded value is from them."""
    return df.withColumn("expected_fuel_liters", expected_fuel()).withColumn(
        "fuel_residual_liters", F.col("fuel_consumption_liters") - F.col("expected_fuel_liters")
    )


def label_for(c: str | Column, yes: str, no: str) -> Column:
    """Text for a flag; NULL counts as ``no``."""
    return F.when(F.col(c) if isinstance(c, str) else c, yes).otherwise(no)


def title_case(c: str) -> Column:
    return F.initcap(F.col(c))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of floating columns becomes NULL, the one form of a missing number used here."""
    return df.withColumns(
        {
            f.name: F.when(~F.isnan(f.name), F.col(f.name))
            for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float")
        }
    )


def clean(df: DataFrame) -> DataFrame:
    """Casts, lower-cased categories and derived columns of the cleaned fact table.

    A column the input lacks is skipped together with what is derived from it.
    """
    have = set(df.columns)
    cast = {c: to_number(c) for c in NUMERIC_CASTS if c in have}
    lowered = {c: F.lower(F.col(c)) for c in LOWERED if c in have}
    df = df.withColumns({**cast, **lowered})
    derived: dict[str, Column] = {}
    if "timestamp" in have:
        derived["hour_of_day"] = F.hour("timestamp")
    if "vehicle_age_years" in have:
        derived["vehicle_age_group"] = age_band()
    if {"fuel_consumption_liters", "distance_traveled_km"} <= have:
        derived["fuel_efficiency_l_per_km"] = litres_per_km(2)
    if "downtime_hours" in have:
        derived["downtime_flag"] = downtime_flag()
    return df.withColumns(derived)


def stream_transform(df: DataFrame) -> DataFrame:
    """Efficiency (3 digits) and the moving-records filter, for a batch or a streaming frame."""
    moving = df.filter(F.col("speed") > 0)
    return moving.withColumn("fuel_efficiency_l_per_km", litres_per_km(3))


def dummies(df: DataFrame, c: str, categories: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 column per category in text order, the first one left out."""
    kept = sorted(categories)[1 if drop_first else 0 :]
    return df.withColumns(
        {f"{c}_{v}": F.coalesce(F.col(c) == v, F.lit(False)).cast("int") for v in kept}
    )


def route_features(df: DataFrame, vehicle_types: Sequence[str] = ("car", "van", "truck")) -> DataFrame:
    """Features of the fuel model: per-km ratios, calendar parts, interaction, vehicle dummies."""
    per_km = F.col("distance_traveled_km") + F.lit(1e-3)
    df = df.withColumns(
        {
            "fuel_per_km": F.try_divide(F.col("fuel_consumption_liters"), per_km),
            "idle_ratio": F.try_divide(F.col("idle_time_minutes"), per_km),
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": F.weekday("timestamp"),
            "optimized_x_experience": flag("optimized_route_flag") * F.col("driver_experience_years"),
        }
    )
    return dummies(df, "vehicle_type", vehicle_types)


def breakdown_features(df: DataFrame) -> DataFrame:
    """Maintenance and rush hour as 0/1 and the maintenance x age interaction."""
    predictive = F.coalesce(F.lower("maintenance_type") == "predictive", F.lit(False)).cast("int")
    return df.withColumns(
        {
            "rush_hour": flag("rush_hour"),
            "maintenance_type": predictive,
            "maintenance_x_vehicle_age": predictive * F.col("vehicle_age_years"),
            "label": flag("breakdown_event"),
        }
    )
