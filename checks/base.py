"""Registry of checked queries: a Spark callable and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.trips import TRIPS_CTE, build_trips, is_stored, stored, trips
from roadlens.functions import derive, rules
from roadlens.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

KM = (
    "round(cast(cast(fuel_consumption_liters / nullif(distance_traveled_km, 0) as varchar)"
    " as decimal(38,20)), {})"
)
CLEAN_CTE = f"""
valid as (
  select * from trips
  where latitude between 40.4774 and 40.9176 and longitude between -74.2591 and -73.7004
    and speed between 0 and 160 and sensor_battery between 0 and 100
    and (fuel_consumption_liters is null or fuel_consumption_liters > 0)
    and (downtime_hours is null or downtime_hours >= 0)),
clean as (
  select * replace (lower(weather) as weather, lower(road_type) as road_type,
                    lower(traffic_density) as traffic_density,
                    lower(driver_training) as driver_training,
                    cast(extract(hour from timestamp) as int) as hour_of_day),
    case when vehicle_age_years <= 3 then '0-3' when vehicle_age_years between 4 and 6 then '4-6'
         when vehicle_age_years between 7 and 9 then '7-9' else '10+' end as vehicle_age_group,
    cast({KM.format(2)} as double) as fuel_efficiency_l_per_km,
    case when downtime_hours > 0 then 1 else 0 end as downtime_flag
  from valid),
stream as (
  select *, cast({KM.format(3)} as double) as fuel_efficiency_l_per_km
  from trips where speed > 0)"""


_SHARED: dict[tuple, dict[str, DataFrame]] = {}


class Context:
    """Input frames of one run; nothing is read before a query asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def once(self, name: str, build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """Result tables of a flow that several queries look at; run once per application."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _SHARED:
            _SHARED[key] = build()
        return _SHARED[key]

    @cached_property
    def trips(self) -> DataFrame:
        return trips(self.spark, self.sf_dir)

    @cached_property
    def valid(self) -> DataFrame:
        return rules.keep_valid(self.trips)

    @cached_property
    def cleaned_now(self) -> DataFrame:
        """Validity rules and cleaning applied to the raw trips within the query itself."""
        return derive.clean(self.valid)

    @cached_property
    def clean(self) -> DataFrame:
        """The cleaned table, stored once per application, as the analyses find it."""
        return stored(self.spark, self.sf_dir, "cleaned", self._build_clean)

    def _build_clean(self) -> DataFrame:
        # The raw trips are not stored for this alone.
        kept = is_stored(self.spark, self.sf_dir, "trips")
        raw = self.trips if kept else build_trips(self.spark, self.sf_dir)
        return derive.clean(rules.keep_valid(raw))

    @cached_property
    def stream(self) -> DataFrame:
        return derive.stream_transform(self.trips)


def r6(expression: str) -> str:
    """SQL text that rounds a double to 6 digits the way ``rounded`` does."""
    return f"cast(round(cast(({expression}) as decimal(38,11)), 6) as double)"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at 6 digits, so that the order of summation cannot show."""
    return df.select(
        *[
            F.round(F.round(F.col(f"`{f.name}`"), 11), 6).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def check(name: str, sql: str | None = None, ctes: str = "", keep_digits: bool = False):
    """Registers a query; ``sql`` may use trips, valid, clean and stream."""

    def register(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = fn(Context(spark, sf_dir))
            return result if keep_digits else rounded(result)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            parts = [TRIPS_CTE, CLEAN_CTE] + ([ctes] if ctes else [])
            SQL[name] = "with " + ",\n".join(parts) + "\n" + sql.strip()
        return fn

    return register
