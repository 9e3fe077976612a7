"""Numbers about a run, collected while the run's own job passes over the rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS_DDL = "run string, finished timestamp, metric string, value double"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is known once an action has run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def metric_rows(spark: SparkSession, run: str, values: dict[str, float]) -> DataFrame:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(run, now, name, float(value)) for name, value in values.items()]
    return spark.createDataFrame(rows, METRICS_DDL)


def record(spark: SparkSession, path: str, run: str, values: dict[str, float]) -> None:
    """Appends one row per metric to the metrics folder."""
    metric_rows(spark, run, values).coalesce(1).write.mode("append").parquet(path)
