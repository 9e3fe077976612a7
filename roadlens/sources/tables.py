"""Scans of trip tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.rules import keep_valid


def read_trips(
    spark: SparkSession,
    source: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    valid_only: bool = False,
) -> DataFrame:
    """A trip table from a catalog name or a Parquet path, pruned to ``columns``.

    The validity rules are plain filters, so they run inside the scan.
    """
    if "/" in source:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(source)
    else:
        df = spark.table(source)
    if valid_only:
        df = keep_valid(df)
    return df.select(*columns) if columns else df


def read_trips_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: dict[str, str] | None = None,
    valid_only: bool = True,
) -> DataFrame:
    """A trip table of a database, read over ``partitions`` connections.

    ``lower`` and ``upper`` only place the partition borders; rows outside them are still read.
    Filters on the result are pushed into the database by the reader.
    """
    options = {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        "pushDownPredicate": "true",
        **(properties or {}),
    }
    df = spark.read.format("jdbc").options(**options).load()
    return keep_valid(df) if valid_only else df


def retain_since(df: DataFrame, as_of, days: int = 3, ts: str = "timestamp") -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; rows without a time are kept."""
    oldest = F.lit(as_of).cast("timestamp") - F.expr(f"interval {int(days)} days")
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= oldest))
