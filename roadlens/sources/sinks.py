"""Writing result tables: Parquet, CSV, catalog tables, databases; retention on disk."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.sources.tables import retain_since
from roadlens.session import durable

DATE = "event_date"


def with_event_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(DATE, F.to_date(ts))


def write_parquet(df: DataFrame, path: str, by_date: bool = True, ts: str = "timestamp") -> None:
    """Overwrites a Parquet folder, one sub-folder per day, so that time ranges and retention
    touch only their days. Rows of a day meet in few tasks first, a hot day in several."""
    if not by_date:
        df.write.mode("overwrite").parquet(path)
        return
    dated = with_event_date(df, ts)
    spread = dated.hint("rebalance", F.col(DATE))
    spread.write.mode("overwrite").partitionBy(DATE).parquet(path)


def write_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Appends after checking the columns against the table; the append commits as a whole."""
    have = df.sparkSession.table(table).schema
    want = {f.name: f.dataType for f in have}
    given = {f.name: f.dataType for f in df.schema}
    if want != given:
        odd = sorted(set(want.items()) ^ set(given.items()), key=str)
        raise ValueError(f"columns do not fit table {table}: {odd}")
    df.select(*have.names).write.mode("append").format("parquet").saveAsTable(table)


def ensure_table(
    spark: SparkSession, table: str, ddl: str, partitioned_by: Sequence[str] = ()
) -> None:
    """Creates the table unless it exists."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{parts}")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_rows: int = 10_000,
    connections: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Writes to a database table over at most ``connections`` connections."""
    options = {
        "url": url, "dbtable": table, "batchsize": str(batch_rows),
        "numPartitions": str(connections), **(properties or {}),
    }
    df.write.format("jdbc").mode(mode).options(**options).save()


def export(df: DataFrame, path: str) -> None:
    """A result table as ``<path>.csv`` (with header) and ``<path>.parquet``; computed once."""
    kept = durable(df)
    kept.write.mode("overwrite").option("header", True).csv(f"{path}.csv")
    kept.write.mode("overwrite").parquet(f"{path}.parquet")


def purge_before(
    spark: SparkSession, path: str, as_of: datetime, days: int = 3, ts: str = "timestamp"
) -> None:
    """Deletes rows older than ``days`` before ``as_of`` from a folder written by day.

    Whole days are removed as folders, only the boundary day is rewritten.
    """
    oldest = as_of - timedelta(days=days)
    boundary = oldest.date()
    day = spark.read.parquet(path).filter(F.col(DATE) == F.lit(boundary))
    kept = durable(retain_since(day, as_of, days, ts))
    if not kept.isEmpty():
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            DATE
        ).parquet(path)
        last_gone = boundary - timedelta(days=1)
    else:
        last_gone = boundary
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{DATE}=") and name[len(DATE) + 1 :] <= last_gone.isoformat():
            fs.delete(status.getPath(), True)
