"""Small helpers on DataFrames that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadlens.session import scratch_path

DEFAULT_BATCH = "67108864b"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, and a lost executor
    costs a read instead of a second computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns renamed by place, so that none clashes with an operator's own, and the new
    names by the old."""
    names = {name: f"__c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def unmasked(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``masked`` alone, under their old names."""
    return df.select([F.col(new).alias(old) for old, new in names.items()])


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, unless the session has a size of its own: Python workers hold a
    batch of whole texts several times over."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BATCH:
        spark.conf.set(key, "8m")


def map_batches(df: DataFrame, schema: str | StructType, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``fn`` applied to every Arrow batch."""

    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def words_in(column: str) -> F.Column:
    """Number of words in a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: F.Column, name: str, buckets: int = 1024
) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the rows before this one in ``order`` within its group.

    The first column of ``order`` is a hexadecimal digest of 8 characters at least. Its leading bits
    split a group into ``buckets`` ranges that are summed apart, so that no group, however large,
    has to be ordered in one task; the ranges' totals are the offsets. Null groups are groups.
    """
    df = df.withColumn(
        "_range", F.floor(F.conv(F.substring(order[0], 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int")
    ).withColumn("_value", value)
    totals = df.groupBy(*group, "_range").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
    )
    on = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        on &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = (
        Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, on, "left")
        .withColumn(name, F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_range", "_value", "_inside", "_r", "_before", *[f"_g{i}" for i in range(len(group))])
    )
