"""Reproducible splits: membership depends on a row's key alone, never on order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.hashing import HASH_BITS, key_hash

_LOW_BITS = HASH_BITS - 16


def hash_split(
    df: DataFrame, key: str, share: float, salt: str = "", out: str = "is_test"
) -> DataFrame:
    """Marks about ``share`` of the rows, with no extra pass over the data. Rows without a key are
    not marked."""
    chosen = key_hash(key, salt) < F.lit(int(share * 2**HASH_BITS))
    return df.withColumn(out, F.coalesce(chosen, F.lit(False)))


def _stratum(strata: Sequence[str]) -> Column:
    """The columns themselves as one key: no text can make two strata one. NULL is a value."""
    return F.struct(*[F.col(c) for c in strata]) if strata else F.struct(F.lit(0).alias("all"))


def _reached(counts: DataFrame, order: str) -> DataFrame:
    """Per stratum the first row of ``order`` where the running count reaches ``wanted``."""
    running = Window.partitionBy("_stratum").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = counts.withColumn("_upto", F.sum("n").over(running))
    return summed.filter(
        (F.col("_upto") >= F.col("wanted")) & (F.col("_upto") - F.col("n") < F.col("wanted"))
    )


def lowest_hash_cut(hashed: DataFrame, wanted: Column) -> DataFrame:
    """``(_stratum, _cut)``: the hash up to which exactly ``wanted`` rows of the stratum lie.

    ``hashed`` has ``_stratum`` and ``_h``; ``wanted`` may use the stratum size ``n_rows``. Selected
    by digits: counts per leading 16 bits find the bucket of the cut, then only the rows of that
    bucket (one in 65536) are looked at. Rows of equal hash stay together.
    """
    bucketed = hashed.withColumn("_bucket", F.shiftright("_h", _LOW_BITS))
    buckets = bucketed.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    sized = buckets.withColumn("n_rows", F.sum("n").over(Window.partitionBy("_stratum")))
    border = _reached(sized.withColumn("wanted", wanted.cast("bigint")), "_bucket").select(
        "_stratum", "_bucket", (F.col("wanted") - (F.col("_upto") - F.col("n"))).alias("wanted")
    )
    inside = bucketed.join(border, ["_stratum", "_bucket"])
    hashes = inside.groupBy("_stratum", "_h", "wanted").agg(F.count(F.lit(1)).alias("n"))
    return _reached(hashes, "_h").select("_stratum", F.col("_h").alias("_cut"))


def stratified_split(
    df: DataFrame,
    key: str,
    share: float,
    strata: Sequence[str] = (),
    salt: str = "",
    out: str = "is_test",
) -> DataFrame:
    """Marks the rows with the lowest key hashes, exactly ``round(share * n)`` of every stratum."""
    hashed = df.withColumn("_stratum", _stratum(strata)).withColumn("_h", key_hash(key, salt))
    wanted = F.floor(F.col("n_rows") * F.lit(float(share)) + 0.5)
    cuts = lowest_hash_cut(hashed.select("_stratum", "_h"), wanted)
    # One small row per stratum goes to the rows: rows joined by stratum would meet in a few tasks.
    marked = hashed.join(F.broadcast(cuts), "_stratum", "left")
    chosen = F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))
    return marked.withColumn(out, chosen).select(*df.columns, out)


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Adds n / (classes * n_class), the balanced weight of the row's class. Rows without a label keep
    NULL as their weight and are not counted."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    weights = counts.select(
        label,
        (F.sum("_n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("_n"))).alias(
            out
        ),
    )
    # One row per class goes to the rows: rows joined by class would meet in as many tasks as there are classes.
    return df.join(F.broadcast(weights), label, "left").select(*df.columns, out)
