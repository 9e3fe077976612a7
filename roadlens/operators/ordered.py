"""Work that needs a global order (ranks, quantiles, running totals) without a one-task sort.

Quantiles are selected digit by digit and order nothing. For ranks and running totals, rows are
first reduced to one row per distinct value, range-partitioned, and written to the checkpoint
folder; totals of the slices then give every slice its starting offset. The checkpoint matters:
range bounds come from a sample, and offsets and rows have to agree on them, also after a lost
executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import durable


def prefix_sums(
    df: DataFrame, order: Sequence[Column], sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Adds, for every column of ``sums``, ``before_<c>`` (sum of the rows that come earlier in
    ``order`` within ``by``) and ``total_<c>``.

    ``order`` has to be a total order within ``by``. NULL in ``by`` is a group like any other.
    """
    ranged = durable(
        df.repartitionByRange(*[F.col(b) for b in by], *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    group = [F.col(b) for b in by] or [F.lit(0)]
    earlier = (Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group)
    slice_totals = ranged.groupBy(*by, "_slice").agg(*[F.sum(c).alias(c) for c in sums])
    keys = {b: f"_by{i}" for i, b in enumerate(by)}
    offsets = slice_totals.select(
        *[F.col(b).alias(k) for b, k in keys.items()],
        F.col("_slice").alias("_of"),
        *[
            F.coalesce(F.sum(c).over(across.orderBy("_slice").rowsBetween(*earlier)), F.lit(0))
            .alias(f"_offset_{c}")
            for c in sums
        ],
        *[F.sum(c).over(across).alias(f"total_{c}") for c in sums],
    )
    within = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(*earlier)
    running = ranged.withColumns(
        {f"_run_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sums}
    )
    same = F.col("_slice") == F.col("_of")
    for b, k in keys.items():
        same = same & F.col(b).eqNullSafe(F.col(k))
    joined = running.join(offsets, same)
    return joined.select(
        *df.columns,
        *[(F.col(f"_run_{c}") + F.col(f"_offset_{c}")).alias(f"before_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def value_counts(
    df: DataFrame,
    value: str,
    counts: dict[str, Column] | None = None,
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per distinct ``value`` with its counts and their running totals in value order."""
    counts = counts or {"n": F.lit(1)}
    usable = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    grouped = usable.groupBy(*by, value).agg(
        *[F.sum(c.cast("bigint")).alias(name) for name, c in counts.items()]
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    return prefix_sums(grouped, [order], list(counts), by)


def mid_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their count and the mean rank their ties share."""
    counted = value_counts(df, value, by=by)
    return counted.select(
        *by, value, "n", (F.col("before_n") + (F.col("n") + 1) / 2).alias("mid_rank")
    )


#: Steps a binade is cut into once its least and greatest value are known.
MANTISSA_STEPS = 1 << 16


def _binade(v: Column) -> Column:
    """Sign and power of two of a double, as one number in the order of the doubles."""
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0))) + 1200
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("int")


def _step(v: Column, lo: Column, hi: Column) -> Column:
    """Which of the even steps from ``lo`` to ``hi`` holds the value."""
    return F.floor(F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)) * MANTISSA_STEPS).cast("int")


def _beside(rows: DataFrame, counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the other columns of the one count they belong to, NULL keys included."""
    named = counted.withColumnsRenamed({k: f"{k}_of" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return rows.join(named, same).drop(*[f"{k}_of" for k in keys])


def quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per group, columns ``q0, q1, ...`` in the
    order of ``probs`` and ``n``.

    Selected digit by digit, without ordering the rows: counts per power of two name the one that holds
    a wanted rank, counts per step of its range name the step, and the values of that step, counted,
    have the rank. Every count is combined before it is shuffled; ranks that share a step share the work.
    NULL and NaN are left out, a NULL group is a group.
    """
    by = list(by)
    group = [f"_g{i}" for i in range(len(by))]
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull() & ~F.isnan(v)).select(
        *[F.col(b).alias(g) for b, g in zip(by, group)], v.alias("_v"), _binade(v).alias("_e")
    )

    def ranks(n: Column) -> Column:
        """Two ranks per quantile, with the number of the quantile and its end."""
        wanted = []
        for i, p in enumerate(probs):
            lower = F.floor((n - 1) * F.lit(float(p)))
            for side, rank in enumerate((lower, F.least(lower + 1, n - 1))):
                wanted.append(F.struct(F.lit(2 * i + side).alias("t"), rank.cast("bigint").alias("rank"), n.alias("n")))
        return F.array(*wanted)

    def holding(counted: DataFrame, within: Sequence[str], order: str) -> DataFrame:
        """Of the counts in ``order`` those that hold wanted ranks, with the ranks counted from their start."""
        place = Window.partitionBy(*within or [F.lit(0)]).orderBy(order)
        placed = counted.withColumn("_before", F.sum("_n").over(place) - F.col("_n"))
        here = F.filter(
            "_ranks", lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n"))
        )
        held = placed.withColumn("_ranks", here).filter(F.size("_ranks") > 0)
        moved = F.transform(
            "_ranks", lambda r: F.struct(r["t"].alias("t"), (r["rank"] - F.col("_before")).alias("rank"), r["n"].alias("n"))
        )
        return held.withColumn("_ranks", moved).drop("_before", "_n")

    number = F.count(F.lit(1)).alias("_n")
    binades = rows.groupBy(*group, "_e").agg(number, F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    whole = F.sum("_n").over(Window.partitionBy(*group or [F.lit(0)]))
    binades = holding(binades.withColumn("_ranks", ranks(whole)), group, "_e")
    step = _step(F.col("_v"), F.col("_lo"), F.col("_hi"))
    near = _beside(rows, binades, [*group, "_e"])
    steps = near.groupBy(*group, "_e", step.alias("_d")).agg(
        number, *[F.any_value(c).alias(c) for c in ("_lo", "_hi", "_ranks")]
    )
    steps = holding(steps, [*group, "_e"], "_d")
    closer = _beside(rows, steps, [*group, "_e"]).filter(step == F.col("_d"))
    values = closer.groupBy(*group, "_e", "_d", "_v").agg(number, F.any_value("_ranks").alias("_ranks"))
    found = holding(values, [*group, "_e", "_d"], "_v").select(*group, "_v", F.inline("_ranks"))
    ends = [F.max(F.when(F.col("t") == t, F.col("_v"))).alias(f"_t{t}") for t in range(2 * len(probs))]
    picked = found.groupBy(*group).agg(F.max("n").alias("n"), *ends)
    def between(i: int, p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(p))
        share = position - F.floor(position)
        low, high = F.col(f"_t{2 * i}"), F.col(f"_t{2 * i + 1}")
        return (low + (high - low) * share).alias(f"q{i}")

    return picked.select(
        *[F.col(g).alias(b) for g, b in zip(group, by)], "n", *[between(i, p) for i, p in enumerate(probs)]
    )


def quantile_bins(
    df: DataFrame, value: str, bins: int = 10, bin_col: str = "bin_no"
) -> DataFrame:
    """Bin number 1..bins by value range between equally spaced quantiles, right-closed.

    Equal edges leave a bin empty.
    """
    edges = quantiles(df, value, [i / bins for i in range(1, bins)]).drop("n")
    above = F.lit(1)
    for i in range(bins - 1):
        above = above + F.when(F.col(value) > F.col(f"_edges.q{i}"), 1).otherwise(0)
    # The edges are one row: a scalar subquery, no join.
    with_edges = df.withColumn("_edges", edges.select(F.struct("*")).scalar())
    return with_edges.withColumn(bin_col, above).drop("_edges")


def running_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Sequential rank 1..n over the whole frame; ``order`` must be total."""
    counted = prefix_sums(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"])
    return counted.withColumn(rank_col, F.col("before__one") + 1).select(*df.columns, rank_col)
