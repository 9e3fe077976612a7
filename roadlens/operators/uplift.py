"""Tables built on a predicted uplift column: deciles and targeting lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.aggregates import uplift_by_key
from roadlens.operators.ordered import quantile_bins, running_rank


def uplift_deciles(
    df: DataFrame, uplift: str, outcome: str, treatment: str, bins: int = 10
) -> DataFrame:
    """Observed mean outcome of controls minus treated per predicted-uplift decile.

    Bins are value ranges between exact quantiles; D1 holds the highest uplift. A bin that equal
    edges left empty shows zero counts. Ordered by label text, descending.
    """
    y = F.col(outcome).cast("double")
    treated = F.col(treatment).cast("boolean")
    binned = quantile_bins(df.filter(F.col(uplift).isNotNull()), uplift, bins)
    filled = binned.groupBy("bin_no").agg(
        (F.avg(F.when(~treated, y)) - F.avg(F.when(treated, y))).alias("obs_effect"),
        F.count(F.lit(1)).alias("n_bin"),
        F.count_if(treated).alias("n_treat"),
        F.count_if(~treated).alias("n_ctrl"),
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin_no"))
    label = F.concat(F.lit("D"), (F.lit(bins + 1) - F.col("bin_no")).cast("string"))
    return (
        every.join(filled, "bin_no", "left")
        .fillna(0, ["n_bin", "n_treat", "n_ctrl"])
        .select(label.alias("uplift_decile"), "bin_no", "obs_effect", "n_bin", "n_treat", "n_ctrl")
        .orderBy(F.desc("uplift_decile"))
    )


def targeting_list(df: DataFrame, key: str, uplifts: Sequence[str]) -> DataFrame:
    """Mean uplift per key ranked from the highest; ties go on with the next column, then the key."""
    means = uplift_by_key(df, key, uplifts)
    order = [F.desc(f"mean_{u}") for u in uplifts] + [F.asc(key)]
    return running_rank(means.filter(F.col(key).isNotNull()), order)
