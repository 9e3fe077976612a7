"""Quality of scores, from a long table ``(model, y, p)`` with y in {0, 1}."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.ordered import value_counts
from roadlens.session import durable

# Guard of the F1 denominators and the clip of probabilities in the log loss.
TINY = 1e-10
EPS = 2.220446049250313e-16


def score_curve(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per distinct score, highest first: true and false positives when cutting there."""
    y = F.col("y").cast("int")
    counted = value_counts(df, "p", {"pos": y, "neg": 1 - y}, by=by, descending=True)
    tp = F.col("before_pos") + F.col("pos")
    fp = F.col("before_neg") + F.col("neg")
    return counted.select(
        *by,
        F.col("p").alias("threshold"),
        "pos",
        "neg",
        tp.alias("tp"),
        fp.alias("fp"),
        F.col("total_pos").alias("n_pos"),
        F.col("total_neg").alias("n_neg"),
    )


def _precision() -> Column:
    return F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return F.try_divide(F.col("tp").cast("double"), F.col("n_pos"))


def _auc() -> Column:
    """Share of (positive, negative) pairs ranked right, ties half."""
    negatives_below = F.col("n_neg") - F.col("fp") + F.col("neg") / 2
    pairs = F.max("n_pos").cast("double") * F.max("n_neg")
    return F.try_divide(F.sum(F.col("pos") * negatives_below), pairs)


def _average_precision() -> Column:
    return F.sum(F.try_divide(F.col("pos").cast("double"), F.col("n_pos")) * _precision())


def model_table(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model: ROC-AUC, average precision, the threshold of best F1 (the lowest one on
    ties) with its F1, and the confusion counts there with their guarded precision, recall and F1.
    One curve serves all."""
    curve = score_curve(df, by)
    precision, recall = _precision(), _recall()
    f1 = 2 * (precision * recall) / (precision + recall + F.lit(TINY))
    point = F.struct(
        F.col("threshold").alias("best_threshold"), precision.alias("precision"),
        recall.alias("recall"), f1.alias("f1_score"), "tp", "fp", "n_pos", "n_neg",
    )
    best = F.max_by(point, F.struct(f1.alias("f1"), (-F.col("threshold")).alias("low")))
    rows = curve.groupBy(*by).agg(
        _auc().alias("roc_auc"), _average_precision().alias("pr_auc"), best.alias("best")
    )
    tp, fp = F.col("best.tp").cast("double"), F.col("best.fp")
    cut_precision = tp / (tp + fp + F.lit(TINY))
    cut_recall = tp / (F.col("best.n_pos") + F.lit(TINY))
    return rows.select(
        *by, "roc_auc", "pr_auc", "best.best_threshold",
        cut_precision.alias("precision"), cut_recall.alias("recall"), "best.f1_score",
        (F.col("best.n_neg") - fp).alias("tn"), fp.alias("fp"),
        (F.col("best.n_pos") - F.col("best.tp")).alias("fn"), F.col("best.tp").alias("tp"),
        (2 * cut_precision * cut_recall / (cut_precision + cut_recall + F.lit(TINY))).alias("f1"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return score_curve(df, by).groupBy(*by).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return score_curve(df, by).groupBy(*by).agg(_average_precision().alias("pr_auc"))


def best_threshold(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return model_table(df, by).select(
        *by, "best_threshold", "precision", "recall", "f1_score"
    )


def roc_points(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(fpr, tpr) per threshold and the origin, whose threshold is NULL."""
    curve = score_curve(df, by)
    points = curve.select(
        *by, "threshold",
        F.try_divide(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
        _recall().alias("tpr"),
    )
    origin = curve.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(recall, precision) per threshold, the closing point (0, 1) and the base rate."""
    curve = score_curve(df, by)
    base = F.try_divide(F.col("n_pos").cast("double"), F.col("n_pos") + F.col("n_neg"))
    points = curve.select(
        *by, "threshold", _recall().alias("recall"), _precision().alias("precision"),
        base.alias("base_rate"),
    )
    closing = curve.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"), F.max(base).alias("base_rate"),
    )
    return points.unionByName(closing)


def log_loss(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    p = F.least(F.greatest(F.col("p"), F.lit(EPS)), F.lit(1 - EPS))
    loss = F.when(F.col("y") == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.groupBy(*by).agg(F.avg(loss).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, threshold: float, by: Sequence[str] = ("model",)) -> DataFrame:
    """Confusion counts, precision, recall and F1 (guarded) when cutting at ``threshold``."""
    hit, real = F.col("p") >= threshold, F.col("y") == 1
    counts = df.groupBy(*by).agg(
        F.count_if(~hit & ~real).alias("tn"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"), F.count_if(hit & real).alias("tp"),
    )
    tp = F.col("tp").cast("double")
    scored = counts.withColumns(
        {
            "precision": tp / (F.col("tp") + F.col("fp") + F.lit(TINY)),
            "recall": tp / (F.col("tp") + F.col("fn") + F.lit(TINY)),
        }
    )
    both = F.col("precision") * F.col("recall")
    return scored.withColumn(
        "f1", 2 * both / (F.col("precision") + F.col("recall") + F.lit(TINY))
    )


def classification_report(df: DataFrame, label: str = "y", predicted: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    An undefined ratio counts as 0.
    """
    pairs = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    roles = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), "n", F.lit(0).alias("guessed"),
                         F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("pred").alias("class"), F.lit(0).cast("bigint").alias("n"),
                         F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    # One row per class; classes and averages both read it, the scored rows are read once.
    sums = durable(
        roles.groupBy("class").agg(
            F.sum("n").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")
        )
    )
    hit = F.col("hit").cast("double")
    per_class = sums.withColumns(
        {
            "precision": F.coalesce(F.try_divide(hit, F.col("guessed")), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide(hit, F.col("support")), F.lit(0.0)),
        }
    ).withColumn(
        "f1_score",
        F.coalesce(
            F.try_divide(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
            F.lit(0.0),
        ),
    )
    parts = ("precision", "recall", "f1_score")
    overall = per_class.agg(
        F.sum("support").alias("support"),
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        *[F.avg(p).alias(f"macro_{p}") for p in parts],
        *[(F.sum(F.col(p) * F.col("support")) / F.sum("support")).alias(f"weighted_{p}")
          for p in parts],
    )

    def row(name: str, *values: Column) -> Column:
        named = [v.alias(p) for v, p in zip(values, parts)]
        return F.struct(F.lit(name).alias("class"), *named, "support")

    summary = overall.select(
        F.inline(
            F.array(
                row("accuracy", *[F.col("accuracy")] * 3),
                row("macro avg", *[F.col(f"macro_{p}") for p in parts]),
                row("weighted avg", *[F.col(f"weighted_{p}") for p in parts]),
            )
        )
    )
    classes = per_class.select(F.col("class").cast("string").alias("class"), *parts, "support")
    return classes.unionByName(summary)


def regression_table(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """MSE, MAE and R2; the total spread is taken from the variance, so one pass suffices."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    errors = df.filter(a.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((a - p) * (a - p)).alias("mse"),
        F.avg(F.abs(a - p)).alias("mae"),
        F.var_pop(a).alias("_spread"),
    )
    r2 = 1 - F.try_divide(F.col("mse"), F.col("_spread"))
    return errors.withColumn("r2", r2).drop("_spread")
