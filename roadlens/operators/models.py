"""Estimators and their tables, on pyspark.ml."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.logistic import LogisticFit
from roadlens.operators.logistic import fit as fit_logistic
from roadlens.operators.sampling import class_weights

FEATURES = "features"


@dataclass(frozen=True)
class Forest:
    """Size of a forest. The depth bound keeps trees that grow with the data from growing
    without end."""

    trees: int = 300
    depth: int = 10
    leaf: int = 2
    seed: int = 42


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` as doubles, flags as 0 and 1."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: (F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)).cast("double")
            for c in columns
        }
    )


def encoder(categories: Sequence[str], numbers: Sequence[str]) -> Pipeline:
    """One 0/1 column per known category, an unknown one all zeros; numbers unscaled."""
    codes = [f"{c}_code" for c in categories]
    shown = [f"{c}_is" for c in categories]
    stages: list = []
    if categories:
        stages += [
            StringIndexer(
                inputCols=list(categories), outputCols=codes, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # The slot that is dropped is the one of unknown categories.
            OneHotEncoder(inputCols=codes, outputCols=shown, dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=[*shown, *numbers], outputCol=FEATURES))
    return Pipeline(stages=stages)


def positive(column: str = "probability") -> Column:
    """Probability of class 1."""
    return vector_to_array(column)[1]


def logistic(
    df: DataFrame, label: str, c: float = 1.0, weight: str | None = None, max_iter: int = 500
) -> LogisticFit:
    """L2 logistic regression with inverse strength ``c``, on encoded ``features``."""
    return fit_logistic(df, label, c, weight, max_iter, FEATURES)


def _spread(df: DataFrame) -> DataFrame:
    """Rows on all cores: a short table is a lot of work for a forest and may be one or two files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def forest_classifier(df: DataFrame, label: str, size: Forest = Forest(), balanced: bool = True):
    estimator = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=size.trees, maxDepth=size.depth,
        minInstancesPerNode=size.leaf, seed=size.seed, featureSubsetStrategy="sqrt",
    )
    if balanced:
        df = class_weights(df, label, "_class_weight")
        estimator = estimator.setWeightCol("_class_weight")
    used = [FEATURES, label, *(["_class_weight"] if balanced else [])]
    return estimator.fit(_spread(df.select(*used)))


def forest_regressor(df: DataFrame, label: str, size: Forest = Forest()):
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=label, numTrees=size.trees, maxDepth=size.depth,
        minInstancesPerNode=size.leaf, seed=size.seed, featureSubsetStrategy="all",
    ).fit(_spread(df.select(FEATURES, label)))


def linear(df: DataFrame, label: str):
    return LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=0.0).fit(df)


def fit_sigmoid(df: DataFrame, margin: str, label: str) -> LogisticFit:
    """Sigmoid calibration of ``margin`` (Platt's smoothed targets) on rows kept for it."""
    sizes = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    high = (sizes["pos"] + 1.0) / (sizes["pos"] + 2.0)
    low = 1.0 / (sizes["neg"] + 2.0)
    target = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    # A soft target is a pair of weighted rows, one of each class.
    sides = F.array(
        F.struct(F.lit(1.0).alias("y"), target.alias("w")),
        F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")),
    )
    soft = df.select(F.array(margin).alias("margins"), F.inline(sides))
    return fit_logistic(soft, "y", math.inf, "w", features="margins")


def calibrated(sigmoid: LogisticFit, margin: str) -> Column:
    """Probability of class 1 after calibration."""
    z = F.col(margin) * F.lit(float(sigmoid.coefficients[0])) + F.lit(sigmoid.intercept)
    return 1 / (1 + F.exp(-z))


def feature_names(df: DataFrame) -> list[str]:
    """Names of the slots of the encoded ``features`` column."""
    groups = df.schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name.replace("_is_", "_") for _, name in slots]


def importance_table(encoded: DataFrame, values, column: str = "importance") -> DataFrame:
    """One row per feature slot, largest magnitude first."""
    rows = [(n, float(v)) for n, v in zip(feature_names(encoded), values)]
    table = encoded.sparkSession.createDataFrame(rows, f"feature string, {column} double")
    return table.orderBy(F.abs(F.col(column)).desc(), "feature")
