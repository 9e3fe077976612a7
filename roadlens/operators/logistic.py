"""Logistic regression by Newton's method, with the proof that it is one.

A step needs the gradient and the matrix of second derivatives, which one aggregate over the rows gives; it is
solved on the driver, where only these sums arrive. Newton's steps do not depend on the scale of the
features, so raw units do no harm. The fit says how many steps it took, how far the score equations are
from zero and whether that is near enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.partials import summed
from roadlens.session import written

#: Largest term of the score equations, per unit of weight and of the feature's root mean square.
TOLERANCE = 1e-10
BLOCKS = "width int, x binary, y binary, w binary"


@dataclass(frozen=True)
class LogisticFit:
    coefficients: np.ndarray
    intercept: float
    iterations: int
    #: Largest scaled term of the score equations at the solution.
    residual: float
    converged: bool
    features: str = "features"

    def margin(self) -> Column:
        """Log-odds of class 1, from the vector column ``features``."""
        terms = F.zip_with(
            vector_to_array(self.features), F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda x, c: x * c
        )
        return F.aggregate(terms, F.lit(float(self.intercept)), lambda total, t: total + t)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``margin``, ``probability`` of class 1 and the ``prediction`` 0 or 1."""
        scored = df.withColumn("margin", self.margin())
        p = 1 / (1 + F.exp(-F.col("margin")))
        return scored.withColumn("probability", p).withColumn("prediction", (F.col("margin") > 0).cast("double"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch: its features one after the other, so that columns of few values take little room."""
    for batch in batches:
        if not len(batch):
            continue
        lists = batch.column("x")
        width = pc.max(pc.list_value_length(lists)).as_py()
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
        y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        blobs = [pa.array([np.ascontiguousarray(v, dtype=np.float64).tobytes()], pa.binary()) for v in (x.T, y, w)]
        yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), *blobs], names=["width", "x", "y", "w"])


def _sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray, np.ndarray]:
    """Weight, loss, gradient, second derivatives and squares of the features at ``beta`` (intercept last)."""
    n = len(beta)

    def scan(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total = np.zeros(2 + 2 * n + n * n)
        for values, y, w in (block for batch in batches for block in zip(*(batch.column(c) for c in ("x", "y", "w")))):
            y, w = (np.frombuffer(c.as_py()) for c in (y, w))
            x = np.column_stack([np.frombuffer(values.as_py()).reshape(n - 1, len(y)).T, np.ones(len(y))])
            z = x @ beta
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            total[0] += w.sum()
            total[1] += (w * (np.logaddexp(0, z) - y * z)).sum()
            total[2 : 2 + n] += x.T @ (w * (p - y))
            total[2 + n : 2 + 2 * n] += (w[:, None] * x * x).sum(0)
            total[2 + 2 * n :] += (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()
        return {0: total}

    total = summed(rows, scan)[0]
    return total[0], total[1], total[2 : 2 + n], total[2 + 2 * n :].reshape(n, n), total[2 + n : 2 + 2 * n]


def fit(
    df: DataFrame, label: str, c: float = 1.0, weight: str | None = None, max_iter: int = 500, features: str = "features",
    tolerance: float = TOLERANCE,
) -> LogisticFit:
    """Least ``sum of weighted losses + |coefficients|^2 / (2 c)`` for the 0/1 ``label`` on a vector or array column; the
    intercept is free. ``c`` may be infinite. Rows without label or weight are not used.

    A step that does not lower the objective is halved until it does. ``converged`` is False when ``max_iter``
    steps were not enough, as where classes can be told apart without error and nothing is penalised.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = F.col(features) if dict(df.dtypes)[features].startswith("array") else vector_to_array(features)
    used = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    known = used.filter("x is not null and y is not null and w is not null")
    rows = written(known.mapInArrow(_packed, BLOCKS), "logistic")
    width = rows.agg(F.max("width")).first()[0]
    if width is None:
        raise ValueError("no rows to fit")
    penalty = np.append(np.full(width, 1 / c), 0.0)
    beta = np.zeros(width + 1)

    def state(b: np.ndarray):
        mass, loss, gradient, hessian, squares = _sums(rows, b)
        objective = loss + (penalty * b * b).sum() / 2
        gradient = gradient + penalty * b
        scale = mass * np.sqrt(np.maximum(squares / max(mass, 1e-300), 1e-300))
        return objective, gradient, hessian + np.diag(penalty), float(np.max(np.abs(gradient) / scale))

    objective, gradient, hessian, residual = state(beta)
    steps = 0
    while residual > tolerance and steps < max_iter:
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        share = 1.0
        while True:
            steps += 1
            tried = state(beta - share * step)
            if tried[0] <= objective + 1e-12 * abs(objective) or steps >= max_iter or share < 1e-6:
                break
            share /= 2
        if tried[0] > objective + 1e-12 * abs(objective):
            break
        beta = beta - share * step
        objective, gradient, hessian, residual = tried
    return LogisticFit(beta[:-1], float(beta[-1]), steps, residual, residual <= tolerance, features)


def fit_table(df: DataFrame, fitted: LogisticFit) -> DataFrame:
    """One row: steps, residual of the score equations, whether it is small enough."""
    row = [(fitted.iterations, fitted.residual, fitted.converged)]
    return df.sparkSession.createDataFrame(row, "iterations int, residual double, converged boolean")


def score_equations(df: DataFrame, fitted: LogisticFit, names: list[str], label: str, c: float = 1.0, weight: str | None = None) -> DataFrame:
    """(feature, score): the terms of the score equations per unit of weight, summed over the rows by themselves; all
    are zero at the solution."""
    x = vector_to_array(fitted.features)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    off = w * (fitted.probability() - F.col(label).cast("double"))
    parts = [F.sum(off * x[i]) + float(b) / c for i, b in enumerate(fitted.coefficients)]
    total = df.agg(F.array(*[p / F.sum(w) for p in [*parts, F.sum(off)]]).alias("scores"))
    labels = F.array(*[F.lit(n) for n in [*names, "intercept"]])
    return total.select(F.inline(F.arrays_zip(labels.alias("feature"), F.col("scores").alias("score"))))
