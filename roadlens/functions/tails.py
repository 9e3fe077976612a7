"""Two-sided tail probabilities as vectorised functions for the few rows of a test report."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_STEPS = 10_000_000


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_one_df(x: float) -> float:
    return math.erfc(math.sqrt(x / 2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral (modified Lentz).

    It takes about sqrt(max(a, b)) steps; not to converge is an error.
    """
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    total = d
    for m in range(1, MAX_STEPS):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / ((1.0 + numerator * d) or tiny)
            c = (1.0 + numerator / c) or tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return total
    raise ArithmeticError(f"the beta fraction of {a}, {b}, {x} does not converge")


def _log_gamma_half_step(a: float) -> float:
    """log(gamma(a + 1/2) / gamma(a)), without the cancellation of two large logarithms."""
    moved = 0.0
    while a < 40:
        moved += math.log(a / (a + 0.5))
        a += 1
    y = 1 / (a * a)
    series = (1 / 8 - y * (1 / 192 - y * (1 / 640 - y * 17 / 14336))) / a
    return moved + 0.5 * math.log(a) - series


def student_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|), relative accuracy kept far into the tail."""
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    if t == 0:
        return 1.0
    front = math.exp(
        _log_gamma_half_step(a) - math.lgamma(b)
        - a * math.log1p(t * t / df) + b * math.log(t * t / (df + t * t))
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _safe(fn, *args: float) -> float | None:
    if any(a is None or math.isnan(a) for a in args):
        return None
    return fn(*args)


@F.pandas_udf(T.DoubleType())
def _normal(z: pd.Series) -> pd.Series:
    return pd.Series([_safe(normal_two_sided, v) for v in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _chi2(x: pd.Series) -> pd.Series:
    return pd.Series([_safe(chi2_one_df, v) for v in x], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _student(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([_safe(student_two_sided, *v) for v in zip(t, df)], dtype="float64")


def _null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normal_p(z: Column) -> Column:
    return _null_if_nan(_normal(z))


def chi2_p(x: Column) -> Column:
    return _null_if_nan(_chi2(x))


def student_p(t: Column, df: Column) -> Column:
    return _null_if_nan(_student(t, df))
