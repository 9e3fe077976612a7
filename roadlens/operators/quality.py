"""Audits of recorded labels and amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.derive import fuel_audit, safe_label


def label_contradictions(df: DataFrame) -> DataFrame:
    """Per event type: rows whose stored label differs from what the events say."""
    wrong = F.col("risk_label") != safe_label()
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(wrong).alias("n_contradicting"),
        F.avg(wrong.cast("int")).alias("contradiction_rate"),
    )


def fuel_residuals(df: DataFrame) -> DataFrame:
    """Per vehicle type: how far recorded fuel is from the expected amount."""
    residual = F.col("fuel_residual_liters")
    return fuel_audit(df).groupBy("vehicle_type").agg(
        F.count(residual).alias("n"),
        F.avg("expected_fuel_liters").alias("avg_expected"),
        F.avg(residual).alias("avg_residual"),
        F.max(F.abs(residual)).alias("max_abs_residual"),
    )
