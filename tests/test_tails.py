"""Formulas against recorded values."""

import math

import pytest
from pyspark.sql import functions as F

from roadlens.functions import tails
from roadlens.operators import testing
from roadlens.operators.evaluation import confusion, model_table


def near(a, b, rel=1e-12):
    assert a == pytest.approx(b, rel=rel)


def test_chi2_tail():
    near(tails.chi2_one_df(0.061680416095947974), 0.8038594205869576, 1e-11)
    near(tails.chi2_one_df(129.16050706020172), 6.255005961740445e-30, 1e-9)
    near(tails.chi2_one_df(639.5640535905385), 4.1567315294406493e-141, 1e-9)


def test_student_tail_far_out_and_symmetric():
    near(tails.student_two_sided(0.0, 5), 1.0)
    near(tails.student_two_sided(2.0, 10), tails.student_two_sided(-2.0, 10))
    near(tails.student_two_sided(1.0, 1), 0.5)
    near(tails.student_two_sided(2.0, 2), 1 - 2 / math.sqrt(6), 1e-10)
    near(tails.student_two_sided(0.9771940384511858, 197000), 0.3284743250419506, 1e-6)
    assert 0 < tails.student_two_sided(-29.516350929132166, 110000) < 1e-180


def test_student_tail_of_large_df_joins_the_exact_one():
    exact, approximate = tails.student_two_sided(2.5, 9.9e6), tails.student_two_sided(2.5, 1.01e7)
    near(exact, approximate, 1e-6)


def _one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]).first()


def test_pooled_z(spark):
    z = testing.z_test(
        F.lit(0.13275404518816114), F.lit(108524.0), F.lit(0.1528812537000011), F.lit(89527.0)
    )
    near(spark.range(1).select(z).first()[0], -12.777199049590426, 1e-12)


@pytest.mark.parametrize(
    ("rate_t", "n_t", "rate_c", "n_c", "want"),
    [
        (0.029477350632118243, 108524, 0.051738581656930314, 89527, 639.5640535905385),
        (0.10160886071283771, 108524, 0.10195806851564332, 89527, 0.061680416095947974),
        (0.004364718761850927, 139757, 0.004965859714463066, 57996, 3.14497358917031),
    ],
)
def test_yates_chi2(spark, rate_t, n_t, rate_c, n_c, want):
    a, c = round(rate_t * n_t), round(rate_c * n_c)
    cells = [F.lit(v) for v in (a, n_t - a, c, n_c - c)]
    near(spark.range(1).select(testing.yates_chi2(*cells)).first()[0], want, 1e-11)


def test_f1_of_recorded_confusion_counts(spark):
    tn, fp, fn, tp = 42484, 6804, 179, 46
    i = F.col("id")
    df = spark.range(tn + fp + fn + tp).select(
        F.lit("m").alias("model"),
        (i < tp + fn).cast("int").alias("y"),
        F.when((i < tp) | (i >= tp + fn + tn), 0.9).otherwise(0.1).alias("p"),
    )
    got = confusion(df, 0.5).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (tn, fp, fn, tp)
    near(got.precision, 0.006715328467153186)
    near(got.recall, 0.20444444444435358)
    near(got.f1, 0.013003533562746075)
    best = model_table(df).first()
    near(best.f1_score, 0.013003533562746444)
    near(best.f1, 0.013003533562746075)


def test_recorded_comparison_of_two_rates(spark):
    """Breakdown rates of 106 582 and 91 469 records: t, interval, U and both p-values."""
    n1, n0 = 106582, 91469
    hits1, hits0 = round(0.0034245932709087838 * n1), round(0.0058380434901442015 * n0)
    i = F.col("id")
    df = spark.range(n1 + n0).select(
        (i < n1).alias("arm"),
        ((i < hits1) | (i >= n1 + n0 - hits0)).cast("int").alias("broke"),
    )
    got = testing.welch_tests(df, "arm", ["broke"]).first()
    near(got.t_stat, -7.810772645639037, 1e-10)
    near(got.p_value, 5.71606443363598e-15, 1e-6)
    near(got.ci95_low, -0.0030190593852918324, 1e-10)
    near(got.ci95_high, -0.0018078410531790028, 1e-10)
    ranked = testing.rank_sums(df, "arm", ["broke"]).first()
    assert ranked.mw_u == 4862710177.5
    near(ranked.mw_p, 1.6428467306628724e-15, 1e-9)
