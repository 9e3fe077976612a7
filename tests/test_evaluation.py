"""Score quality on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import charts, evaluation, ranking


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(9)
    y = (rng.random(400) < 0.2).astype(int)
    p = np.clip(np.round(0.3 * y + rng.random(400) * 0.7, 2), 0, 1)
    data = [("m", int(a), float(b)) for a, b in zip(y, p)]
    return spark.createDataFrame(data, "model string, y int, p double"), y, p


def test_auc_and_average_precision(scored):
    df, y, p = scored
    got = evaluation.model_table(df).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert got.roc_auc == pytest.approx(auc)
    ap = 0.0
    for t in np.unique(p):
        hits = (y[p >= t] == 1).sum()
        ap += (y[p == t] == 1).sum() / y.sum() * hits / (p >= t).sum()
    assert got.pr_auc == pytest.approx(ap)


def test_best_threshold_is_the_lowest_of_equals(spark, scored):
    df, y, p = scored
    got = evaluation.model_table(df).first()
    f1 = {}
    for t in np.unique(p):
        tp = ((p >= t) & (y == 1)).sum()
        pr, rc = tp / (p >= t).sum(), tp / y.sum()
        f1[t] = 2 * pr * rc / (pr + rc + 1e-10)
    assert got.best_threshold == min(t for t in f1 if f1[t] == max(f1.values()))
    assert (got.tp + got.fn, got.fp + got.tn) == (y.sum(), (1 - y).sum())
    tie = spark.createDataFrame(
        [("m", 0, 0.1), ("m", 0, 0.2)], "model string, y int, p double"
    )
    assert evaluation.model_table(tie).first().roc_auc is None


def test_curve_ends(scored):
    df, y, _ = scored
    points = evaluation.roc_points(df).orderBy("tpr", "fpr").collect()
    assert (points[0].fpr, points[0].tpr) == (0.0, 0.0)
    assert (points[-1].fpr, points[-1].tpr) == (1.0, 1.0)
    closing = evaluation.pr_points(df).filter("threshold is null").first()
    assert (closing.recall, closing.precision) == (0.0, 1.0)
    assert closing.base_rate == pytest.approx(y.mean())


def test_log_loss_is_finite_at_the_ends(spark):
    df = spark.createDataFrame([("m", 1, 0.0), ("m", 0, 1.0)], "model string, y int, p double")
    assert evaluation.log_loss(df).first().log_loss == pytest.approx(36.04, abs=0.01)


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "y int, pred int")
    got = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert got["1"].precision == 0.0 and got["1"].recall == 0.0 and got["1"].support == 1
    assert got["accuracy"].precision == pytest.approx(2 / 3)
    assert got["macro avg"].recall == 0.5


def test_histogram_and_density(spark):
    rng = np.random.default_rng(8)
    v = rng.gamma(2, 3, 700)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    got = charts.histogram(df, "v", 30).orderBy("bin_no").collect()
    assert [r.n for r in got] == list(np.histogram(v, 30)[0])
    curve = charts.density(df, "v", 50).orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 50)
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert [r.density for r in curve] == pytest.approx(want)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    got = charts.histogram(df, "v", 4).orderBy("bin_no").collect()
    assert [r.n for r in got] == [5, 0, 0, 0]


def test_box_whiskers(spark):
    data = [("g", float(v)) for v in [*range(1, 21), 100]] + [(None, 5.0)]
    got = charts.box_stats(spark.createDataFrame(data, "g string, v double"), "g", "v").collect()
    assert len(got) == 1
    assert (got[0].q1, got[0].median, got[0].q3) == (6.0, 11.0, 16.0)
    assert (got[0].whisker_low, got[0].whisker_high, got[0].n_outliers) == (1.0, 20.0, 1)


def test_imputation_keeps_rows_together(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (2, None, 4.0), (3, float("nan"), 6.0), (4, 5.0, 9.0)],
        "id int, a double, b double",
    )
    got = ranking.impute_medians(df, ["a", "b"]).orderBy("id").collect()
    assert [(r.a, r.b) for r in got] == [(1.0, 6.0), (3.0, 4.0), (3.0, 6.0), (5.0, 9.0)]


def test_magnitude_order(spark):
    df = spark.createDataFrame([("a", -3.0), ("b", 2.0), ("c", 3.0)], "n string, v double")
    assert [r.n for r in ranking.by_magnitude(df, "v", "n").collect()] == ["a", "c", "b"]
    assert [r.n for r in ranking.top_k(df, [F.desc("v")], 2).collect()] == ["c", "b"]
