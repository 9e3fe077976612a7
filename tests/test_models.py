"""Models on rows with a planted signal."""

import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import logistic, models
from roadlens.operators.models import Forest
from roadlens.plans import breakdown, driver_risk, effects, fuel
from roadlens.schema import BREAKDOWN_FEATURES

SMALL = Forest(trees=10, depth=5)


@pytest.fixture(scope="module")
def clean(spark):
    """Cleaned trips with known effects: feedback halves harsh events, age drives breakdowns, fuel
    follows distance, new devices save fuel."""
    rng = np.random.default_rng(17)
    n = 3000
    pick = lambda *v: rng.choice(v, n)
    age, gen = rng.integers(0, 13, n), rng.integers(1, 4, n)
    feedback, trained = rng.random(n) < 0.55, rng.random(n) < 0.6
    km, idle = rng.uniform(5, 60, n).round(1), rng.uniform(1, 12, n).round(1)
    rate = (8 + 0.2 * age - 1.5 * (gen >= 2) + rng.normal(0, 0.3, n)).round(2)
    broke = rng.random(n) < 0.02 + 0.02 * age
    harsh = rng.random(n) < np.where(trained, 0.1, 0.3) * np.where(feedback, 0.5, 1.0)
    columns = {
        "trip_key": [f"t{i}" for i in range(n)],
        "vehicle_id": [f"v{i % 60}" for i in range(n)],
        "driver_id": [f"d{i % 40}" for i in range(n)],
        "hour_of_day": rng.integers(0, 24, n),
        "weather": pick("sunny", "rainy", "snowy"),
        "road_type": pick("city", "highway", "rural"),
        "traffic_density": pick("low", "medium", "high"),
        "vehicle_type": pick("car", "van", "truck"),
        "driver_training": np.where(trained, "trained", "untrained"),
        "rush_hour": rng.random(n) < 0.3,
        "vehicle_age_years": age,
        "device_generation": gen,
        "driver_experience_years": rng.integers(0, 21, n),
        "optimized_route_flag": rng.random(n) < 0.5,
        "speed": rng.uniform(10, 120, n).round(1),
        "distance_traveled_km": km,
        "idle_time_minutes": idle,
        "fuel_consumption_liters": (km * rate / 100 + idle * 0.05).round(3),
        "fuel_rate_l_per_100km": rate,
        "fuel_efficiency_l_per_km": (rate / 100).round(2),
        "sensor_battery": rng.uniform(20, 100, n).round(1),
        "data_latency_ms": rng.uniform(50, 200, n).round(1),
        "gps_accuracy_meters": rng.uniform(3, 15, n).round(1),
        "packet_loss_rate": rng.uniform(0, 0.03, n).round(4),
        "time_since_last_maintenance_days": rng.uniform(1, 60, n).round(1),
        "maintenance_type": pick("Predictive", "scheduled"),
        "braking_event": rng.random(n) < 0.1,
        "collision_alert": rng.random(n) < 0.01,
        "harsh_acceleration_event": harsh,
        "breakdown_event": broke,
        "downtime_hours": np.where(broke, 5.0, 0.0),
        "maintenance_cost_usd": np.where(broke, 400.0, 15.0),
        "intervention_active": feedback,
    }
    rows = list(zip(*[np.asarray(v).tolist() for v in columns.values()]))
    df = spark.createDataFrame(rows, list(columns)).repartition(4)
    made = df.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("speed") * 900))
    return made.persist()


def test_unknown_category_is_all_zero(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    encoder = models.encoder(["k"], []).fit(seen)
    new = spark.createDataFrame([("b",), ("z",)], "k string").coalesce(1)
    got = [list(r[0].toArray()) for r in encoder.transform(new).select("features").collect()]
    assert got == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0]]
    assert models.feature_names(encoder.transform(seen)) == ["k_a", "k_b", "k_c"]


def test_logistic_matches_the_penalised_optimum(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.5 + 1.5 * x)))).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = models.logistic(models.encoder([], ["x"]).fit(df).transform(df), "y", c=0.05)
    w = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(w * x + b)))
        grad = np.array([w + 0.05 * ((p - y) * x).sum(), 0.05 * (p - y).sum()])
        s = 0.05 * p * (1 - p)
        hess = np.array([[1 + (s * x * x).sum(), (s * x).sum()], [(s * x).sum(), s.sum()]])
        w, b = np.array([w, b]) - np.linalg.solve(hess, grad)
    assert model.coefficients[0] == pytest.approx(w, abs=1e-8)
    assert model.intercept == pytest.approx(b, abs=1e-8)
    assert model.converged and model.iterations < 12


def test_logistic_proves_itself(spark):
    """Raw units of very different size, weights, and what does not converge."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(1e4, 3e3, 900), rng.normal(0, 1e-3, 900), rng.integers(0, 2, 900)])
    y = rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] - 1e4) / 4e3 - x[:, 2]))
    rows = [(*map(float, r), int(t), float(w)) for r, t, w in zip(x, y, rng.integers(1, 4, 900))]
    df = spark.createDataFrame([*rows, (1.0, 1.0, 1.0, None, 1.0)], "a double, b double, c double, y int, w double")
    encoded = models.encoder([], ["a", "b", "c"]).fit(df).transform(df)
    model = models.logistic(encoded, "y", weight="w")
    assert model.converged and model.residual < 1e-10
    scores = logistic.score_equations(encoded.filter("y is not null"), model, ["a", "b", "c"], "y", weight="w").collect()
    assert [r.feature for r in scores] == ["a", "b", "c", "intercept"]
    assert all(abs(r.score) < 1e-5 for r in scores)
    assert not models.logistic(encoded, "y", weight="w", max_iter=2).converged
    apart = spark.createDataFrame([([float(i)], int(i > 3)) for i in range(8)], "x array<double>, y int")
    assert not logistic.fit(apart, "y", c=np.inf, max_iter=20, features="x").converged


def test_sigmoid_on_two_margins_has_a_closed_form(spark):
    rows = [(-1.0, 0)] * 30 + [(-1.0, 1)] * 10 + [(2.0, 0)] * 5 + [(2.0, 1)] * 25
    sigmoid = models.fit_sigmoid(spark.createDataFrame(rows, "m double, y int"), "m", "y")
    high, low = 36 / 37, 1 / 37
    rates = {m: sum(high if y else low for v, y in rows if v == m) / sum(v == m for v, _ in rows) for m in (-1.0, 2.0)}
    for m, rate in rates.items():
        z = sigmoid.coefficients[0] * m + sigmoid.intercept
        assert 1 / (1 + np.exp(-z)) == pytest.approx(rate, abs=1e-9)


def test_risk_model(clean):
    made = driver_risk.risk_model(clean, "trip_key")
    assert 0.5 < made["auc"].first().roc_auc < 0.8
    assert made["coefficients"].filter("feature = 'intervention_active'").first().coefficient < 0
    assert made["predictions"].count() == pytest.approx(900, abs=120)


def test_fuel_model(clean):
    made = fuel.fuel_model(clean, "trip_key", SMALL)
    quality = {r.model: r.r2 for r in made["metrics"].collect()}
    assert quality["random forest"] > 0.9 and quality["linear regression"] > 0.9
    assert made["importances"].first().feature == "distance_traveled_km"
    assert {r.n_null for r in made["null_counts"].collect()} == {0} and made["null_counts"].count() == 13
    kept = fuel.fuel_model(clean, "trip_key", SMALL, drop_leaky=True)["importances"]
    assert kept.filter("feature like 'fuel%'").count() == 0


def test_breakdown_model_beats_the_base_rate(clean):
    made = breakdown.breakdown_model(
        clean, "trip_key", SMALL, replace(breakdown.FIXED, rounds=3), replace(breakdown.STOPPING, rounds=6, patience=3)
    )
    metrics = {r.model: r for r in made["metrics"].collect()}
    assert set(metrics) == {m for m, _ in breakdown.MODELS}
    # Boosting splits on the in-between values of oversampled flags, so it gains less than the rest.
    assert all(r.roc_auc > 0.5 for r in metrics.values())
    assert metrics["Logistic Regression"].roc_auc > 0.6
    first = next(iter(metrics.values()))
    assert first.tp + first.fp + first.tn + first.fn == made["predictions"].count()
    base = made["predictions"].agg(F.avg("y_true")).first()[0]
    assert all(r.pr_auc > base for r in metrics.values())
    calibrated = made["predictions"].agg(F.avg("p_logreg")).first()[0]
    assert calibrated == pytest.approx(base, abs=0.05)
    assert made["importances"].count() == len(BREAKDOWN_FEATURES)
    top = [r.feature for r in made["importances"].limit(3).collect()]
    assert "vehicle_age_years" in top


def test_feedback_effect_and_uplift(clean):
    effect = effects.feedback_effects(clean, "trip_key", 100)["effects"]
    harsh = effect.filter("outcome = 'harsh_acceleration_event'").first()
    assert harsh.ci95_low < harsh.diff_t_minus_c < harsh.ci95_high < 0
    made = effects.feedback_uplift(clean, "trip_key", SMALL)
    n = made["scored"].count()
    deciles = made["deciles"].collect()
    assert sum(r.n_bin for r in deciles) == n
    assert {r.model for r in made["details"].collect()} == {"control", "treated"}
    ranked = made["by_driver"].orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 41))
    assert ranked[0].mean_uplift_pred >= ranked[-1].mean_uplift_pred


def test_device_effect_and_uplift(clean):
    effect = effects.device_effects(clean, "trip_key", 100)["effects"]
    rate = effect.filter("outcome = 'fuel_rate_l_per_100km'").first()
    assert rate.ci95_low < -1.5 + 0.3 and rate.ci95_high < -1.0
    made = effects.device_uplift(clean, "trip_key", SMALL, SMALL, SMALL)
    mean = made["scored"].agg(F.avg("fuel_uplift")).first()[0]
    assert mean == pytest.approx(1.5, abs=0.3)
    assert {r.arm: r.r2 > 0.5 for r in made["fuel_details"].collect()} == {"old": True, "new": True}
    assert made["modulators"].count() == 22
    assert made["by_vehicle"].count() == 60


def test_rows_of_a_logistic_fit_take_little_room(spark, monkeypatch):
    folder = spark.conf.get("spark.checkpoint.dir")

    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)

    slots = [(F.pmod(F.hash("id", F.lit(i)), F.lit(3)) == 0).cast("double") for i in range(24)]
    df = spark.range(20000).select(F.array(*slots).alias("features"), (F.hash("id") % 2 == 0).cast("int").alias("y"))
    before, sums, during = size(), logistic._sums, []
    monkeypatch.setattr(logistic, "_sums", lambda *a: during.append(size()) or sums(*a))
    assert logistic.fit(df, "y").converged
    assert during[0] - before < 20000 * 24
