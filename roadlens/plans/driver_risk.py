"""Driver behaviour: does the intervention reduce risky events, and who is likely to be risky."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.derive import risky_event
from roadlens.functions.rules import complete
from roadlens.operators import evaluation, logistic, models, sampling, testing
from roadlens.schema import RISK_FEATURES
from roadlens.session import durable


def intervention_result(clean: DataFrame) -> DataFrame:
    return testing.with_verdict(testing.intervention_test(clean))


def risk_model(
    clean: DataFrame, key: str, test_share: float = 0.3, max_iter: int = 500
) -> dict[str, DataFrame]:
    """Balanced logistic regression on four features.

    Tables: predictions (key, features, actual, class, probability), auc, report, coefficients, fit (steps,
    residual, converged) and score_equations, whose terms are zero at the solution.
    """
    features = list(RISK_FEATURES)
    rows = clean.select(key, *features, risky_event().alias("actual_risky_event"))
    rows = models.numeric(complete(rows, [*features, "actual_risky_event"]), features)
    rows = sampling.hash_split(rows, key, test_share)
    encoder = models.encoder([], features).fit(rows)
    train = sampling.class_weights(
        encoder.transform(rows.filter("not is_test")), "actual_risky_event", "w"
    )
    model = models.logistic(train, "actual_risky_event", weight="w", max_iter=max_iter)
    scored = model.transform(encoder.transform(rows.filter("is_test")))
    # AUC, report and predictions look at the same scored rows.
    predictions = durable(scored.select(
        key,
        *features,
        "actual_risky_event",
        F.col("prediction").cast("int").alias("predicted_risky_event"),
        F.col("probability").alias("predicted_prob"),
    ))
    pairs = predictions.select(
        F.lit("logistic").alias("model"), F.col("actual_risky_event").alias("y"),
        F.col("predicted_prob").alias("p"), F.col("predicted_risky_event").alias("pred"),
    )
    return {
        "predictions": predictions,
        "auc": evaluation.roc_auc(pairs),
        "report": evaluation.classification_report(pairs),
        "coefficients": models.importance_table(train, model.coefficients, "coefficient"),
        "fit": logistic.fit_table(train, model),
        "score_equations": logistic.score_equations(train, model, features, "actual_risky_event", weight="w"),
    }
