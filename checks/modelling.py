"""End-to-end models on the cleaned trips; small forests, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Context, check, r6
from roadlens import schema
from roadlens.functions import derive
from roadlens.operators import boosting, charts, evaluation, models
from roadlens.operators import logistic as newton
from roadlens.operators.boosting import Boosting
from roadlens.operators.models import Forest
from roadlens.plans import breakdown, driver_risk, effects, fuel

SMALL = Forest(trees=20, depth=6)
KEY = "trip_key"


def risk(c: Context):
    return c.once("risk", lambda: driver_risk.risk_model(c.clean, KEY))


def breakdown_flow(c: Context):
    return c.once(
        "breakdown",
        lambda: breakdown.breakdown_model(c.clean, KEY),
    )


def feedback_uplift(c: Context):
    return c.once("feedback uplift", lambda: effects.feedback_uplift(c.clean, KEY, SMALL))


def device_uplift(c: Context):
    return c.once("device uplift", lambda: effects.device_uplift(c.clean, KEY, SMALL, SMALL, SMALL))


@check("m22_m2_risk_auc")
def _(c: Context):
    return risk(c)["auc"]


@check("m22_m20_risk_predictions")
def _(c: Context):
    return risk(c)["predictions"]


@check("m22_m16_risk_report")
def _(c: Context):
    return risk(c)["report"]


@check("m19_risk_coefficients")
def _(c: Context):
    return risk(c)["coefficients"]


def _zeros(names) -> str:
    return " union all ".join(f"select '{n}' as feature, 0e0 as score" for n in [*names, "intercept"])


@check("m22_m2_risk_score_equations", _zeros(schema.RISK_FEATURES))
def _(c: Context):
    """The sums over the rows that are zero at the optimum, computed apart from the fit."""
    return _unsigned(risk(c)["score_equations"])


def _unsigned(scores):
    """Zeros without a sign."""
    return scores.withColumn("score", F.round("score", 6) + F.lit(0.0))


def _propensity_zeros(numbers) -> str:
    slots = " union all ".join(
        f"select distinct '{c}_' || {c} as feature, 0e0 as score from clean where {c} is not null"
        for c in schema.CONTEXT_CATEGORIES
    )
    return f"{slots} union all {_zeros(numbers)}"


@check("c1_feedback_score_equations", _propensity_zeros(schema.FEEDBACK_IPW_NUMERIC))
def _(c: Context):
    rows = effects.feedback_rows(c.clean)
    return _unsigned(effects.propensity_equations(rows, "intervention_active", schema.FEEDBACK_IPW_NUMERIC))


@check("c1_device_score_equations", _propensity_zeros(schema.DEVICE_IPW_NUMERIC))
def _(c: Context):
    rows = effects.device_rows(c.clean)
    return _unsigned(effects.propensity_equations(rows, "new_device", schema.DEVICE_IPW_NUMERIC))


@check(
    "m2_newton_one_feature",
    f"""select 'vehicle_age_years' as feature, {r6("w")} as coefficient, {r6("b")} as intercept
from newton where i = 25""",
    ctes="""cells as (
  select cast(vehicle_age_years as double) as x, count(*) as n, sum(breakdown_event::int) as pos
  from clean where vehicle_age_years is not null and breakdown_event is not null group by 1),
newton as (
  with recursive it as (
    select 0 as i, 0e0 as w, 0e0 as b
    union all
    select i + 1, w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb),
      b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb)
    from (
      select i, w, b, w + sum((n * p - pos) * x) as gw, sum(n * p - pos) as gb,
        1 + sum(n * p * (1 - p) * x * x) as hww, sum(n * p * (1 - p) * x) as hwb, sum(n * p * (1 - p)) as hbb
      from (select i, w, b, x, n, pos, 1 / (1 + exp(-(w * x + b))) as p from it, cells where i < 25)
      group by i, w, b))
  select * from it)""",
)
def _(c: Context):
    used = c.clean.filter("vehicle_age_years is not null and breakdown_event is not null").select(
        F.array(F.col("vehicle_age_years").cast("double")).alias("features"), derive.flag("breakdown_event").alias("y")
    )
    fitted = newton.fit(used, "y")
    row = [("vehicle_age_years", float(fitted.coefficients[0]), fitted.intercept)]
    return c.spark.createDataFrame(row, "feature string, coefficient double, intercept double")


@check(
    "m7_one_boosting_round",
    f"""select rush_hour, intervention_active, cast(n as bigint) as n,
  {r6("1 / (1 + exp(-(ln(p / (1 - p)) - (n * p - pos) / (n * p * (1 - p)))))")} as p
from (select *, sum(pos) over () / sum(n) over () as p from (
  select rush_hour, intervention_active, count(*) as n, sum(breakdown_event::int) as pos from clean
  where rush_hour is not null and intervention_active is not null and breakdown_event is not null
  group by 1, 2))""",
)
def _(c: Context):
    """One tree of two levels on two flags: every pair of flags is a leaf."""
    used = c.clean.select("rush_hour", "intervention_active", derive.flag("breakdown_event").alias("y")).dropna()
    size = Boosting(rounds=1, step=1.0, depth=2, l2=0.0, min_hessian=0.0)
    model = boosting.fit(used, ["rush_hour", "intervention_active"], "y", size)
    cells = used.groupBy("rush_hour", "intervention_active").agg(F.count(F.lit(1)).alias("n"))
    flags = {f: F.col(f).cast("int") for f in ("rush_hour", "intervention_active")}
    told = model.predict(cells.withColumns(flags)).withColumns({f: F.col(f).cast("boolean") for f in flags})
    return told.select("rush_hour", "intervention_active", "n", "p")


@check(
    "m10_sigmoid_two_margins",
    f"""select rush_hour, {r6("(pos * (n1 + 1) / (n1 + 2) + (n - pos) / (n0 + 2)) / n")} as p
from (select rush_hour, n, pos, sum(pos) over () as n1, sum(n - pos) over () as n0 from (
  select rush_hour, count(*) as n, cast(sum(harsh_acceleration_event::int) as double) as pos from clean
  where rush_hour is not null and harsh_acceleration_event is not null group by 1))""",
)
def _(c: Context):
    """On two margins the calibrated chance is the mean of the smoothed targets."""
    used = c.clean.select("rush_hour", derive.flag("harsh_acceleration_event").alias("y")).dropna()
    used = used.withColumn("margin", F.when(F.col("rush_hour"), 1.5).otherwise(-0.5))
    sigmoid = models.fit_sigmoid(used, "margin", "y")
    return used.select("rush_hour", models.calibrated(sigmoid, "margin").alias("p")).distinct()


@check("m24_m7_boosting_curve")
def _(c: Context):
    return breakdown_flow(c)["boosting_curve"]


@check("v8_decile_line")
def _(c: Context):
    return charts.decile_line(feedback_uplift(c)["deciles"])


@check(
    "m23_a13_fuel_null_counts",
    """select 'fuel_efficiency_l_per_km' as column_name, count(*) as n_null from clean
where fuel_consumption_liters is not null and fuel_efficiency_l_per_km is null
union all select 'idle_time_minutes', count(*) from clean
where fuel_consumption_liters is not null and idle_time_minutes is null
union all select 'hour_of_day', count(*) from clean where fuel_consumption_liters is not null and hour_of_day is null""",
)
def _(c: Context):
    return fuel.null_counts(c.clean, KEY, ["fuel_efficiency_l_per_km", "idle_time_minutes", "hour_of_day"])


@check("m23_m5_fuel_metrics")
def _(c: Context):
    return fuel.fuel_model(c.clean, KEY, SMALL)["metrics"]


@check("m23_m19_fuel_importances")
def _(c: Context):
    return fuel.fuel_model(c.clean, KEY, SMALL, drop_leaky=True)["importances"]


@check("m24_m4_m7_m10_breakdown_metrics")
def _(c: Context):
    return breakdown_flow(c)["metrics"]


@check("m24_m19_breakdown_importances")
def _(c: Context):
    return breakdown_flow(c)["importances"]


@check("m24_m19_breakdown_coefficients")
def _(c: Context):
    return breakdown_flow(c)["coefficients"]


@check("m24_m20_breakdown_predictions")
def _(c: Context):
    return breakdown_flow(c)["predictions"]


@check("v5_breakdown_roc_points")
def _(c: Context):
    return evaluation.roc_points(breakdown_flow(c)["scored"])


@check("c1_c5_propensity_histogram")
def _(c: Context):
    scores = effects.propensity_scores(
        effects.feedback_rows(c.clean), KEY, "intervention_active", schema.FEEDBACK_IPW_NUMERIC
    )
    return charts.histogram(scores, "propensity", 30)


@check("c1_c4_feedback_effects")
def _(c: Context):
    return effects.feedback_effects(c.clean, KEY, 200)["effects"]


@check("c1_c4_device_effects")
def _(c: Context):
    return effects.device_effects(c.clean, KEY, 200)["effects"]


@check("c7_feedback_uplift_deciles")
def _(c: Context):
    return feedback_uplift(c)["deciles"]


@check("c7_a5_feedback_uplift_by_driver")
def _(c: Context):
    return feedback_uplift(c)["by_driver"]


@check("c8_device_fuel_deciles")
def _(c: Context):
    return device_uplift(c)["fuel_deciles"]


@check("c8_device_breakdown_deciles")
def _(c: Context):
    return device_uplift(c)["breakdown_deciles"]


@check("c8_a5_device_uplift_by_vehicle")
def _(c: Context):
    return device_uplift(c)["by_vehicle"]


@check("c8_device_model_quality")
def _(c: Context):
    return device_uplift(c)["details"]


@check("c11_device_modulators")
def _(c: Context):
    return device_uplift(c)["modulators"]


@check(
    "m1_one_hot_slots",
    " union all ".join(
        f"select '{c}_' || {c} as feature, cast(count(*) as double) as rows_set from clean"
        f" where {c} is not null group by {c}"
        for c in schema.CONTEXT_CATEGORIES
    )
    + " union all select 'rush_hour', cast(sum(rush_hour::int) as double) from clean",
)
def _(c: Context):
    shaped = models.numeric(c.clean, ["rush_hour"])
    encoded = models.encoder(schema.CONTEXT_CATEGORIES, ["rush_hour"]).fit(shaped).transform(shaped)
    names = models.feature_names(encoded)
    slots = F.posexplode(models.vector_to_array(models.FEATURES))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1)
    return (
        encoded.select(slots).groupBy(named.alias("feature")).agg(F.sum("col").alias("rows_set"))
    )
