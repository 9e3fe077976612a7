"""Ordered work, evaluation of scores, splits, uplift tables and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Context, check, r6
from roadlens.functions import derive
from roadlens.functions.hashing import key_hash
from roadlens.functions.rules import complete
from roadlens.operators import charts, evaluation, models, ordered, ranking, sampling, uplift

# Three scores for the breakdown event, all plain arithmetic on recorded columns.
SCORES = {
    "age": "(vehicle_age_years + 1) / 14e0",
    "recency": "time_since_last_maintenance_days / 100e0",
    "latency": "data_latency_ms / 250e0",
}
SCORED_CTE = "scored as (" + " union all ".join(
    f"select trip_key, '{m}' as model, cast(breakdown_event as int) as y, {p} as p from clean"
    for m, p in SCORES.items()
) + ")"
CURVE_CTES = SCORED_CTE + """,
points as (
  select model, p, cast(sum(y) as double) as pos, cast(sum(1 - y) as double) as neg
  from scored group by model, p),
curve as (
  select *, sum(pos) over w as tp, sum(neg) over w as fp,
    sum(pos) over (partition by model) as n_pos, sum(neg) over (partition by model) as n_neg
  from points window w as (partition by model order by p desc)),
rated as (
  select *, tp / (tp + fp) as pr, tp / n_pos as rc,
    2 * (tp / (tp + fp) * (tp / n_pos)) / (tp / (tp + fp) + tp / n_pos + 1e-10) as f1 from curve),
best as (
  select * from (select *, row_number() over (partition by model order by f1 desc, p) as place
    from rated) where place = 1)"""
AUC = r6("sum(pos * (n_neg - fp + neg / 2)) / (max(n_pos) * max(n_neg))")
AP = r6("sum(pos / n_pos * pr)")


def scored(c: Context):
    pairs = [F.struct(F.lit(m).alias("model"), F.expr(p).alias("p")) for m, p in SCORES.items()]
    return c.clean.select(
        "trip_key", derive.flag("breakdown_event").alias("y"), F.inline(F.array(*pairs))
    )


# ---------------------------------------------------------------- ordered work


@check(
    "g1_running_counts",
    """select vehicle_type, fuel_rate_l_per_100km, n,
  cast(sum(n) over (partition by vehicle_type order by fuel_rate_l_per_100km) - n as bigint)
    as before_n,
  cast(sum(n) over (partition by vehicle_type) as bigint) as total_n
from (select vehicle_type, fuel_rate_l_per_100km, count(*) as n from clean
  where fuel_rate_l_per_100km is not null group by 1, 2)""",
    keep_digits=True,
)
def _(c: Context):
    return ordered.value_counts(c.clean, "fuel_rate_l_per_100km", by=["vehicle_type"])


@check(
    "w4_mid_ranks",
    """select downtime_hours, n, sum(n) over (order by downtime_hours) - n + (n + 1) / 2e0
  as mid_rank from (select downtime_hours, count(*) as n from clean
  where downtime_hours is not null group by 1)""",
    keep_digits=True,
)
def _(c: Context):
    return ordered.mid_ranks(c.clean, "downtime_hours")


QS = (0.1, 0.25, 0.5, 0.75, 0.9)


@check(
    "w3_exact_quantiles",
    "select vehicle_type, count(data_latency_ms) as n, "
    + ", ".join(f"{r6(f'quantile_cont(data_latency_ms, {q})')} as q{i}" for i, q in enumerate(QS))
    + " from clean group by vehicle_type",
)
def _(c: Context):
    return ordered.quantiles(c.clean, "data_latency_ms", QS, by=["vehicle_type"])


@check(
    "w3_decile_bins",
    """select trip_key, cast(1 + """
    + " + ".join(
        f"(case when gps_accuracy_meters > (select quantile_cont(gps_accuracy_meters, {i / 10})"
        " from clean) then 1 else 0 end)"
        for i in range(1, 10)
    )
    + " as int) as bin_no from clean",
)
def _(c: Context):
    return ordered.quantile_bins(c.clean, "gps_accuracy_meters").select("trip_key", "bin_no")


@check(
    "w1_c10_a5_targeting_list",
    """select vehicle_id, mean_a, mean_b, n_trips, cast(row_number() over (
    order by mean_a desc, mean_b desc, vehicle_id) as bigint) as "rank"
from (select vehicle_id, avg(round(speed * 100) - round(idle_time_minutes * 10)) as mean_a,
  avg(cast(vehicle_age_years as double)) as mean_b, count(*) as n_trips from clean group by 1)""",
    keep_digits=True,
)
def _(c: Context):
    made = c.clean.select(
        "vehicle_id",
        (F.round(F.col("speed") * 100) - F.round(F.col("idle_time_minutes") * 10)).alias("a"),
        F.col("vehicle_age_years").cast("double").alias("b"),
    )
    return uplift.targeting_list(made, "vehicle_id", ["a", "b"])


@check(
    "w5_cumulative_hits",
    """select model, p as threshold, cast(pos as bigint) as pos, cast(neg as bigint) as neg,
  cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(n_pos as bigint) as n_pos,
  cast(n_neg as bigint) as n_neg from curve""",
    ctes=CURVE_CTES,
    keep_digits=True,
)
def _(c: Context):
    return evaluation.score_curve(scored(c))


@check(
    "o1_ordered_events",
    """select event_type, n, row_number() over (order by n desc, event_type) as position
from (select event_type, count(*) as n from clean group by event_type)""",
)
def _(c: Context):
    counts = charts.category_counts(c.clean, "event_type")
    return ranking.numbered(counts, [F.desc("n"), F.col("event_type")])


@check(
    "o2_by_magnitude",
    f"""select maintenance_type, {r6('gap')} as gap,
  row_number() over (order by abs(gap) desc, maintenance_type) as position
from (select maintenance_type, avg(speed) - 80 as gap from clean group by 1)""",
)
def _(c: Context):
    gaps = c.clean.groupBy("maintenance_type").agg((F.avg("speed") - 80).alias("gap"))
    return ranking.numbered(gaps, [F.abs("gap").desc(), F.col("maintenance_type")])


@check(
    "o3_top_k",
    """select trip_key, downtime_hours from clean
order by downtime_hours desc nulls last, trip_key limit 12""",
    keep_digits=True,
)
def _(c: Context):
    order = [F.col("downtime_hours").desc_nulls_last(), F.col("trip_key")]
    return ranking.top_k(c.clean.select("trip_key", "downtime_hours"), order, 12)


FUEL = ("fuel_consumption_liters", "speed", "downtime_hours", "vehicle_age_years")


@check(
    "a14_medians",
    " union all ".join(
        f"select '{f}' as column_name, {r6(f'quantile_cont(cast({f} as double), 0.5)')} as median"
        " from clean"
        for f in FUEL
    ),
)
def _(c: Context):
    return ranking.medians(c.clean, FUEL)


@check(
    "a14_median_imputation",
    f"""select trip_key, {r6('''coalesce(fuel_consumption_liters,
  (select quantile_cont(fuel_consumption_liters, 0.5) from trips))''')} as fuel_consumption_liters,
  {r6('''coalesce(downtime_hours, (select quantile_cont(downtime_hours, 0.5) from trips))''')}
  as downtime_hours from trips""",
)
def _(c: Context):
    columns = ["fuel_consumption_liters", "downtime_hours"]
    return ranking.impute_medians(c.trips.select("trip_key", *columns), columns)


# ---------------------------------------------------------------- evaluation


@check("m11_roc_auc", f"select model, {AUC} as roc_auc from rated group by model", ctes=CURVE_CTES)
def _(c: Context):
    return evaluation.roc_auc(scored(c))


@check(
    "m12_average_precision",
    f"select model, {AP} as pr_auc from rated group by model",
    ctes=CURVE_CTES,
)
def _(c: Context):
    return evaluation.average_precision(scored(c))


@check(
    "m13_log_loss",
    f"""select model, {r6('''avg(case when y = 1 then -ln(q) else -ln(1 - q) end)''')} as log_loss,
  count(*) as n from (select *, least(greatest(p, 2.220446049250313e-16),
    1 - 2.220446049250313e-16) as q from scored) group by model""",
    ctes=SCORED_CTE,
)
def _(c: Context):
    return evaluation.log_loss(scored(c))


@check(
    "m14_best_threshold",
    f"""select model, {r6('p')} as best_threshold, {r6('pr')} as precision, {r6('rc')} as recall,
  {r6('f1')} as f1_score from best""",
    ctes=CURVE_CTES,
)
def _(c: Context):
    return evaluation.best_threshold(scored(c))


@check(
    "m15_confusion",
    f"""select model, cast(tn as bigint) as tn, cast(fp as bigint) as fp, cast(fn as bigint) as fn,
  cast(tp as bigint) as tp, {r6('p')} as precision, {r6('r')} as recall,
  {r6('2 * p * r / (p + r + 1e-10)')} as f1
from (select *, tp / (tp + fp + 1e-10) as p, tp / (tp + fn + 1e-10) as r from (
  select model, count(*) filter (where p < 0.5 and y = 0) as tn,
    count(*) filter (where p >= 0.5 and y = 0) as fp,
    count(*) filter (where p < 0.5 and y = 1) as fn,
    count(*) filter (where p >= 0.5 and y = 1) as tp from scored group by model))""",
    ctes=SCORED_CTE,
)
def _(c: Context):
    return evaluation.confusion(scored(c), 0.5)


_AGE = "(vehicle_age_years + 1) / 14e0"


@check(
    "m16_classification_report",
    f"""select class, {r6('p')} as precision, {r6('r')} as recall, {r6('f')} as f1_score, s as support from (
select 'accuracy' as class, a as p, a as r, a as f, s from (select sum(y = pred) / count(*)
  as a, count(*) as s from g)
union all select cast(k as varchar), p, r, f, s from per_class
union all select 'macro avg', avg(p), avg(r), avg(f), cast(sum(s) as bigint) from per_class
union all select 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s),
  cast(sum(s) as bigint) from per_class)""",
    ctes=f"""g as (select cast(breakdown_event as int) as y,
  case when {_AGE} >= 0.6 then 1 else 0 end as pred from clean),
ratios as (select k, (select count(*) from g where y = k) as s,
  (select count(*) from g where y = k and pred = k) as hit,
  (select count(*) from g where pred = k) as guessed from (select unnest([0, 1]) as k)),
per_class as (select *, 2 * p * r / (p + r) as f from (
  select k, s, hit / guessed as p, hit / s as r from ratios))""",
)
def _(c: Context):
    made = c.clean.select(
        derive.flag("breakdown_event").alias("y"),
        F.when(F.expr(_AGE) >= 0.6, 1).otherwise(0).alias("pred"),
    )
    return evaluation.classification_report(made)


def regression_rows(c: Context):
    guess = F.col("distance_traveled_km") * F.col("fuel_rate_l_per_100km") / 100
    return c.clean.select(
        "trip_key", "vehicle_type", F.col("fuel_consumption_liters").alias("actual"),
        guess.alias("predicted"),
    )


_PAIRS = """pairs as (select trip_key, vehicle_type, fuel_consumption_liters as a,
  distance_traveled_km * fuel_rate_l_per_100km / 100 as p from clean)"""


@check(
    "m17_regression_metrics",
    f"""select vehicle_type, count(*) as n, {r6('avg(pow(a - p, 2))')} as mse,
  {r6('avg(abs(a - p))')} as mae,
  {r6('1 - sum(pow(a - p, 2)) / sum(pow(a - m, 2))')} as r2
from (select *, avg(a) over (partition by vehicle_type) as m from pairs
  where a is not null and p is not null) group by vehicle_type""",
    ctes=_PAIRS,
)
def _(c: Context):
    return evaluation.regression_table(regression_rows(c), "actual", "predicted", ["vehicle_type"])


@check(
    "m6_one_feature_line",
    f"""select vehicle_type, {r6('regr_slope(fuel_consumption_liters, distance_traveled_km)')}
  as slope, {r6('regr_intercept(fuel_consumption_liters, distance_traveled_km)')} as intercept,
  {r6('regr_r2(fuel_consumption_liters, distance_traveled_km)')} as r2
from clean group by vehicle_type""",
)
def _(c: Context):
    known = complete(c.clean, ["fuel_consumption_liters", "distance_traveled_km"])
    shaped = models.encoder([], ["distance_traveled_km"]).fit(known).transform(known)
    lines = []
    for kind in ("car", "truck", "van"):
        fitted = models.linear(shaped.filter(F.col("vehicle_type") == kind), "fuel_consumption_liters")
        lines.append(
            (kind, float(fitted.coefficients[0]), float(fitted.intercept), float(fitted.summary.r2))
        )
    return c.spark.createDataFrame(
        lines, "vehicle_type string, slope double, intercept double, r2 double"
    )


@check(
    "m2_one_category_shares",
    """select weather, round(avg(braking_event::int), 3) as p from clean
where weather is not null and braking_event is not null group by weather""",
)
def _(c: Context):
    """Without a penalty, logistic regression on one category gives the categories' own shares."""
    known = complete(c.clean, ["weather", "braking_event"])
    shaped = models.numeric(known, ["braking_event"]).select("weather", "braking_event")
    encoded = models.encoder(["weather"], []).fit(shaped).transform(shaped)
    fitted = models.logistic(encoded, "braking_event", c=1e9, max_iter=500)
    scored = encoded.withColumn("p", fitted.probability())
    # The solver ends some digits before the sixth place.
    return scored.groupBy("weather").agg(F.round(F.max("p"), 3).alias("p"))


@check(
    "m18_model_table",
    f"""select a.model, roc_auc, pr_auc, {r6('p')} as best_threshold, {r6('pr')} as precision,
  {r6('rc')} as recall, {r6('f1')} as f1_score, cast(n_neg - fp as bigint) as tn,
  cast(fp as bigint) as fp, cast(n_pos - tp as bigint) as fn, cast(tp as bigint) as tp,
  {r6('2 * tp / (n_pos + tp + fp)')} as f1
from (select model, {AUC} as roc_auc, {AP} as pr_auc from rated group by model) a
join best b on a.model = b.model""",
    ctes=CURVE_CTES,
)
def _(c: Context):
    return evaluation.model_table(scored(c))


# ---------------------------------------------------------------- splits

_HASH = "cast('0x' || substr(md5(trip_key), 1, 15) as bigint)"


@check(
    "m9_hash_split",
    f"select trip_key, {_HASH} < {int(0.3 * 2**60)} as is_test from clean",
)
def _(c: Context):
    return sampling.hash_split(c.clean.select("trip_key"), "trip_key", 0.3)


@check(
    "m9_stratified_split",
    f"""select trip_key, intervention_active, harsh_acceleration_event,
  row_number() over (partition by intervention_active, harsh_acceleration_event order by {_HASH})
    <= floor(count(*) over (partition by intervention_active, harsh_acceleration_event) * 0.25e0
      + 0.5) as is_test
from clean""",
)
def _(c: Context):
    strata = ["intervention_active", "harsh_acceleration_event"]
    return sampling.stratified_split(c.clean.select("trip_key", *strata), "trip_key", 0.25, strata)


@check(
    "m9_key_hash",
    f"select trip_key, {_HASH} as h from trips",
)
def _(c: Context):
    return c.trips.select("trip_key", key_hash("trip_key").alias("h"))


@check(
    "m3_class_weights",
    f"""select breakdown_event, {r6('any_value(t) / (2.0 * count(*))')} as class_weight, count(*) as n
from (select breakdown_event, count(*) over () as t from clean) group by 1""",
)
def _(c: Context):
    weighted = sampling.class_weights(c.clean.select("breakdown_event"), "breakdown_event")
    return weighted.groupBy("breakdown_event").agg(
        F.max("class_weight").alias("class_weight"), F.count(F.lit(1)).alias("n")
    )


@check(
    "m9_null_keys",
    f"""select is_test, count(*) as n from (
  select coalesce({_HASH} < {int(0.3 * 2**60)}, false) as is_test
  from (select case when weather = 'rainy' then null else trip_key end as trip_key from clean))
group by 1""",
)
def _(c: Context):
    key = F.when(F.col("weather") == "rainy", None).otherwise(F.col("trip_key")).alias("trip_key")
    marked = sampling.hash_split(c.clean.select(key), "trip_key", 0.3)
    return marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


_PAIRED = """select trip_key,
  case when weather = 'rainy' then 'a|b' when weather = 'sunny' then 'a' end as first,
  case when weather = 'rainy' then 'c' when weather = 'sunny' then 'b|c' end as second from clean"""


@check(
    "m9_strata_text",
    f"""select first, second, count(*) as n, count(*) filter (where is_test) as n_test from (
  select first, second, row_number() over (partition by first, second order by {_HASH})
    <= floor(count(*) over (partition by first, second) * 0.25e0 + 0.5) as is_test
  from ({_PAIRED})) group by 1, 2""",
)
def _(c: Context):
    """Labels that hold the separator, and NULL labels, are strata of their own."""
    weather = F.col("weather")
    rows = c.clean.select(
        "trip_key",
        F.when(weather == "rainy", "a|b").when(weather == "sunny", "a").alias("first"),
        F.when(weather == "rainy", "c").when(weather == "sunny", "b|c").alias("second"),
    )
    split = sampling.stratified_split(rows, "trip_key", 0.25, ["first", "second"])
    return split.groupBy("first", "second").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")
    )


@check(
    "m3_unlabelled",
    f"""select cast(rows.label as varchar) as label, count(*) as n,
  case when rows.label is not null then {r6('any_value(t) / (2.0 * count(*))')} end as class_weight
from (select *, count(label) over () as t from (
  select case when weather <> 'rainy' then breakdown_event end as label from clean)) as rows group by rows.label""",
)
def _(c: Context):
    label = F.when(F.col("weather") != "rainy", F.col("breakdown_event")).alias("label")
    weighted = sampling.class_weights(c.clean.select(label), "label")
    return weighted.groupBy(F.col("label").cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max("class_weight").alias("class_weight")
    )


@check(
    "w3_null_group",
    f"""select kind, count(data_latency_ms) as n, {r6('quantile_cont(data_latency_ms, 0.5)')} as q0
from (select *, case when weather <> 'rainy' then vehicle_type end as kind from clean) group by kind""",
)
def _(c: Context):
    kind = F.when(F.col("weather") != "rainy", F.col("vehicle_type"))
    return ordered.quantiles(c.clean.withColumn("kind", kind), "data_latency_ms", [0.5], by=["kind"])


# ---------------------------------------------------------------- uplift tables

_UPLIFT = "(vehicle_age_years - 6) / 10e0 + (speed - 80) / 1000e0"


@check(
    "c9_uplift_deciles",
    f"""select 'D' || cast(11 - b as varchar) as uplift_decile, cast(b as int) as bin_no,
  {r6('avg(y) filter (where not t) - avg(y) filter (where t)')} as obs_effect, count(*) as n_bin,
  cast(count(*) filter (where t) as bigint) as n_treat,
  cast(count(*) filter (where not t) as bigint) as n_ctrl
from (select y, t, 1 + {' + '.join(f'(u > (select quantile_cont(u, {i / 10}) from scores))::int'
                                   for i in range(1, 10))} as b from scores)
group by b""",
    ctes=f"scores as (select {_UPLIFT} as u, fuel_rate_l_per_100km as y,"
    " device_generation >= 2 as t from clean)",
)
def _(c: Context):
    made = c.clean.select(
        F.expr(_UPLIFT).alias("u"), "fuel_rate_l_per_100km", derive.new_device().alias("t")
    )
    return uplift.uplift_deciles(made, "u", "fuel_rate_l_per_100km", "t")


# ---------------------------------------------------------------- chart data


@check(
    "v1_histogram",
    f"""select cast(b as int) as bin_no, {r6('lo + b * (hi - lo) / 30')} as bin_start,
  {r6('lo + (b + 1) * (hi - lo) / 30')} as bin_end, (select count(*) from clean
    where least(floor((speed - lo) / (hi - lo) * 30), 29) = b) as n
from range(30) r(b), (select min(speed) as lo, max(speed) as hi from clean)""",
)
def _(c: Context):
    return charts.histogram(c.clean, "speed", 30)


@check(
    "v2_density",
    f"""select cast(i as int) as point, {r6('any_value(x)')} as x,
  {r6('sum(k * exp(-0.5 * pow((x - v) / h, 2))) / any_value(n * h) / sqrt(2 * pi())')} as density
from (select i, lo + i * ((hi - lo) / 199) as x, n, h from range(200) r(i), shape)
  cross join (select downtime_hours as v, count(*) as k from clean
    where downtime_hours is not null group by 1) group by i""",
    ctes="shape as (select min(downtime_hours) as lo, max(downtime_hours) as hi,"
    " cast(count(downtime_hours) as double) as n,"
    " stddev_samp(downtime_hours) * pow(count(downtime_hours), -0.2) as h from clean)",
)
def _(c: Context):
    return charts.density(c.clean, "downtime_hours", 200)


@check(
    "v3_box_stats",
    f"""select maintenance_type, {r6('q1')} as q1, {r6('median')} as median, {r6('q3')} as q3,
  any_value(n) as n, {r6('min(v) filter (where ok)')} as whisker_low,
  {r6('max(v) filter (where ok)')} as whisker_high,
  cast(count(*) filter (where not ok) as bigint) as n_outliers
from (select *, v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as ok
  from (select maintenance_type, maintenance_cost_usd as v from clean) join boxes
  using (maintenance_type)) group by maintenance_type, q1, median, q3""",
    ctes="boxes as (select maintenance_type, quantile_cont(maintenance_cost_usd, 0.25) as q1,"
    " quantile_cont(maintenance_cost_usd, 0.5) as median,"
    " quantile_cont(maintenance_cost_usd, 0.75) as q3, count(maintenance_cost_usd) as n"
    " from clean group by 1)",
)
def _(c: Context):
    return charts.box_stats(c.clean, "maintenance_type", "maintenance_cost_usd")


@check(
    "v4_category_counts",
    "select weather, count(*) as n from clean group by weather",
)
def _(c: Context):
    return charts.category_counts(c.clean, "weather")


@check(
    "v8_group_bars",
    " union all ".join(
        f"select optimized_route_flag, '{v}' as metric, {r6(f'avg({v})')} as mean,"
        f" {r6(f'1.959963984540054 * stddev_samp({v}) / sqrt(count({v}))')} as whisker, count({v}) as n"
        " from clean where optimized_route_flag is not null group by 1"
        for v in ("fuel_consumption_liters", "fuel_efficiency_l_per_km")
    ),
)
def _(c: Context):
    return charts.group_bars(c.clean, "optimized_route_flag", ["fuel_consumption_liters", "fuel_efficiency_l_per_km"])


@check(
    "v5_roc_points",
    f"""select model, {r6('p')} as threshold, {r6('fp / n_neg')} as fpr, {r6('tp / n_pos')} as tpr
from curve union all select distinct model, null, 0.0e0, 0.0e0 from curve""",
    ctes=CURVE_CTES,
)
def _(c: Context):
    return evaluation.roc_points(scored(c))


@check(
    "v6_pr_points",
    f"""select model, {r6('p')} as threshold, {r6('rc')} as recall, {r6('pr')} as precision,
  {r6('n_pos / (n_pos + n_neg)')} as base_rate from rated
union all select distinct model, null, 0.0e0, 1.0e0, {r6('n_pos / (n_pos + n_neg)')} from rated""",
    ctes=CURVE_CTES,
)
def _(c: Context):
    return evaluation.pr_points(scored(c))


@check(
    "v7_predicted_against_actual",
    f"""select trip_key, {r6('a')} as actual, {r6('p')} as predicted,
  {r6('(select min(a) from pairs)')} as line_from, {r6('(select max(a) from pairs)')} as line_to
from pairs""",
    ctes=_PAIRS,
)
def _(c: Context):
    return charts.predicted_against_actual(
        regression_rows(c), "actual", "predicted", keep=["trip_key"]
    )
