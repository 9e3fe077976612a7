"""Hypothesis tests and reports. P-values are checked against Simpson sums of the densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Context, check, r6
from roadlens import schema
from roadlens.functions import derive, rules, tails
from roadlens.operators import aggregates, testing

STEPS = 4000
_WEIGHT = f"(case when i in (0, {STEPS}) then 1 when i % 2 = 1 then 4 else 2 end)"


def normal_p(z: str) -> str:
    """SQL text: two-sided normal tail by Simpson's rule."""
    top = f"least(abs({z}), 40)"
    return (
        f"(select case when {z} is null then null else 1 - 2 * sum({_WEIGHT} *"
        f" exp(-0.5 * pow({top} * i / {STEPS}, 2))) * {top} / {STEPS} / 3 / sqrt(2 * pi()) end"
        f" from range({STEPS + 1}) s(i))"
    )


def student_p(t: str, v: str) -> str:
    """SQL text: two-sided Student tail by Simpson's rule."""
    top = f"least(abs({t}), 40)"
    norm = f"exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi())"
    return (
        f"(select case when {t} is null then null else 1 - 2 * {norm} * sum({_WEIGHT} *"
        f" pow(1 + pow({top} * i / {STEPS}, 2) / {v}, -({v} + 1) / 2)) * {top} / {STEPS} / 3 end"
        f" from range({STEPS + 1}) s(i))"
    )


def rank_ctes(source: str, arm: str, metrics: dict[str, str]) -> str:
    """CTEs ending in ``ranked(metric, mw_u, z)``; metrics maps names to expressions."""
    long = " union all ".join(
        f"select '{name}' as metric, cast({text} as double) as v, {arm} as t from {source}"
        for name, text in metrics.items()
    )
    return f"""
long_values as ({long}),
tied as (
  select metric, v, cast(count(*) filter (where t) as double) as a,
    cast(count(*) filter (where not t) as double) as b
  from long_values where v is not null and t is not null group by metric, v),
mid as (
  select *, sum(a + b) over (partition by metric order by v) - (a + b) + (a + b + 1) / 2 as r
  from tied),
summed as (
  select metric, sum(a) as n1, sum(b) as n0, sum(a * r) - sum(a) * (sum(a) + 1) / 2 as u,
    sum(pow(a + b, 3) - (a + b)) as ties from mid group by metric),
ranked as (
  select metric, u as mw_u, (greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / nullif(sqrt(
    n1 * n0 / 12 * (n1 + n0 + 1 - ties / ((n1 + n0) * (n1 + n0 - 1)))), 0) as z from summed)"""


def moment_cte(source: str, arm: str, metrics: dict[str, str], name: str = "moments") -> str:
    parts = " union all ".join(
        f"""select '{m}' as metric, avg({x}) filter (where {arm}) as m1,
  var_samp({x}) filter (where {arm}) as v1,
  cast(count({x}) filter (where {arm}) as double) as n1,
  avg({x}) filter (where not {arm}) as m0, var_samp({x}) filter (where not {arm}) as v0,
  cast(count({x}) filter (where not {arm}) as double) as n0,
  cast(count(*) filter (where {arm}) as bigint) as rows1,
  cast(count(*) filter (where not {arm}) as bigint) as rows0 from {source}"""
        for m, x in metrics.items()
    )
    return f"""
{name}_raw as ({parts}),
{name} as (
  select *, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) as t,
    pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)) as df,
    1.959963984540054e0 * sqrt(v1 / n1 + v0 / n0) as half
  from {name}_raw)"""


def cells_cte(source: str, arm: str, events, name: str = "cells") -> str:
    parts = " union all ".join(
        f"""select '{e}' as metric, cast(count(*) filter (where {arm} and {e}) as double) as t1,
  cast(count(*) filter (where {arm} and not {e}) as double) as t0,
  cast(count(*) filter (where not {arm} and {e}) as double) as c1,
  cast(count(*) filter (where not {arm} and not {e}) as double) as c0 from {source}"""
        for e in events
    )
    return f"""
{name}_raw as ({parts}),
{name} as (
  select *, (t1 + t0 + c1 + c0) * pow(greatest(abs(t1 * c0 - t0 * c1) - (t1 + t0 + c1 + c0) / 2, 0), 2)
    / nullif((t1 + t0) * (c1 + c0) * (t1 + c1) * (t0 + c0), 0) as chi2
  from {name}_raw)"""


def ab_sql(source: str, arm: str, rates, means) -> tuple[str, str]:
    """(ctes, select) of an A/B report."""
    exprs = {m: m for m in means}
    ctes = ",".join(
        [
            cells_cte(source, arm, rates),
            moment_cte(source, arm, exprs),
            rank_ctes(source, arm, exprs),
        ]
    )
    select = f"""
with report as (
  select metric || '_rate' as metric, t1 / (t1 + t0) as a, c1 / (c1 + c0) as b, 'chi2' as test,
    chi2 as stat, {normal_p('sqrt(chi2)')} as p, cast(t1 + t0 as bigint) as n1,
    cast(c1 + c0 as bigint) as n0, cast(null as double) as u, cast(null as double) as up
  from cells
  union all
  select m.metric || '_mean', m1, m0, 'welch_t', t, {student_p('t', 'df')}, rows1, rows0, mw_u,
    least(1, case when z >= 0 then {normal_p('z')} else 2 - {normal_p('z')} end)
  from moments m join ranked r on m.metric = r.metric)
select metric, {r6('a')} as treatment_mean, {r6('b')} as control_mean,
  {r6('a - b')} as diff_t_minus_c, test, {r6('stat')} as stat, {r6('p')} as p_value,
  n1 as n_treat, n0 as n_control, {r6('u')} as mw_u, {r6('up')} as mw_p, coalesce(p < 0.05, false) as significant
from report"""
    return ctes, "select * from (" + select + ")"


# ---------------------------------------------------------------- single tests


@check(
    "h1_h10_intervention_z_test",
    f"""select unnest(['intervention', 'control']) as "group",
  unnest([{r6('p1')}, {r6('p0')}]) as avg_risky_rate,
  unnest([cast(n1 as bigint), cast(n0 as bigint)]) as n, {r6('p1 - p0')} as diff,
  {r6('z')} as z_score, {r6(normal_p('z'))} as p_value, {normal_p('z')} < 0.05 as significant
from (select *, (p1 - p0) / sqrt((p1 * n1 + p0 * n0) / (n1 + n0)
    * (1 - (p1 * n1 + p0 * n0) / (n1 + n0)) * (1 / n1 + 1 / n0)) as z
  from (select avg(y) filter (where t) as p1, avg(y) filter (where not t) as p0,
      cast(count(*) filter (where t) as double) as n1,
      cast(count(*) filter (where not t) as double) as n0
    from (select intervention_active as t, case when collision_alert or harsh_acceleration_event
        or braking_event then 1e0 else 0e0 end as y from clean)))""",
)
def _(c: Context):
    return testing.with_verdict(testing.intervention_test(c.clean))


@check(
    "h2_x2_yates_chi2",
    f"""select metric, cast(t1 as bigint) as t1, cast(t0 as bigint) as t0,
  cast(c1 as bigint) as c1, cast(c0 as bigint) as c0, {r6('chi2')} as chi2,
  {r6(normal_p('sqrt(chi2)'))} as p_value from cells""",
    ctes=cells_cte("clean", "intervention_active", schema.DEVICE_RATES),
)
def _(c: Context):
    return testing.rate_tests(c.clean, "intervention_active", schema.DEVICE_RATES)


@check(
    "h3_h5_x2_welch_and_interval",
    f"""select metric, cast(n1 as bigint) as n_t, {r6('m1')} as m_t, {r6('v1')} as v_t,
  cast(n0 as bigint) as n_c, {r6('m0')} as m_c, {r6('v0')} as v_c, rows1 as rows_t, rows0 as rows_c,
  {r6('t')} as t_stat, {r6('df')} as df, {r6('m1 - m0 - half')} as ci95_low,
  {r6('m1 - m0 + half')} as ci95_high, {r6(student_p('t', 'df'))} as p_value from moments""",
    ctes=moment_cte("clean", "intervention_active", {m: m for m in schema.DEVICE_MEANS}),
)
def _(c: Context):
    return testing.welch_tests(c.clean, "intervention_active", schema.DEVICE_MEANS)


@check(
    "h4_w4_rank_sums",
    f"""select metric, {r6('mw_u')} as mw_u, {r6(f'''least(1, case when z >= 0
  then {normal_p('z')} else 2 - {normal_p('z')} end)''')} as mw_p from ranked""",
    ctes=rank_ctes("clean", "intervention_active", {m: m for m in schema.DEVICE_MEANS}),
)
def _(c: Context):
    return testing.rank_sums(c.clean, "intervention_active", schema.DEVICE_MEANS)




@check(
    "x2_tail_probabilities",
    f"""select device_generation, n, {r6('z')} as z, {r6(normal_p('z'))} as normal_p,
  {r6(normal_p('sqrt(z * z)'))} as chi2_p, {r6(student_p('z', '(n - 1.0)'))} as student_p
from (select device_generation, cast(count(*) as bigint) as n,
    avg(fuel_rate_l_per_100km) / stddev_samp(fuel_rate_l_per_100km) as z
  from clean group by device_generation)""",
)
def _(c: Context):
    stats = c.clean.groupBy("device_generation").agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg("fuel_rate_l_per_100km") / F.stddev_samp("fuel_rate_l_per_100km")).alias("z"),
    )
    return stats.select(
        "device_generation", "n", "z",
        tails.normal_p(F.col("z")).alias("normal_p"),
        tails.chi2_p(F.col("z") * F.col("z")).alias("chi2_p"),
        tails.student_p(F.col("z"), (F.col("n") - 1).cast("double")).alias("student_p"),
    )


# ---------------------------------------------------------------- reports

DEVICE_KEEP = (
    "fuel_rate_l_per_100km", "downtime_hours", "maintenance_cost_usd", "breakdown_event",
    "device_generation",
)
_device_rows = "device as (select *, device_generation >= 2 as is_new from clean where " + (
    " and ".join(f"{k} is not null" for k in DEVICE_KEEP)
) + ")"
_ctes, _select = ab_sql("device", "is_new", schema.DEVICE_RATES, schema.DEVICE_MEANS)


@check("h6_device_report", _select, ctes=f"{_device_rows},{_ctes}")
def _(c: Context):
    rows = rules.complete(c.clean.withColumn("new_device", derive.new_device()), DEVICE_KEEP)
    return testing.ab_report(rows, "new_device", schema.DEVICE_RATES, schema.DEVICE_MEANS)


_feedback_rows = (
    "feedback as (select * from clean where intervention_active is not null and"
    " harsh_acceleration_event is not null and maintenance_cost_usd is not null"
    " and downtime_hours is not null)"
)
_ctes, _select = ab_sql(
    "feedback", "intervention_active", schema.FEEDBACK_RATES, schema.FEEDBACK_MEANS
)
FEEDBACK_KEEP = (
    "intervention_active", "harsh_acceleration_event", "maintenance_cost_usd", "downtime_hours",
)


@check("h7_feedback_report", _select, ctes=f"{_feedback_rows},{_ctes}")
def _(c: Context):
    rows = rules.complete(c.clean, FEEDBACK_KEEP)
    return testing.ab_report(
        rows, "intervention_active", schema.FEEDBACK_RATES, schema.FEEDBACK_MEANS
    )


KNOWN = (
    "known as (select * from clean where maintenance_type is not null"
    " and downtime_hours is not null)"
)
VEHICLES = """
vehicles as (
  select vehicle_id, avg(downtime_hours) as mean_downtime,
    avg(cast(breakdown_event as int)) as breakdown_rate, count(*) as n_records
  from known group by vehicle_id),
modes as (
  select vehicle_id, maintenance_type as kind from (
    select vehicle_id, maintenance_type, row_number() over (partition by vehicle_id
      order by count(*) desc, maintenance_type) as place
    from known group by vehicle_id, maintenance_type) where place = 1),
arms as (
  select v.*, lower(kind) = 'predictive' as is_a from vehicles v join modes m
    on v.vehicle_id = m.vehicle_id where lower(kind) in ('predictive', 'scheduled'))"""
_RECORDS = """
records as (
  select downtime_hours, cast(breakdown_event as int) as broke,
    lower(maintenance_type) = 'predictive' as is_a
  from known where lower(maintenance_type) in ('predictive', 'scheduled'))"""
_veh = {"mean_downtime_hours": "mean_downtime", "breakdown_rate": "breakdown_rate"}
_rec = {"downtime_hours": "downtime_hours", "breakdown_event_rate": "broke"}


def _grain_select(grain: str, moments: str, ranked: str) -> str:
    up = f"least(1, case when z >= 0 then {normal_p('z')} else 2 - {normal_p('z')} end)"
    return f"""select '{grain}' as grain, m.metric, 'predictive' as "group_A",
  'scheduled' as "group_B", {r6('m1')} as "A_mean", {r6('m0')} as "B_mean",
  {r6('m1 - m0')} as "mean_diff_A_minus_B", {r6('m1 - m0 - half')} as ci95_low,
  {r6('m1 - m0 + half')} as ci95_high, {r6('t')} as t_stat, {r6(student_p('t', 'df'))} as t_pvalue,
  {r6('mw_u')} as mannwhitney_u, {r6(up)} as mw_pvalue, rows1 as "n_A", rows0 as "n_B"
from {moments} m join {ranked} r on m.metric = r.metric"""


def _renamed(ctes: str, suffix: str) -> str:
    for name in ("long_values", "tied", "mid", "summed", "ranked"):
        ctes = ctes.replace(f"{name} as (", f"{name}_{suffix} as (")
        ctes = ctes.replace(f"from {name} ", f"from {name}_{suffix} ")
        ctes = ctes.replace(f"from {name})", f"from {name}_{suffix})")
    return ctes


@check(
    "h8_maintenance_report",
    _grain_select("vehicle", "mv", "ranked_v")
    + " union all "
    + _grain_select("record", "mr", "ranked_r"),
    ctes=",".join(
        [
            KNOWN, VEHICLES, _RECORDS,
            moment_cte("arms", "is_a", _veh, "mv"),
            moment_cte("records", "is_a", _rec, "mr"),
            _renamed(rank_ctes("arms", "is_a", _veh), "v"),
            _renamed(rank_ctes("records", "is_a", _rec), "r"),
        ]
    ),
)
def _(c: Context):
    return testing.maintenance_report(
        rules.complete(c.clean, ["maintenance_type", "downtime_hours"])
    )


@check(
    "a17_savings",
    f"""select {r6('(select avg(n_records) from vehicles)')} as avg_records_per_vehicle,
  {r6('greatest(0, m0 - m1)')} as hours_saved_per_vehicle_record,
  {r6('greatest(0, m0 - m1) * 1000')} as hours_saved_per_1000_records,
  {r6('m1 - m0 - half')} as "ci95_low_on_A_minus_B",
  {r6('m1 - m0 + half')} as "ci95_high_on_A_minus_B" from mv where metric = 'mean_downtime_hours'""",
    ctes=",".join([KNOWN, VEHICLES, moment_cte("arms", "is_a", _veh, "mv")]),
)
def _(c: Context):
    return testing.savings_estimate(
        rules.complete(c.clean, ["maintenance_type", "downtime_hours"])
    )


@check(
    "h9_route_report",
    f"""select optimized_route_flag, {r6('avg_fuel')} as avg_fuel, {r6('std_fuel')} as std_fuel, n as "count",
  {r6('median_fuel')} as median_fuel,
  (select {r6('-t')} from moments) as t_stat, (select {r6(student_p('t', 'df'))} from moments)
  as p_value, (select {student_p('t', 'df')} < 0.05 from moments) as significant
from (select optimized_route_flag, avg(fuel_consumption_liters) as avg_fuel,
    stddev_samp(fuel_consumption_liters) as std_fuel, count(*) as n,
    quantile_cont(fuel_consumption_liters, 0.5) as median_fuel
  from clean where fuel_consumption_liters is not null group by 1)""",
    ctes=moment_cte(
        "clean", "optimized_route_flag", {"fuel_consumption_liters": "fuel_consumption_liters"}
    ),
)
def _(c: Context):
    return testing.route_report(c.clean, with_median=True)


@check(
    "e1_stacked_metrics",
    " union all ".join(
        f"""select '{m}' as metric, intervention_active as treated, count({m}) as n,
  {r6(f'avg({m})')} as mean from clean group by 2"""
        for m in schema.DEVICE_MEANS
    ),
)
def _(c: Context):
    long = aggregates.long_values(c.clean, "intervention_active", schema.DEVICE_MEANS)
    return long.groupBy("metric", "treated").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean")
    )
