"""Weights, weighted effects and bootstrap intervals with a cell-frequency propensity."""

from __future__ import annotations

from checks.base import Context, check, r6
from roadlens import schema
from roadlens.functions.hashing import POISSON_STEPS, PRIME
from roadlens.functions.rules import complete
from roadlens.operators import weighting

CELLS = schema.CONTEXT_CATEGORIES
OUTCOMES = schema.FEEDBACK_IPW_OUTCOMES
NEEDED = (*CELLS, *OUTCOMES, "intervention_active")
_known = " and ".join(f"{n} is not null" for n in NEEDED)
WEIGHT_CTE = f"""
shares as (
  select {', '.join(CELLS)}, avg(cast(intervention_active as int)) as propensity
  from clean where {_known} group by all),
weighted as (
  select *, case when intervention_active then pbar / q else (1 - pbar) / (1 - q) end as weight,
    case when intervention_active then 1e0 else q / (1 - q) end as att_weight
  from (select trip_key, intervention_active, propensity, {', '.join(OUTCOMES)},
      least(greatest(propensity, 1e-3), 1 - 1e-3) as q,
      (select avg(cast(intervention_active as int)) from clean where {_known}) as pbar
    from clean join shares using ({', '.join(CELLS)}) where {_known}))"""


def rows(c: Context):
    kept = complete(c.clean, NEEDED).select("trip_key", *NEEDED)
    return weighting.cell_propensity(kept, "intervention_active", CELLS)


def _effect(y: str, weight: str, side: str) -> str:
    v = f"cast({y} as double)" if y != "harsh_acceleration_event" else f"cast({y} as int)"
    arm = "intervention_active" if side == "t" else "not intervention_active"
    return f"(sum({weight} * {v}) filter (where {arm}) / sum({weight}) filter (where {arm}))"


def _effects_sql(weight: str, estimand: str) -> str:
    return " union all ".join(
        f"""select '{y}' as outcome, '{estimand}' as estimand,
  {r6(_effect(y, weight, 't'))} as treatment_wt_mean,
  {r6(_effect(y, weight, 'c'))} as control_wt_mean,
  {r6(_effect(y, weight, 't') + ' - ' + _effect(y, weight, 'c'))} as diff_t_minus_c,
  count(*) as n_used from weighted"""
        for y in OUTCOMES
    )


@check(
    "c2_stabilized_weights",
    f"select trip_key, {r6('propensity')} as propensity, {r6('weight')} as weight from weighted",
    ctes=WEIGHT_CTE,
)
def _(c: Context):
    return weighting.stabilized_weights(rows(c), "intervention_active").select(
        "trip_key", "propensity", "weight"
    )


@check("c3_a15_weighted_effects", _effects_sql("weight", "ATE (stabilized IPW)"), ctes=WEIGHT_CTE)
def _(c: Context):
    weighted = weighting.stabilized_weights(rows(c), "intervention_active")
    return weighting.weighted_effects(weighted, "intervention_active", OUTCOMES)


@check("c6_att_effects", _effects_sql("att_weight", "ATT"), ctes=WEIGHT_CTE)
def _(c: Context):
    weighted = weighting.att_weights(rows(c), "intervention_active")
    return weighting.weighted_effects(weighted, "intervention_active", OUTCOMES, "ATT")


_steps = " + ".join(f"(case when u >= {s} then 1 else 0 end)" for s in POISSON_STEPS)
BOOT_CTE = f"""
seeds as (
  select *, cast('0x' || substr(md5(trip_key), 1, 12) as bigint) % {PRIME} as slope,
    cast('0x' || substr(md5(trip_key), 13, 12) as bigint) % {PRIME} as offs from weighted),
drawn as (
  select *, {_steps} as k from (
    select s.*, replicate, (slope * replicate + offs) % {PRIME} as u
    from seeds s, range(1, 201) r(replicate))),
diffs as (
  select replicate, {', '.join(
      _effect(y, 'k * weight', 't') + ' - ' + _effect(y, 'k * weight', 'c') + f' as d_{y}'
      for y in OUTCOMES)}
  from drawn group by replicate)"""


@check(
    "c4_bootstrap_interval",
    " union all ".join(
        f"""select '{y}' as outcome, {r6(f'quantile_cont(d_{y}, 0.025)')} as ci95_low,
  {r6(f'quantile_cont(d_{y}, 0.975)')} as ci95_high from diffs"""
        for y in OUTCOMES
    ),
    ctes=f"{WEIGHT_CTE},{BOOT_CTE.replace('drawn as', 'resampled as').replace('from drawn', 'from resampled')}",
)
def _(c: Context):
    weighted = weighting.stabilized_weights(rows(c), "intervention_active")
    replicated = weighting.bootstrap_effects(
        weighted, "intervention_active", OUTCOMES, "trip_key", 200
    )
    return weighting.bootstrap_interval(replicated)
