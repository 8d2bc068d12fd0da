"""Group fairness of the scored rows, before and after adjustment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..operators import fairness as fair, mapping as learning_mapping, metrics, registry as runs_table
from ..session import scratch_path, stage
from ..sources.catalog import Catalog
from ..sources.fixtures import SCORED_KEY, source
from . import learning  # noqa: F401  registers the prediction step
from .registry import query, r, rounded, step, uniform_sql, using

GROUP, PRIV = "needs_mitigation", "F"
KEY_SQL = ", ".join(SCORED_KEY)
GRID = metrics.linspace(0.01, 0.99, 25)
LOW_GRID = metrics.linspace(0.01, 0.7, 24)


def predicted(spark, sf_dir):
    return learning.scored(spark, sf_dir)


def _sums(by: str, table: str = "predicted", score: str = "score", weight: str = "weight") -> str:
    """Every rate per group, written out."""
    return f"""
SELECT {by}, count(*) AS rows, sum({weight}) AS weight,
 sum({weight} * label) / sum({weight}) AS base_rate,
 coalesce(sum({weight} * {score}) FILTER (label = 0) / nullif(sum({weight}) FILTER (label = 0), 0), 0) AS generalized_fpr,
 coalesce(sum({weight} * (1 - {score})) FILTER (label = 1) / nullif(sum({weight}) FILTER (label = 1), 0), 0) AS generalized_fnr,
 sum({weight} * pred) / sum({weight}) AS selection_rate,
 coalesce(sum({weight} * pred) FILTER (label = 1) / nullif(sum({weight}) FILTER (label = 1), 0), 0) AS tpr,
 coalesce(sum({weight} * pred) FILTER (label = 0) / nullif(sum({weight}) FILTER (label = 0), 0), 0) AS fpr
FROM {table} GROUP BY {by}"""


def _all_rates(name: str) -> str:
    return f"SELECT *, 1 - fpr AS tnr, 1 - tpr AS fnr, (tpr + 1 - fpr) / 2 AS balanced_accuracy FROM {name}"


step("group_sums", _sums(GROUP), "predicted")
step("group_rate", _all_rates("group_sums"), "group_sums")
step("cross_sums", _sums(f"{GROUP}, l_returnflag"), "predicted")
step("cross_rate", _all_rates("cross_sums"), "cross_sums")
step("side_sums", _sums("privileged", f"(SELECT *, {GROUP} = '{PRIV}' AS privileged FROM predicted)"), "predicted")
step("side_rate", _all_rates("side_sums"), "side_sums")
step("sides", "SELECT u.*, " + ", ".join(f"p.{m} AS priv_{m}" for m in fair.RATES) + """
FROM (SELECT * FROM side_rate WHERE NOT privileged) u, (SELECT * FROM side_rate WHERE privileged) p""", "side_rate")

RATE_SQL = ", ".join(r(m, 8) for m in fair.RATES)
RATE_DIGITS = {m: 8 for m in fair.RATES}


def rates(spark, sf_dir, by=GROUP):
    return fair.group_rates(predicted(spark, sf_dir), by, "label", "score", "pred", "weight")


@query("group_rates", using("group_rate") + f"SELECT {GROUP}, rows, {r('weight', 4)}, {RATE_SQL} FROM group_rate")
def _group_rates(spark, sf_dir):
    return rounded(rates(spark, sf_dir), weight=4, **RATE_DIGITS)


@query("intersectional_rates", using("cross_rate") + f"""
SELECT {GROUP}, l_returnflag, rows, {r('weight', 4)}, {RATE_SQL} FROM cross_rate""")
def _intersectional_rates(spark, sf_dir):
    return rounded(rates(spark, sf_dir, [GROUP, "l_returnflag"]), weight=4, **RATE_DIGITS)


def _single(metric):
    def run(spark, sf_dir):
        df = fair.group_rates(
            predicted(spark, sf_dir), GROUP, "label",
            score="score" if metric.startswith("generalized") else None,
            pred="pred" if metric in ("selection_rate", "balanced_accuracy") else None, weight="weight",
        )
        return rounded(df.select(GROUP, metric), **{metric: 8})
    return run


for _metric in ("generalized_fpr", "generalized_fnr", "base_rate", "selection_rate", "balanced_accuracy"):
    query(_metric, using("group_rate") + f"SELECT {GROUP}, {r(_metric, 8)} FROM group_rate")(_single(_metric))


@query("check_groups", using("scored") + f"""
SELECT count(DISTINCT {GROUP}) AS groups, count(DISTINCT label) AS classes, count(*) FILTER (label = 1) AS positives,
 count(DISTINCT {GROUP}) = 2 AND count(DISTINCT label) = 2 AND count(*) FILTER (label = 1) > 0 AS "binary" FROM scored""")
def _check_groups(spark, sf_dir):
    df = source(spark, sf_dir, "scored")
    fair.check_groups(df, GROUP, "label")
    return fair.group_checks(df, GROUP, "label")


@query("metric_difference", using("sides") + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {r(m, 8, 'unprivileged')}, {r(f'priv_{m}', 8, 'privileged')},"
    f" {r(f'{m} - priv_{m}', 8, 'difference')} FROM sides" for m in fair.RATES))
def _metric_difference(spark, sf_dir):
    difference = fair.metric_difference(
        predicted(spark, sf_dir), fair.RATES, GROUP, PRIV, "label", "score", "pred", "weight"
    )
    return rounded(difference, unprivileged=8, privileged=8, difference=8)


BOTH, BOTH_PRIV = (GROUP, "l_returnflag"), (PRIV, "A")
step("cross_side_sums", _sums(
    "privileged", f"(SELECT *, {GROUP} = '{PRIV}' AND l_returnflag = 'A' AS privileged FROM predicted)"), "predicted")
step("cross_side_rate", _all_rates("cross_side_sums"), "cross_side_sums")
step("cross_sides", "SELECT u.*, " + ", ".join(f"p.{m} AS priv_{m}" for m in fair.RATES) + """
FROM (SELECT * FROM cross_side_rate WHERE NOT privileged) u, (SELECT * FROM cross_side_rate WHERE privileged) p""", "cross_side_rate")


@query("metric_difference_cross", using("cross_sides") + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {r(m, 8, 'unprivileged')}, {r(f'priv_{m}', 8, 'privileged')},"
    f" {r(f'{m} - priv_{m}', 8, 'difference')} FROM cross_sides" for m in fair.RATES))
def _metric_difference_cross(spark, sf_dir):
    """Privileged is one combination of two columns."""
    difference = fair.metric_difference(
        predicted(spark, sf_dir), fair.RATES, BOTH, BOTH_PRIV, "label", "score", "pred", "weight"
    )
    return rounded(difference, unprivileged=8, privileged=8, difference=8)


@query("statistical_parity_cross", using("cross_sides") + f"""
SELECT {r('selection_rate - priv_selection_rate', 8, 'statistical_parity_difference')},
 {r('abs(selection_rate - priv_selection_rate)', 8, 'discrimination')} FROM cross_sides""")
def _statistical_parity_cross(spark, sf_dir):
    gap = fair.statistical_parity(predicted(spark, sf_dir), BOTH, BOTH_PRIV, "label", "pred", "weight")
    return rounded(gap, statistical_parity_difference=8, discrimination=8)


def _gap_query(name, run, **columns):
    """A one-row query whose columns are expressions over both sides."""
    def checked(spark, sf_dir):
        return rounded(run(predicted(spark, sf_dir)), **{c: 8 for c in columns})
    cells = ", ".join(r(expr, 8, c) for c, expr in columns.items())
    query(name, using("sides") + f"SELECT {cells} FROM sides")(checked)


_gap_query(
    "statistical_parity", lambda df: fair.statistical_parity(df, GROUP, PRIV, "label", "pred", "weight"),
    statistical_parity_difference="selection_rate - priv_selection_rate",
    discrimination="abs(selection_rate - priv_selection_rate)",
)
_gap_query(
    "discrimination",
    lambda df: fair.statistical_parity(df, GROUP, PRIV, "label", weight="weight").select("discrimination"),
    discrimination="abs(base_rate - priv_base_rate)",
)
_gap_query(
    "mean_difference", lambda df: fair.mean_difference(df, GROUP, PRIV, "label", "weight"),
    mean_difference="base_rate - priv_base_rate",
)
_gap_query(
    "equal_opportunity", lambda df: fair.equal_opportunity(df, GROUP, PRIV, "label", "pred", "weight"),
    equal_opportunity_difference="tpr - priv_tpr",
)
_gap_query(
    "average_odds", lambda df: fair.average_odds(df, GROUP, PRIV, "label", "pred", "weight"),
    average_odds_difference="((fpr - priv_fpr) + (tpr - priv_tpr)) / 2",
)
_gap_query(
    "disparate_impact", lambda df: fair.disparate_impact(df, GROUP, PRIV, "label", "pred", "weight"),
    disparate_impact="selection_rate / nullif(priv_selection_rate, 0)",
    disparate_impact_gap="abs(1 - selection_rate / nullif(priv_selection_rate, 0))",
)
_gap_query(
    "generalized_rate_gaps",
    lambda df: fair.generalized_rate_gaps(df, GROUP, PRIV, "label", "score", "weight"),
    gfpr_difference="generalized_fpr - priv_generalized_fpr",
    gfnr_difference="generalized_fnr - priv_generalized_fnr",
)


@query("fairness_sweep", using("scored") + f"""
SELECT {r('threshold', 8)}, {r('((tp + ptp) / (p + pp) + 1 - (fp + pfp) / (n + pn)) / 2', 8, 'balanced_accuracy')},
 {r('(tp + fp) / (p + n) - (ptp + pfp) / (pp + pn)', 8, 'statistical_parity_difference')},
 {r('((tp + fp) / (p + n)) / nullif((ptp + pfp) / (pp + pn), 0)', 8, 'disparate_impact')},
 {r('((tp / p - ptp / pp) + (fp / n - pfp / pn)) / 2', 8, 'average_odds_difference')},
 {r('tp / p - ptp / pp', 8, 'equal_opportunity_difference')}
FROM (SELECT t AS threshold,
  count(*) FILTER (g AND label = 1 AND score >= t) AS ptp, count(*) FILTER (g AND label = 0 AND score >= t) AS pfp,
  count(*) FILTER (g AND label = 1) AS pp, count(*) FILTER (g AND label = 0) AS pn,
  count(*) FILTER (NOT g AND label = 1 AND score >= t) AS tp, count(*) FILTER (NOT g AND label = 0 AND score >= t) AS fp,
  count(*) FILTER (NOT g AND label = 1) AS p, count(*) FILTER (NOT g AND label = 0) AS n
 FROM (SELECT *, {GROUP} = '{PRIV}' AS g FROM scored) CROSS JOIN (VALUES {learning.grid_values(GRID)}) v(t) GROUP BY 1)""")
def _fairness_sweep(spark, sf_dir):
    sweep = fair.fairness_sweep(
        source(spark, sf_dir, "scored"), GROUP, PRIV, "label", "score", GRID, strict=False
    )
    return rounded(sweep, **{c: 8 for c in sweep.columns})


@query("fairness_sweep_negative", using("scored") + f"""
SELECT {r('threshold', 8)}, {r('((tp + ptp) / (p + pp) + 1 - (fp + pfp) / (n + pn)) / 2', 8, 'balanced_accuracy')},
 {r('(tp + fp) / (p + n) - (ptp + pfp) / (pp + pn)', 8, 'statistical_parity_difference')},
 {r('((tp + fp) / (p + n)) / nullif((ptp + pfp) / (pp + pn), 0)', 8, 'disparate_impact')},
 {r('((tp / p - ptp / pp) + (fp / n - pfp / pn)) / 2', 8, 'average_odds_difference')},
 {r('tp / p - ptp / pp', 8, 'equal_opportunity_difference')}
FROM (SELECT t AS threshold, sum(weight) FILTER (g AND label = 0 AND 1 - score >= t) AS ptp,
  coalesce(sum(weight) FILTER (g AND label = 1 AND 1 - score >= t), 0) AS pfp,
  sum(weight) FILTER (g AND label = 0) AS pp, sum(weight) FILTER (g AND label = 1) AS pn,
  sum(weight) FILTER (NOT g AND label = 0 AND 1 - score >= t) AS tp,
  coalesce(sum(weight) FILTER (NOT g AND label = 1 AND 1 - score >= t), 0) AS fp,
  sum(weight) FILTER (NOT g AND label = 0) AS p, sum(weight) FILTER (NOT g AND label = 1) AS n
 FROM (SELECT *, {GROUP} = '{PRIV}' AS g FROM scored) CROSS JOIN (VALUES {learning.grid_values(LOW_GRID)}) v(t) GROUP BY 1)""")
def _fairness_sweep_negative(spark, sf_dir):
    """The negative label as the favourable one, with weights: its chance is what is left of the score."""
    scored = source(spark, sf_dir, "scored").withColumn("chance", 1 - F.col("score"))
    sweep = fair.fairness_sweep(scored, GROUP, PRIV, "label", "chance", LOW_GRID, "weight", strict=False, pos_label=0)
    return rounded(sweep, **{c: 8 for c in sweep.columns})


# --- calibrated adjustment ---------------------------------------------------------------

COST = {
    "weighted": ("generalized_fpr * (1 - base_rate) + generalized_fnr * base_rate", "2 * base_rate * (1 - base_rate)"),
    "fpr": ("generalized_fpr", "base_rate"),
    "fnr": ("generalized_fnr", "1 - base_rate"),
}
for _name, (_cost, _trivial) in COST.items():
    step(f"fit_{_name}", f"""
SELECT g.{GROUP} AS "group", g.base_rate, g.cost, g.trivial AS trivial_cost,
 CASE WHEN g.cost > o.cost OR (g.cost = o.cost AND g.{GROUP} < o.{GROUP}) THEN 0
  ELSE coalesce((o.cost - g.cost) / nullif(g.trivial - g.cost, 0), 0) END AS mix_rate
FROM (SELECT *, {_cost} AS cost, {_trivial} AS trivial FROM group_rate) g
JOIN (SELECT *, {_cost} AS cost FROM group_rate) o ON g.{GROUP} <> o.{GROUP}""", "group_rate")

FIT_DIGITS = {"base_rate": 8, "cost": 8, "trivial_cost": 8, "mix_rate": 8}


def fitted(spark, sf_dir, constraint="weighted"):
    return fair.fair_fit(source(spark, sf_dir, "scored"), "label", "score", GROUP, constraint, "weight")


def _fit(constraint):
    return lambda spark, sf_dir: rounded(fitted(spark, sf_dir, constraint), **FIT_DIGITS)


for _name in COST:
    query("fair_fit" if _name == "weighted" else f"fair_fit_{_name}", using(f"fit_{_name}") + f"""
SELECT "group", {', '.join(r(c, d) for c, d in FIT_DIGITS.items())} FROM fit_{_name}""")(_fit(_name))

step("adapted", f"""
SELECT s.*, CASE WHEN {uniform_sql(SCORED_KEY, 42)} < mix_rate THEN base_rate ELSE score END AS adapted_prob
FROM scored s JOIN fit_weighted ON {GROUP} = "group" """, "scored", "fit_weighted")


def adapted(spark, sf_dir, threshold=None):
    return fair.fair_adapt(
        source(spark, sf_dir, "scored"), fitted(spark, sf_dir), "score", GROUP, SCORED_KEY, threshold=threshold
    )


@query("fair_adapt", using("adapted") + f"""
SELECT {KEY_SQL}, {r('adapted_prob', 8)}, CASE WHEN adapted_prob >= 0.54e0 THEN 1 ELSE 0 END AS adapted_predict FROM adapted""")
def _fair_adapt(spark, sf_dir):
    df = adapted(spark, sf_dir, 0.54).select(*SCORED_KEY, "adapted_prob", "adapted_predict")
    return rounded(df, adapted_prob=8)


@query("fair_predict", using("adapted") + f"""
SELECT {KEY_SQL}, CASE WHEN adapted_prob > 0.5e0 THEN 1 ELSE 0 END AS predicted FROM adapted""")
def _fair_predict(spark, sf_dir):
    return fair.fair_predict(adapted(spark, sf_dir)).select(*SCORED_KEY, "predicted")


@query("adapt_from_registry", using("adapted") + f"""
SELECT {KEY_SQL}, {r('adapted_prob', 8)}, CASE WHEN adapted_prob >= 0.54e0 THEN 1 ELSE 0 END AS adapted_predict FROM adapted""")
def _adapt_from_registry(spark, sf_dir):
    """The fit is recorded with its threshold and tags, looked up by them, and applied."""
    catalog, when = Catalog(spark, scratch_path(spark, "runs")), dt.datetime(2024, 1, 1)
    other = fitted(spark, sf_dir, "fnr")
    runs_table.record(catalog, runs_table.adaptation_record(other, "a", GROUP, 0.5, when, {"cost": "fnr"}))
    runs = runs_table.record(catalog, runs_table.adaptation_record(fitted(spark, sf_dir), "b", GROUP, 0.54, when, {"cost": "weighted"}))
    run = runs_table.require_model(runs, f"mitigate_{GROUP}", "cost_gap", {"factor": GROUP, "cost": "weighted"})
    fit, threshold = runs_table.adaptation_of(spark, run)
    df = fair.fair_adapt(source(spark, sf_dir, "scored"), fit, "score", GROUP, SCORED_KEY, threshold=threshold)
    return rounded(df.select(*SCORED_KEY, "adapted_prob", "adapted_predict"), adapted_prob=8)


step("adapted_sums", _sums(GROUP, "(SELECT *, 0 AS pred FROM adapted)", "adapted_prob"), "adapted")


@query("fair_score", using("adapted_sums") + f"""
SELECT {r('max(c) - min(c)', 8, 'cost_gap')} FROM (SELECT {COST['weighted'][0]} AS c FROM adapted_sums)""")
def _fair_score(spark, sf_dir):
    score = fair.fair_score(adapted(spark, sf_dir), "label", "adapted_prob", GROUP, weight="weight")
    return rounded(score, cost_gap=8)


# --- randomised mapping ------------------------------------------------------------------

COMBOS = f"SELECT {GROUP}, l_returnflag, label, count(*) AS n FROM {{0}} GROUP BY {GROUP}, l_returnflag, label"


def mapping_text(combos: str) -> str:
    """A mapping that lifts the base rate of one group to that of the other, and moves a tenth of
    the other rows to another flag.  The same text runs in both engines, over the counted
    combinations."""
    f, o = (
        f"(SELECT sum(label * n) * 1e0 / sum(n) FROM {combos} WHERE {GROUP} = '{g}')" for g in "FO"
    )
    lift = f"round(({f} - {o}) / (1 - {o}), 6)"
    lifted = f"{GROUP} = 'O' AND label = 0"
    source_row = f"{GROUP}, l_returnflag, label"
    return f"""
SELECT {source_row}, l_returnflag AS new_l_returnflag, 1 AS new_label, {lift} AS prob FROM {combos} WHERE {lifted}
UNION ALL SELECT {source_row}, l_returnflag, 0, 1 - {lift} FROM {combos} WHERE {lifted}
UNION ALL SELECT {source_row}, l_returnflag, label, 0.9e0 FROM {combos} WHERE NOT ({lifted})
UNION ALL SELECT {source_row}, 'S', label, 0.1e0 FROM {combos} WHERE NOT ({lifted})"""


def mapped(spark, sf_dir):
    scored = source(spark, sf_dir, "scored")
    combos = stage(spark.sql(COMBOS.format("{scored}"), scored=scored))
    mapping = spark.sql(mapping_text("{combos}"), combos=combos)
    on = [GROUP, "l_returnflag", "label"]
    return fair.apply_random_mapping(scored, mapping, on, ["l_returnflag", "label"], SCORED_KEY)


step("combos", COMBOS.format("scored"), "scored")
step("mapping", mapping_text("combos"), "combos")
step("bounds", """
SELECT *, coalesce(lag(upper) OVER (PARTITION BY needs_mitigation, l_returnflag, label ORDER BY upper), 0) AS lower
FROM (SELECT *, sum(prob) OVER (PARTITION BY needs_mitigation, l_returnflag, label ORDER BY new_l_returnflag, new_label) AS upper
 FROM mapping)""", "mapping")
step("mapped", f"""
SELECT s.* REPLACE (coalesce(new_l_returnflag, s.l_returnflag) AS l_returnflag, coalesce(new_label, s.label) AS label)
FROM (SELECT *, {uniform_sql(SCORED_KEY, 1)} AS u FROM scored) s LEFT JOIN bounds b
 ON s.needs_mitigation = b.needs_mitigation AND s.l_returnflag = b.l_returnflag AND s.label = b.label
 AND u >= lower AND u < upper""", "scored", "bounds")


@query("apply_random_mapping", using("mapped") + f"SELECT {KEY_SQL}, {GROUP}, l_returnflag, label FROM mapped")
def _apply_random_mapping(spark, sf_dir):
    return mapped(spark, sf_dir).select(*SCORED_KEY, GROUP, "l_returnflag", "label")


LEARN_SEED, LEARN_SHARE, LEARN_BOUND = 5, 0.7, 0.5


@query("learned_mapping", using("scored") + f"""
SELECT {GROUP}, l_returnflag, label, count(*) AS n, 1e0 AS total_prob, true AS within_bound, true AS gap_lowered
FROM (SELECT *, {uniform_sql(SCORED_KEY, LEARN_SEED)} AS u FROM scored) WHERE u < {LEARN_SHARE} GROUP BY ALL""")
def _learned_mapping(spark, sf_dir):
    """The counted cells the mapping was learned from; whether each keeps its bound, and whether the mapping brings the
    impact ratio of the rows held out closer to one."""
    drawn = source(spark, sf_dir, "scored").withColumn("_u", uniform(SCORED_KEY, LEARN_SEED))
    train, held_out = drawn.filter(F.col("_u") < LEARN_SHARE), drawn.filter(F.col("_u") >= LEARN_SHARE)
    columns, cell = ["l_returnflag", "label"], [GROUP, "l_returnflag", "label"]
    mapping = learning_mapping.learn_mapping(train, GROUP, ["l_returnflag"], "label", max_distortion=LEARN_BOUND)
    mapped_rows = fair.apply_random_mapping(held_out, mapping, cell, columns, SCORED_KEY)

    def gap(df):
        return fair.disparate_impact(df, GROUP, PRIV, "label").select("disparate_impact_gap").scalar()

    changed = sum((F.col(c) != F.col(f"new_{c}")).cast("int") for c in columns)
    checked = mapping.groupBy(*cell).agg(
        (F.round(F.sum("prob"), 6) + F.lit(0.0)).alias("total_prob"),
        (F.sum(F.col("prob") * changed) <= LEARN_BOUND + 1e-6).alias("within_bound"))
    return learning_mapping.counted_cells(train, GROUP, ["l_returnflag"], "label").join(checked, cell).withColumn(
        "gap_lowered", gap(mapped_rows) < gap(held_out))


@query("mean_difference_mapped", using("mapped") + f"""
SELECT {r(f"avg(label) FILTER ({GROUP} <> '{PRIV}') - avg(label) FILTER ({GROUP} = '{PRIV}')", 8, 'mean_difference')} FROM mapped""")
def _mean_difference_mapped(spark, sf_dir):
    """What is left of the difference after the mapping."""
    return rounded(fair.mean_difference(mapped(spark, sf_dir), GROUP, PRIV, "label"), mean_difference=8)
