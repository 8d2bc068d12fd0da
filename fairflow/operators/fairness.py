"""Group fairness metrics and calibrated adjustment of scores.

All metrics are ratios of conditional sums, so any number of them, for any number of
groups, comes from one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import uniform
from ..functions.stats import ratio
from ..session import MAX_BYTES, MAX_ROWS, size_checked
from .metrics import threshold_sweep

RATES = (
    "base_rate", "generalized_fpr", "generalized_fnr", "selection_rate",
    "tpr", "fpr", "tnr", "fnr", "balanced_accuracy",
)


def group_checks(df: DataFrame, group: str | Sequence[str], label: str, pos_label=1) -> DataFrame:
    """One row: number of groups and classes, positives, and whether they suit a binary method."""
    keys = [group] if isinstance(group, str) else list(group)
    checked = df.agg(
        F.count_distinct(F.struct(*keys)).alias("groups"),
        F.count_distinct(label).alias("classes"),
        F.count_if(F.col(label) == pos_label).alias("positives"),
    )
    suits = (F.col("groups") == 2) & (F.col("classes") == 2) & (F.col("positives") > 0)
    return checked.withColumn("binary", suits)


def check_groups(df: DataFrame, group: str | Sequence[str], label: str, pos_label=1,
                 binary: bool = True) -> None:
    """Raise unless the group columns exist and, if ``binary``, there are exactly two groups
    and two classes, one of them ``pos_label``."""
    keys = [group] if isinstance(group, str) else list(group)
    missing = [c for c in [*keys, label] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if not binary:
        return
    found = group_checks(df, keys, label, pos_label).first()
    if found["groups"] != 2:
        raise ValueError(f"expected 2 protected groups, got {found['groups']}")
    if found["classes"] != 2:
        raise ValueError("only binary classification is supported")
    if found["positives"] == 0:
        raise ValueError(f"positive label {pos_label!r} is not among the labels")


def group_rates(df: DataFrame, group: str | Sequence[str], label: str, score: str | None = None,
                pred: str | None = None, weight: str | None = None, pos_label=1) -> DataFrame:
    """All rates per group in one pass; several group columns give their intersections.

    Generalised rates need ``score``, confusion rates and the selection rate need ``pred``.
    A rate without a denominator is 0.  A row without a label, or without the score or the
    prediction asked for, is known nothing about and counts in no rate; ``rows`` counts all.
    """
    keys = [group] if isinstance(group, str) else list(group)
    known = F.col(label).isNotNull()
    for c in (score, pred):
        if c is not None:
            known = known & F.col(c).isNotNull()
    w = F.when(known, F.lit(1.0) if weight is None else F.col(weight).cast("double")).otherwise(0.0)
    positive = F.col(label) == F.lit(pos_label)

    def total(condition: Column | None, value: Column = w) -> Column:
        return F.sum(value if condition is None else F.when(condition, value).otherwise(0.0))

    sums = {"_w": total(None), "_pos": total(positive), "rows": F.count(F.lit(1))}
    if score is not None:
        p = F.coalesce(F.col(score), F.lit(0.0))
        sums["_gfp"] = F.sum(F.when(positive, 0.0).otherwise(w * p))
        sums["_gfn"] = total(positive, w * (1 - p))
    if pred is not None:
        called = F.col(pred) == F.lit(pos_label)
        sums["_called"], sums["_tp"] = total(called), total(positive & called)
    summed = df.groupBy(*keys).agg(*[c.alias(name) for name, c in sums.items()])

    weight_, pos = F.col("_w"), F.col("_pos")
    neg = weight_ - pos
    rates = {"weight": weight_, "base_rate": ratio(pos, weight_, 0.0)}
    if score is not None:
        rates["generalized_fpr"] = ratio(F.col("_gfp"), neg, 0.0)
        rates["generalized_fnr"] = ratio(F.col("_gfn"), pos, 0.0)
    if pred is not None:
        tp, fp = F.col("_tp"), F.col("_called") - F.col("_tp")
        rates["selection_rate"] = ratio(F.col("_called"), weight_, 0.0)
        rates["tpr"], rates["fpr"] = ratio(tp, pos, 0.0), ratio(fp, neg, 0.0)
        rates["tnr"], rates["fnr"] = ratio(neg - fp, neg, 0.0), ratio(pos - tp, pos, 0.0)
        rates["balanced_accuracy"] = (rates["tpr"] + rates["tnr"]) / 2
    return summed.select(*keys, "rows", *[c.alias(name) for name, c in rates.items()])


def is_privileged(group: str | Sequence[str], priv) -> Column:
    """Whether a row is of the privileged group: one column and its value, or several columns and
    as many values."""
    if isinstance(group, str):
        group, priv = [group], [priv]
    if len(group) != len(priv):
        raise ValueError(f"{len(group)} protected columns, {len(priv)} values")
    same = F.lit(True)
    for c, value in zip(group, priv):
        same = same & F.coalesce(F.col(c) == F.lit(value), F.lit(False))
    return same


def privilege_rates(df: DataFrame, group: str | Sequence[str], priv, label: str, score: str | None = None,
                    pred: str | None = None, weight: str | None = None, pos_label=1) -> DataFrame:
    """Rates of the privileged group and of all others together: one row of structs
    ``priv`` and ``unpriv``."""
    flagged = df.withColumn("privileged", is_privileged(group, priv))
    rates = group_rates(flagged, "privileged", label, score, pred, weight, pos_label)
    names = [c for c in rates.columns if c in RATES]
    packed = F.struct(*names)
    return rates.agg(
        F.max(F.when(~F.col("privileged"), packed)).alias("unpriv"),
        F.max(F.when(F.col("privileged"), packed)).alias("priv"),
    )


def _gap(name: str) -> Column:
    return F.col(f"unpriv.{name}") - F.col(f"priv.{name}")


def metric_difference(df: DataFrame, metrics: Sequence[str], group: str | Sequence[str], priv, label: str,
                      score: str | None = None, pred: str | None = None,
                      weight: str | None = None, pos_label=1) -> DataFrame:
    """``metric, unprivileged, privileged, difference`` for each named rate."""
    unknown = [m for m in metrics if m not in RATES]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}: choose from {list(RATES)}")
    both = privilege_rates(df, group, priv, label, score, pred, weight, pos_label)
    rows = [
        F.struct(
            F.lit(m).alias("metric"), F.col(f"unpriv.{m}").alias("unprivileged"),
            F.col(f"priv.{m}").alias("privileged"), _gap(m).alias("difference"),
        )
        for m in metrics
    ]
    return both.select(F.inline(F.array(*rows)))


def statistical_parity(df: DataFrame, group: str | Sequence[str], priv, label: str, pred: str | None = None,
                       weight: str | None = None, pos_label=1) -> DataFrame:
    """Difference in selection rates, or in base rates without predictions, and its size."""
    both = privilege_rates(df, group, priv, label, pred=pred, weight=weight, pos_label=pos_label)
    gap = _gap("base_rate" if pred is None else "selection_rate")
    return both.select(
        gap.alias("statistical_parity_difference"), F.abs(gap).alias("discrimination")
    )


def mean_difference(df: DataFrame, group: str | Sequence[str], priv, label: str, weight: str | None = None, pos_label=1) -> DataFrame:
    """Difference in mean outcomes of a labelled dataset."""
    both = privilege_rates(df, group, priv, label, weight=weight, pos_label=pos_label)
    return both.select(_gap("base_rate").alias("mean_difference"))


def equal_opportunity(df: DataFrame, group: str | Sequence[str], priv, label: str, pred: str,
                      weight: str | None = None, pos_label=1) -> DataFrame:
    both = privilege_rates(df, group, priv, label, pred=pred, weight=weight, pos_label=pos_label)
    return both.select(_gap("tpr").alias("equal_opportunity_difference"))


def average_odds(df: DataFrame, group: str | Sequence[str], priv, label: str, pred: str,
                 weight: str | None = None, pos_label=1) -> DataFrame:
    both = privilege_rates(df, group, priv, label, pred=pred, weight=weight, pos_label=pos_label)
    return both.select(((_gap("fpr") + _gap("tpr")) / 2).alias("average_odds_difference"))


def disparate_impact(df: DataFrame, group: str | Sequence[str], priv, label: str, pred: str | None = None,
                     weight: str | None = None, pos_label=1) -> DataFrame:
    """Ratio of the rates of favourable outcomes, and its distance from 1."""
    rate = "base_rate" if pred is None else "selection_rate"
    both = privilege_rates(df, group, priv, label, pred=pred, weight=weight, pos_label=pos_label)
    impact = ratio(F.col(f"unpriv.{rate}"), F.col(f"priv.{rate}"))
    return both.select(
        impact.alias("disparate_impact"), F.abs(1 - impact).alias("disparate_impact_gap")
    )


def generalized_rate_gaps(df: DataFrame, group: str | Sequence[str], priv, label: str, score: str,
                          weight: str | None = None, pos_label=1) -> DataFrame:
    both = privilege_rates(df, group, priv, label, score=score, weight=weight, pos_label=pos_label)
    return both.select(
        _gap("generalized_fpr").alias("gfpr_difference"),
        _gap("generalized_fnr").alias("gfnr_difference"),
    )


def fairness_sweep(df: DataFrame, group: str, priv, label: str, score: str,
                   thresholds: Sequence[float], weight: str | None = None,
                   strict: bool = True, pos_label=1) -> DataFrame:
    """Balanced accuracy and group gaps at every threshold, from one scan.

    ``pos_label`` is the favourable label and ``score`` its chance, as in the other gaps.
    """
    flagged = df.withColumn("privileged", is_privileged(group, priv))
    sweep = threshold_sweep(flagged, label, score, thresholds, ["privileged"], weight, strict, pos_label)

    def side(name: str, privileged: bool) -> Column:
        mine = F.col("privileged") if privileged else ~F.col("privileged")
        return F.max(F.when(mine, F.col(name)))

    def gap(name: str) -> Column:
        return side(name, False) - side(name, True)

    impact = ratio(side("selection_rate", False), side("selection_rate", True))
    tpr = ratio(F.sum("tp").cast("double"), F.sum("pos"), 0.0)
    fpr = ratio(F.sum("fp").cast("double"), F.sum("neg"), 0.0)
    return sweep.groupBy("threshold").agg(
        ((tpr + 1 - fpr) / 2).alias("balanced_accuracy"),
        gap("selection_rate").alias("statistical_parity_difference"),
        impact.alias("disparate_impact"),
        ((gap("tpr") + gap("fpr")) / 2).alias("average_odds_difference"),
        gap("tpr").alias("equal_opportunity_difference"),
    )


CONSTRAINTS = ("fpr", "fnr", "weighted")


def _cost(constraint: str, fpr: Column, fnr: Column, base_rate: Column) -> Column:
    if constraint not in CONSTRAINTS:
        raise ValueError(f"cost constraint must be one of {CONSTRAINTS}")
    if constraint == "weighted":
        return fpr * (1 - base_rate) + fnr * base_rate
    return fpr if constraint == "fpr" else fnr


def _two_groups(df: DataFrame, group: str | Sequence[str], priv) -> tuple[DataFrame, str]:
    """With ``priv`` the two groups are the privileged rows and all others."""
    if priv is None:
        if not isinstance(group, str):
            raise ValueError("several protected columns need the privileged values")
        return df, group
    return df.withColumn("_privileged", is_privileged(group, priv)), "_privileged"


def fair_fit(df: DataFrame, label: str, score: str, group: str | Sequence[str], constraint: str = "weighted",
             weight: str | None = None, priv=None, pos_label=1) -> DataFrame:
    """Mixing rates that equalise a cost between two groups (Pleiss et al. 2017).

    Two rows ``group, base_rate, cost, trivial_cost, mix_rate``: the chance of replacing a
    score by the group's base rate.  The trivial cost is that of scoring everyone with the
    base rate.  The group with the larger cost is left alone; equal costs leave both alone.
    Any other number of groups fails when the plan runs.
    """
    br = F.col("base_rate")
    # A constant score br costs br per negative and 1 - br per positive; no such rows, no cost.
    constant_fpr = F.when(br < 1, br).otherwise(0.0)
    constant_fnr = F.when(br > 0, 1 - br).otherwise(0.0)
    df, group = _two_groups(df, group, priv)
    rates = group_rates(df, group, label, score=score, weight=weight, pos_label=pos_label)
    costs = rates.select(
        F.struct(
            F.col(group).alias("group"), br.alias("base_rate"),
            _cost(constraint, F.col("generalized_fpr"), F.col("generalized_fnr"), br).alias("cost"),
            _cost(constraint, constant_fpr, constant_fnr, br).alias("trivial_cost"),
        ).alias("fit")
    )
    pair = costs.agg(
        F.count(F.lit(1)).alias("_n"), F.min("fit").alias("_a"), F.max("fit").alias("_b")
    )

    def mix(own: str, other: str, spared: Column) -> Column:
        share = ratio(F.col(f"{other}.cost") - F.col(f"{own}.cost"),
                      F.col(f"{own}.trivial_cost") - F.col(f"{own}.cost"), 0.0)
        return F.when(spared, 0.0).otherwise(share)

    first_larger = F.col("_a.cost") >= F.col("_b.cost")

    def row(own: str, other: str, spared: Column) -> Column:
        return F.struct(f"{own}.*", mix(own, other, spared).alias("mix_rate"))

    message = F.concat(F.lit("expected 2 protected groups, got "), F.col("_n").cast("string"))
    rows = F.array(row("_a", "_b", first_larger), row("_b", "_a", ~first_larger))
    checked = F.when(F.col("_n") == 2, rows).otherwise(F.raise_error(message))
    return pair.select(F.inline(checked))


def fair_adapt(df: DataFrame, params: DataFrame, score: str, group: str | Sequence[str], keys: Sequence[str],
               seed: int = 42, out: str = "adapted_prob", threshold: float | Column | None = None,
               method: str = "md5", priv=None) -> DataFrame:
    """Replace scores by the group's base rate with the fitted chance.

    The two fitted rows enter the plan as a scalar subquery, so scoring is a projection.  Rows
    of the group that is left alone draw no number.
    ``threshold`` adds ``adapted_predict``.  A group unknown to the fit is an error.
    """
    columns = df.columns
    df, group = _two_groups(df, group, priv)
    row = F.struct("group", "base_rate", "mix_rate")
    message = F.concat(F.lit("expected 2 fitted groups, got "), F.count(F.lit(1)).cast("string"))
    both = F.struct(F.min(row).alias("a"), F.max(row).alias("b"))
    pair = params.agg(F.when(F.count(F.lit(1)) == 2, both).otherwise(F.raise_error(message))).scalar()
    draw = uniform(keys, seed, method)

    def mixed(side: str) -> Column:
        rate = F.col(f"_pair.{side}.mix_rate")
        return F.when((rate > 0) & (draw < rate), F.col(f"_pair.{side}.base_rate")).otherwise(F.col(score))

    unknown = F.raise_error(F.concat(
        F.lit("protected group not seen in the fit: "), F.coalesce(F.col(group).cast("string"), F.lit("NULL"))
    )).cast("double")
    adapted = df.withColumn("_pair", pair).withColumn(
        out,
        F.when(F.col(group) == F.col("_pair.a.group"), mixed("a"))
        .when(F.col(group) == F.col("_pair.b.group"), mixed("b"))
        .otherwise(unknown),
    ).select(*[c for c in columns if c != out], out)
    if threshold is None:
        return adapted
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return adapted.withColumn("adapted_predict", F.when(F.col(out) >= cut, 1).otherwise(0))


def fair_predict(df: DataFrame, prob: str = "adapted_prob", out: str = "predicted") -> DataFrame:
    """The more likely class; a tie is the negative class."""
    return df.withColumn(out, F.when(F.col(prob) > 0.5, 1).otherwise(0))


def fair_score(df: DataFrame, label: str, prob: str, group: str | Sequence[str], constraint: str = "weighted",
               weight: str | None = None, priv=None, pos_label=1) -> DataFrame:
    """Size of the cost gap between two groups, for adapted or raw scores.  Any other number of
    groups fails when the plan runs."""
    df, group = _two_groups(df, group, priv)
    rates = group_rates(df, group, label, score=prob, weight=weight, pos_label=pos_label)
    cost = _cost(constraint, F.col("generalized_fpr"), F.col("generalized_fnr"), F.col("base_rate"))
    pair = F.struct(F.col(group).alias("group"), cost.alias("cost"))
    both = rates.agg(F.count(F.lit(1)).alias("n"), F.min(pair).alias("a"), F.max(pair).alias("b"))
    message = F.concat(F.lit("expected 2 protected groups, got "), F.col("n").cast("string"))
    gap = F.when(F.col("n") == 2, F.abs(F.col("a.cost") - F.col("b.cost"))).otherwise(F.raise_error(message).cast("double"))
    return both.select(gap.alias("cost_gap"))


def apply_random_mapping(df: DataFrame, mapping: DataFrame, on: Sequence[str],
                         to: Sequence[str], keys: Sequence[str], seed: int = 1,
                         prob: str = "prob", method: str = "md5", max_rows: int = MAX_ROWS,
                         max_bytes: int = MAX_BYTES) -> DataFrame:
    """Replace ``on``-rows by randomly picked target values.

    ``mapping`` holds ``on`` columns, ``to`` columns named ``new_<column>``, and a probability.
    The targets of one source combination become one array with cumulative bounds, so each
    row joins exactly one mapping row and no candidate pairs are formed.  Rows without a
    mapping, or beyond its total probability, stay as they are.  Within the bounds the mapping is broadcast.
    """
    targets = [f"new_{c}" for c in to]
    upto = Window.partitionBy(*on).orderBy(*targets).rowsBetween(Window.unboundedPreceding, 0)
    bounded = mapping.withColumn("_upper", F.sum(prob).over(upto))
    choices = bounded.groupBy(*[F.col(c).alias(f"_on_{c}") for c in on]).agg(
        F.array_sort(F.collect_list(F.struct("_upper", *targets))).alias("_choices")
    )
    matches = F.lit(True)
    for c in on:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    drawn = df.withColumn("_draw", uniform(keys, seed, method)).join(
        size_checked(choices, max_rows, max_bytes), matches, "left")
    picked = drawn.withColumn(
        "_pick", F.get(F.filter("_choices", lambda c: F.col("_draw") < c["_upper"]), 0)
    )
    return picked.withColumns(
        {c: F.when(F.col("_pick").isNull(), F.col(c)).otherwise(F.col(f"_pick.new_{c}")) for c in to}
    ).select(*df.columns)
