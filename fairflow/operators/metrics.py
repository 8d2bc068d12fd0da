"""Binary classification metrics as aggregates.

Curves and percentiles reduce the rows to distinct scores with running totals, cell by cell
between cut points of the scores, so no step depends on one task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stats import ratio
from .ranking import step_totals


def linspace(start: float, stop: float, n: int) -> list[float]:
    """``n`` evenly spaced thresholds including both ends."""
    step = (stop - start) / (n - 1)
    return [start + i * step for i in range(n - 1)] + [stop]


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def class_sums(label: str, weight: str | None = None, pos_label=1) -> tuple[Column, Column]:
    """Weight of the positive and of the negative rows; rows without a label are neither."""
    w, positive = _weight(weight), F.col(label) == F.lit(pos_label)
    return (F.coalesce(F.sum(F.when(positive, w)), F.lit(0)),
            F.coalesce(F.sum(F.when(~positive, w)), F.lit(0)))


def score_steps(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Distinct scores, highest first, with class weights at, above and in total."""
    columns = {"score": score, "_label": label, **({} if weight is None else {"_weight": weight})}
    pos, neg = class_sums("_label", None if weight is None else "_weight")
    return step_totals(df.select(*[F.col(c).alias(n) for n, c in columns.items()]), "score", {"pos": pos, "neg": neg},
                       descending=True)


def _point(df: DataFrame, **values: float) -> DataFrame:
    """One point of a curve that belongs to no threshold."""
    return df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(n) for n, v in values.items()])


def roc_curve(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """``threshold, fpr, tpr`` at every distinct score, and the origin (threshold NULL)."""
    steps = score_steps(df, label, score, weight)
    points = steps.select(
        F.col("score").alias("threshold"),
        ratio(F.col("neg_before") + F.col("neg"), F.col("neg_total")).alias("fpr"),
        ratio(F.col("pos_before") + F.col("pos"), F.col("pos_total")).alias("tpr"),
    )
    return points.unionByName(_point(df, fpr=0.0, tpr=0.0))


def roc_auc(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Area under the ROC curve: chance that a positive outranks a negative, ties counted half."""
    steps = score_steps(df, label, score, weight)
    won = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return steps.agg(ratio(won, pairs).alias("auc"))


def pr_curve(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """``threshold, precision, recall`` at every distinct score, and the end point (0, 1)."""
    steps = score_steps(df, label, score, weight)
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    points = steps.select(
        F.col("score").alias("threshold"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("pos_total")).alias("recall"),
    )
    return points.unionByName(_point(df, precision=1.0, recall=0.0))


def event_rate(df: DataFrame, label: str) -> DataFrame:
    """Share of positive labels in percent."""
    return df.agg(ratio(F.sum(label) * 100, F.count(label)).alias("event_rate"))


def tuned_threshold(df: DataFrame, label: str, score: str, mode: str = "intended") -> DataFrame:
    """The score above which as many rows lie as there are positives.

    That is the percentile ``100 - event rate`` of the scores, with linear interpolation.
    ``strict`` takes the percentile of the labels.  Exact at any size: distinct scores with
    running counts stand in for a sort of all rows.
    """
    ranked = label if mode == "strict" else score
    totals = step_totals(
        df.select(F.col(ranked).cast("double").alias("score"), F.col(label).alias("_label")), "score",
        {"rows": F.count(F.lit(1)), "pos": F.coalesce(F.sum("_label"), F.lit(0)), "labelled": F.count("_label")})
    rate = ratio(F.col("pos_total"), F.col("labelled_total"))
    placed = totals.withColumn("_rate", rate).withColumn(
        "_position", (F.col("rows_total") - 1) * (1 - F.col("_rate"))
    )

    def value_at(position: Column) -> Column:
        return F.max(F.when(F.col("rows_before") <= position, F.col("score")))

    found = placed.agg(
        (F.max("_rate") * 100).alias("event_rate"), F.max("_position").alias("_position"),
        value_at(F.floor("_position")).alias("_low"), value_at(F.ceil("_position")).alias("_high"),
    )
    share = F.col("_position") - F.floor("_position")
    return found.select(
        "event_rate",
        (F.col("_low") + share * (F.col("_high") - F.col("_low"))).alias("threshold"),
    )


def accuracy_at_threshold(df: DataFrame, label: str, score: str, threshold: float | Column,
                          strict: bool = True) -> DataFrame:
    """Share of rows where ``score > threshold`` (``>=`` unless ``strict``) equals the label.

    ``threshold`` may be a scalar subquery.
    """
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    called = F.col(score) > cut if strict else F.col(score) >= cut
    hit = F.when(called == (F.col(label) == 1), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    pos, neg = F.count_if(F.col(label) > 0), F.count_if(F.col(label) < 1)
    return df.agg(
        pos.alias("samples_pos"), neg.alias("samples_neg"),
        ratio(neg.cast("double"), pos).alias("samples_ratio"),
    )


def _outcomes(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts of the four outcomes: one row."""
    truth, call = F.col(label) == 1, F.col(pred) == 1
    return df.agg(
        F.count_if(~truth & ~call).alias("tn"), F.count_if(~truth & call).alias("fp"),
        F.count_if(truth & ~call).alias("fn"), F.count_if(truth & call).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Count and share of all rows for each (label, predicted) pair, empty pairs included."""
    cells = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
        for y, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return _outcomes(df, label, pred).select(total.alias("_n"), F.inline(cells)).select(
        "label", "predicted", "count", ratio(F.col("count"), F.col("_n")).alias("share")
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and both averages.

    A rate without a denominator is 0.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def row(name, hit, missed, false):
        precision, recall = ratio(hit, hit + false, 0.0), ratio(hit, hit + missed, 0.0)
        f1 = ratio(2 * hit, 2 * hit + missed + false, 0.0)
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), (hit + missed).alias("support"),
        )

    counts = _outcomes(df, label, pred)
    classes = counts.select(row("0", tn, fp, fn).alias("n"), row("1", tp, fn, fp).alias("p"))
    n = F.col("n.support") + F.col("p.support")

    def averaged(name, share):
        mean = [
            (F.col(f"n.{m}") * share("n") + F.col(f"p.{m}") * share("p")).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("class"), *mean, n.alias("support"))

    hits = F.col("n.recall") * F.col("n.support") + F.col("p.recall") * F.col("p.support")
    nothing = F.lit(None).cast("double")
    accuracy = F.struct(
        F.lit("accuracy").alias("class"), nothing.alias("precision"), nothing.alias("recall"),
        ratio(hits, n, 0.0).alias("f1"), n.alias("support"),
    )
    return classes.select(F.inline(F.array(
        F.col("n"), F.col("p"), accuracy, averaged("macro avg", lambda c: F.lit(0.5)),
        averaged("weighted avg", lambda c: ratio(F.col(f"{c}.support"), n, 0.0)),
    )))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float],
                    group: Sequence[str] = (), weight: str | None = None,
                    strict: bool = True, pos_label=1) -> DataFrame:
    """Rates at every threshold, per group if given, from one scan.

    The score is the chance of ``pos_label``, the favourable label.

    Each score is placed among the ascending thresholds once; the counts per place (at most
    ``len(thresholds) + 1`` per group and class) are then summed for every threshold.
    ``strict`` calls a row positive for ``score > threshold``, else for ``>=``.
    """
    grid, n = list(thresholds), len(thresholds)
    edge = float("inf")
    cuts = [-t for t in reversed(grid)] if strict else grid
    placed = Bucketizer(
        splits=[-edge, *cuts, edge], inputCol="_placed", outputCol="_bucket"
    ).transform(
        df.filter(F.col(score).isNotNull())
        .withColumn("_placed", (-F.col(score) if strict else F.col(score)).cast("double"))
    )
    passed = (n - F.col("_bucket") if strict else F.col("_bucket")).cast("int")
    pos, neg = class_sums(label, weight, pos_label)
    counts = placed.groupBy(*group, passed.alias("_passed")).agg(pos.alias("pos"), neg.alias("neg"))
    spread = counts.select("*", F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("_i", "threshold"))
    called = F.col("_passed") > F.col("_i")
    summed = spread.groupBy("threshold", *group).agg(
        F.sum(F.when(called, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(called, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
    )
    tpr, fpr = ratio(F.col("tp"), F.col("pos"), 0.0), ratio(F.col("fp"), F.col("neg"), 0.0)
    return summed.withColumns({
        "tpr": tpr, "fpr": fpr,
        "balanced_accuracy": (tpr + 1 - fpr) / 2,
        "selection_rate": ratio(F.col("tp") + F.col("fp"), F.col("pos") + F.col("neg"), 0.0),
    })


def best_threshold(sweep: DataFrame, by: str = "balanced_accuracy") -> DataFrame:
    """The lowest threshold with the largest value."""
    return sweep.orderBy(F.col(by).desc_nulls_last(), F.col("threshold").asc()).limit(1)
