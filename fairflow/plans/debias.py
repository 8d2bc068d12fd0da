"""The whole way from raw rides to adjusted predictions and their effect by zone.

Rides get the zone their coordinates lie in, features and demand labels; a forest predicts
demand; zones with a high share of some demographic value are marked; the score adjustment is
fitted on the validation days and applied to the test days.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import demographics as demo, fairness, geo, metrics, outcomes, rides, sampling
from ..session import size_checked, spread, stage, staging_scope
from . import spatial
from .demand import HISTORY_DIGITS, HISTORY_SQL, clean_rides, demand_steps, labelled
from .disparity import deciles
from .learning import forest_pipeline
from .registry import query, r, rounded, step, using

# The factors adjusted for, one after the other.
ADJUSTED, GROUP = ("ethnc_grp", "hshld_incme_grp", "edctn"), "needs_mitigation"
TRUTH, PRED, SCORE = "is_top", "is_top_predict", "is_top_probability"


def zoned_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rides with the zones that contain their ends; an end without a point takes the other's."""
    filled = clean_rides(spark, sf_dir)
    for axis in ("longitude", "latitude"):
        filled = rides.crossfill(filled, f"pickup_{axis}", f"dropoff_{axis}")
    return geo.ride_zones(filled, size_checked(spatial.index(spark, sf_dir)), spatial.RES, exact=True)


def zoned_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rides of known zones with their split, staged for the many passes that follow."""
    featured = stage(rides.ride_features(zoned_rides(spark, sf_dir)))
    # The split reads its input several times; features are computed once.
    return sampling.date_split(labelled(featured), "pickup_datetime")


def _end_sql(end: str) -> str:
    return f"""
SELECT ride_id, e.zone FROM (SELECT ride_id, {end}_longitude AS x, {end}_latitude AS y FROM filled) JOIN edge e ON true
GROUP BY ride_id, e.zone, x, y HAVING {spatial.INSIDE}"""


step("filled", "SELECT * REPLACE (" + ", ".join(
    f"coalesce({a}_{axis}, {b}_{axis}) AS {a}_{axis}" for axis in ("longitude", "latitude")
    for a, b in (("pickup", "dropoff"), ("dropoff", "pickup"))) + ") FROM clean", "clean")
step("from_zone", _end_sql("pickup"), "filled", "edge")
step("to_zone", _end_sql("dropoff"), "filled", "edge")
step("zoned", """
SELECT f.* REPLACE (p.zone AS pickup_zone, d.zone AS dropoff_zone) FROM filled f
LEFT JOIN from_zone p ON f.ride_id = p.ride_id LEFT JOIN to_zone d ON f.ride_id = d.ride_id""",
     "filled", "from_zone", "to_zone")
demand_steps("zoned", "z_")


@query("enriched_rides", using("z_featured") + "SELECT * EXCLUDE (total_amount), " + r("total_amount", 6) + " FROM z_featured")
def _enriched_rides(spark, sf_dir):
    return rounded(rides.ride_features(zoned_rides(spark, sf_dir)), total_amount=6)


@query("enriched_history", using("z_split") + HISTORY_SQL.format("z_"))
def _enriched_history(spark, sf_dir):
    return rounded(outcomes.zone_historical_volumes(zoned_split(spark, sf_dir)), **HISTORY_DIGITS)


def scored_sides(spark: SparkSession, sf_dir: str) -> tuple[dict[str, tuple[DataFrame, DataFrame]], float]:
    """Per factor the scored validation and test rides with the mark of their zone; the tuned threshold."""
    split = stage(zoned_split(spark, sf_dir), ["dataset"])
    train = spread(split.filter("dataset = 'train'"))
    pipeline, _ = forest_pipeline(train)
    model = pipeline.fit(train)
    scored = stage(model.transform(spread(split.filter("dataset <> 'train'"))).select(
        "ride_id", "dataset", "pickup_zone", "total_amount", "volume", TRUTH, SCORE, PRED
    ), ["dataset"])
    weights = stage(demo.aux_weights(deciles(spark, sf_dir)))
    sides = {}
    for factor in ADJUSTED:
        marked = demo.attach_weights(scored, weights, factor, "pickup_zone")
        sides[factor] = marked.filter("dataset = 'validate'"), marked.filter("dataset = 'test'")
    return sides, model.stages[-1].getTunedThreshold()


def adjusted(validation: DataFrame, test: DataFrame, threshold: float) -> DataFrame:
    """Test rides with adjusted scores, fitted on the validation rides."""
    params = fairness.fair_fit(validation, TRUTH, SCORE, GROUP, "weighted")
    return fairness.fair_adapt(test, params, SCORE, GROUP, ["ride_id"], threshold=threshold)


CHOSEN = ", ".join(f"'{f}'" for f in ADJUSTED)


def debiased_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes and amounts per factor and zone of the adjusted predictions, against the true ones."""
    with staging_scope(spark) as scope:
        sides, threshold = scored_sides(spark, sf_dir)
        scope.drop(*[df for side in sides.values() for df in side])
        results = []
        for factor, (validation, test) in sides.items():
            adapted = adjusted(validation, test, threshold)
            volumes = outcomes.zone_outcome_volumes(adapted, pred="adapted_predict", truth=TRUTH)
            results.append(outcomes.outcome_deltas(volumes).withColumn("factor", F.lit(factor)))
        result = reduce(DataFrame.unionByName, results)
        scope.drop(result)
    return result


@query("debiased_outcomes", using("z_split", "aux") + f"""
SELECT factor, pickup_zone AS zone, {r('coalesce(sum(total_amount), 0)', 4, 'sum_total')},
 {r('coalesce(sum(total_amount) FILTER (is_top = 1), 0)', 4, 'sum_top')}, coalesce(sum(volume), 0)::BIGINT AS volume_total,
 coalesce(sum(volume) FILTER (is_top = 1), 0)::BIGINT AS volume_top, true AS sound
FROM z_split s JOIN aux a ON s.pickup_zone = a.zone AND factor IN ({CHOSEN}) WHERE dataset = 'test' GROUP BY 1, 2""")
def _debiased_outcomes(spark, sf_dir):
    """What does not depend on the model, and whether the rest is within it."""
    df = debiased_outcomes(spark, sf_dir)
    sound = (F.col("volume").between(0, F.col("volume_total"))
             & (F.col("delta_volume") == F.col("volume_top") - F.col("volume"))
             & (F.abs(F.col("delta_profit") - (F.col("sum_top") - F.col("sum"))) < 1e-6))
    return rounded(df.select("factor", "zone", "sum_total", "sum_top", F.col("volume_total").cast("bigint").alias("volume_total"),
                             F.col("volume_top").cast("bigint").alias("volume_top"), sound.alias("sound")), sum_total=4, sum_top=4)


def debias_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per factor the cost gap between the groups and the accuracy on the test days, before and after."""
    return _report(*scored_sides(spark, sf_dir))


@query("debias_report", using("z_split", "aux") + f"""
SELECT factor, count(*) FILTER (dataset = 'validate') AS fit_rows, count(*) FILTER (dataset = 'test') AS test_rows,
 true AS gap_closes, true AS in_range
FROM z_split s JOIN aux a ON s.pickup_zone = a.zone AND factor IN ({CHOSEN}) GROUP BY 1""")
def _debias_report(spark, sf_dir):
    """Rows by factor; whether the expected cost gap on the fitting rows closes; sane report values."""
    sides, threshold = scored_sides(spark, sf_dir)
    report, checks = _report(sides, threshold), []
    sane = report.groupBy("factor").agg(
        (F.min("accuracy") >= 0) & (F.max("accuracy") <= 1) & (F.min("cost_gap") >= 0) & (F.count(F.lit(1)) == 2))
    for factor, (validation, test) in sides.items():
        fit = fairness.fair_fit(validation, TRUTH, SCORE, GROUP, "weighted")
        mixed = F.col("cost") * (1 - F.col("mix_rate")) + F.col("trivial_cost") * F.col("mix_rate")
        closes = fit.agg(F.max(mixed) - F.min(mixed) <= F.max("cost") - F.min("cost") + 1e-9).scalar()
        checks.append(validation.agg(F.count(F.lit(1)).alias("fit_rows")).select(
            F.lit(factor).alias("factor"), "fit_rows", test.agg(F.count(F.lit(1))).scalar().alias("test_rows"),
            closes.alias("gap_closes")))
    return reduce(DataFrame.unionByName, checks).join(sane.toDF("factor", "in_range"), "factor")


def _report(sides: dict, threshold: float) -> DataFrame:
    stages = (("before", SCORE, PRED), ("after", "adapted_prob", "adapted_predict"))
    reports = []
    for factor, (validation, test) in sides.items():
        adapted = stage(adjusted(validation, test, threshold))
        for name, score, pred in stages:
            gap = fairness.fair_score(adapted, TRUTH, score, GROUP)
            accuracy = metrics.classification_report(adapted, TRUTH, pred).filter("class = 'accuracy'").select(
                F.col("f1").alias("accuracy")
            )
            reports.append(gap.select(
                F.lit(factor).alias("factor"), F.lit(name).alias("stage"), "cost_gap", accuracy.scalar().alias("accuracy")
            ))
    return reduce(DataFrame.unionByName, reports)
