"""Demographic factors by zone: counts, z-scores, deciles, weights and outcome disparity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import slug
from ..operators import demographics as demo, outcomes
from ..session import reused, stage
from ..sources.fixtures import SCORED_KEY, source
from ..sources.ingest import inline_dimension
from .registry import (
    band_sql, cdf_sql, delta_sql, ppf_sql, pred_at, query, r, rounded, step, uniform_sql, using,
    zscore_sql,
)

FACTORS = ("gndr", "hshld_incme_grp", "gnrt", "edctn", "ethnc_grp")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.factor_counts(source(spark, sf_dir, "persons"), ["zone"], FACTORS)


def deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.disparity_deciles(counts(spark, sf_dir))


def zone_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome volumes of the scored rows, each counting once, called positive from 0.5 on."""
    scored = source(spark, sf_dir, "scored").select(
        F.col("zone").alias("pickup_zone"), "total_amount", F.col("label").alias("is_top"),
        pred_at("score", 0.5).alias("is_top_predict"), F.lit(1).alias("volume"),
    )
    return outcomes.zone_outcome_volumes(scored)


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "zones").select("zone", "the_geom")


step("counts", " UNION ALL ".join(
    f"SELECT zone, {f} AS value, count({f}) AS count, '{f}' AS factor FROM persons GROUP BY zone, {f}"
    for f in FACTORS), "persons")
step("factor_z", f"""
SELECT *, {zscore_sql('count', 'cnt_mean', 'cnt_std')} AS cnt_zscore FROM (
 SELECT *, avg(count) OVER (PARTITION BY zone, factor) AS cnt_mean,
  stddev(count) OVER (PARTITION BY zone, factor) AS cnt_std FROM counts)""", "counts")
step("deciles", """
SELECT *, ntile(10) OVER (PARTITION BY zone, factor ORDER BY cnt_zscore DESC NULLS LAST, value ASC NULLS LAST)::INT AS cnt_quantile,
 ntile(10) OVER (PARTITION BY factor ORDER BY cnt_zscore DESC NULLS LAST, zone, value ASC NULLS LAST)::INT AS overall_quantile
FROM (SELECT * REPLACE (round(cnt_zscore, 12) AS cnt_zscore) FROM factor_z)""", "factor_z")
step("volumes", """
SELECT zone AS pickup_zone, avg(total_amount) AS mean_total,
 avg(CASE WHEN score >= 0.5 THEN total_amount ELSE 0 END) AS mean, sum(total_amount) AS sum_total,
 sum(CASE WHEN label = 1 THEN total_amount ELSE 0 END) AS sum_top,
 sum(CASE WHEN score >= 0.5 THEN total_amount ELSE 0 END) AS sum,
 count(*) AS volume_total, count(*) FILTER (label = 1) AS volume_top, count(*) FILTER (score >= 0.5) AS volume
FROM scored GROUP BY 1""", "scored")
step("rides_z", f"""
SELECT pickup_zone AS zone, volume AS rides,
 {zscore_sql('volume', 'avg(volume) OVER ()', 'stddev(volume) OVER ()')} AS rides_z FROM volumes""", "volumes")

Z_SQL = ", ".join(r(c, 8) for c in ("cnt_mean", "cnt_std", "cnt_zscore"))
Z_DIGITS = {"cnt_mean": 8, "cnt_std": 8, "cnt_zscore": 8}

query("factor_counts", using("counts") + "SELECT * FROM counts")(counts)


@query("factor_zscore", using("factor_z") + f"SELECT zone, factor, value, count, {Z_SQL} FROM factor_z")
def _factor_zscore(spark, sf_dir):
    return rounded(demo.factor_zscore(counts(spark, sf_dir)), **Z_DIGITS)


@query("disparity_deciles", using("deciles") + f"""
SELECT zone, factor, value, count, {Z_SQL}, cnt_quantile, overall_quantile FROM deciles""")
def _disparity_deciles(spark, sf_dir):
    return rounded(deciles(spark, sf_dir), **Z_DIGITS)


@query("zone_disparity", using("deciles") + f"""
SELECT zone, factor, min(overall_quantile) AS quantile,
 {r('max(CASE WHEN overall_quantile = 1 THEN cnt_zscore ELSE 0 END)', 8, 'disparity')}
FROM deciles GROUP BY zone, factor""")
def _zone_disparity(spark, sf_dir):
    return rounded(demo.zone_disparity(deciles(spark, sf_dir), ["zone", "factor"]), disparity=8)


@query("active_zones", using("deciles") + """
SELECT count(*) FILTER (q = 1) AS active_zones, count(*) AS total_zones
FROM (SELECT zone, min(overall_quantile) AS q FROM deciles WHERE factor = 'ethnc_grp' GROUP BY 1)""")
def _active_zones(spark, sf_dir):
    chosen = deciles(spark, sf_dir).filter("factor = 'ethnc_grp'")
    return demo.active_zones(demo.zone_disparity(chosen))


@query("top_decile_values", using("deciles") + """
SELECT factor, value, count(value) AS count FROM deciles WHERE overall_quantile = 1 GROUP BY ALL""")
def _top_decile_values(spark, sf_dir):
    return demo.top_decile_values(deciles(spark, sf_dir))


step("aux", f"""
SELECT zone, factor, overall_quantile, CASE WHEN overall_quantile = 1 THEN 1 ELSE 0 END AS needs_mitigation,
 {cdf_sql('z')} AS z_percent,
 0.5 + CASE WHEN overall_quantile = 1 THEN 1 ELSE 0 END * {cdf_sql('z')} AS sample_weight
FROM (SELECT zone, factor, min(overall_quantile) AS overall_quantile, coalesce(max(cnt_zscore), -9999) AS z
 FROM deciles GROUP BY zone, factor)""", "deciles")


@query("aux_weights", using("aux") + f"""
SELECT * EXCLUDE (z_percent, sample_weight), {r('z_percent', 8)}, {r('sample_weight', 8)} FROM aux""")
def _aux_weights(spark, sf_dir):
    return rounded(demo.aux_weights(deciles(spark, sf_dir)), z_percent=8, sample_weight=8)


@query("aux_weight_join", using("scored", "aux") + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, s.zone, label, a.needs_mitigation,
 {r('sample_weight', 8)} FROM scored s JOIN aux a ON s.zone = a.zone AND factor = 'ethnc_grp'""")
def _aux_weight_join(spark, sf_dir):
    """Predictions with the weight of their zone."""
    scored = source(spark, sf_dir, "scored").drop("needs_mitigation", "weight", "score")
    joined = demo.attach_weights(scored, demo.aux_weights(deciles(spark, sf_dir)), "ethnc_grp")
    return rounded(joined.select(*SCORED_KEY, "zone", "label", "needs_mitigation", "sample_weight"), sample_weight=8)


@query("aux_weight_sample", using("scored", "aux") + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, a.needs_mitigation
FROM scored s JOIN aux a ON s.zone = a.zone AND factor = 'gnrt' WHERE {uniform_sql(SCORED_KEY, 42)} < 0.2e0""")
def _aux_weight_sample(spark, sf_dir):
    """The same for a fifth of the predictions, as the adjustment is fitted on."""
    scored = source(spark, sf_dir, "scored").select(*SCORED_KEY, "zone")
    weights = demo.aux_weights(deciles(spark, sf_dir))
    sample = demo.attach_weights(scored, weights, "gnrt", keys=SCORED_KEY, fraction=0.2)
    return sample.select(*SCORED_KEY, "needs_mitigation")


def _slug_sql():
    return "regexp_replace(concat(factor, '_', regexp_replace(value, '[^0-9a-zA-Z]+', '_', 'g')), '_+', '_', 'g')"


@query("factor_slug", using("counts") + f"""
SELECT zone, factor, value, CASE WHEN value IS NOT NULL THEN {_slug_sql()} END AS factor_val FROM counts""")
def _factor_slug(spark, sf_dir):
    return counts(spark, sf_dir).select(
        "zone", "factor", "value", slug(F.col("factor"), F.col("value")).alias("factor_val")
    )


# Column names of the pivot: every factor value as a slug.
SLUGS = {
    "gndr": ("gndr_F", "gndr_M"),
    "hshld_incme_grp": ("hshld_incme_grp_150K_", "hshld_incme_grp_50K", "hshld_incme_grp_50K_149K"),
    "gnrt": ("gnrt_GenX", "gnrt_Millennials", "gnrt_Seniors"),
    "edctn": ("edctn_AUTOMOBILE", "edctn_BUILDING", "edctn_FURNITURE", "edctn_HOUSEHOLD", "edctn_MACHINERY"),
    "ethnc_grp": tuple(f"ethnc_grp_Group_{k}" for k in range(6)),
}
COLUMNS = [s for f in SLUGS for s in SLUGS[f]]


def _pivot_sql(cell):
    cells = ", ".join(cell(s) for s in COLUMNS)
    return using("factor_z") + f"""
SELECT zone, {cells} FROM (SELECT *, {band_sql('cnt_zscore')} AS band, {_slug_sql()} AS factor_val
 FROM factor_z) GROUP BY zone"""


@query("zone_factor_pivot", _pivot_sql(
    lambda s: r(f"avg(cnt_zscore) FILTER (value IS NOT NULL AND factor_val = '{s}')", 8, s)))
def _zone_factor_pivot(spark, sf_dir):
    pivoted = demo.zone_factor_pivot(counts(spark, sf_dir), COLUMNS)
    return rounded(pivoted, **{s: 8 for s in COLUMNS})


@query("zone_factor_pivot_quantile", _pivot_sql(
    lambda s: f"min(band) FILTER (value IS NOT NULL AND factor_val = '{s}') AS {s}"))
def _zone_factor_pivot_quantile(spark, sf_dir):
    return demo.zone_factor_pivot(counts(spark, sf_dir), COLUMNS, quantile=True)


@query("distinct_factors", using("counts") + "SELECT DISTINCT factor FROM counts")
def _distinct_factors(spark, sf_dir):
    return demo.distinct_factors(counts(spark, sf_dir))


@query("factor_names", using("counts") + """
SELECT c.*, priority, factor_name FROM counts c JOIN (VALUES (0, 'ethnc_grp', 'Ethnicity'),
 (1, 'hshld_incme_grp', 'HH Income'), (2, 'gnrt', 'Age'), (4, 'edctn', 'Education'), (6, 'gndr', 'Gender'))
 d(priority, f, factor_name) ON factor = f""")
def _factor_names(spark, sf_dir):
    mapping = inline_dimension(spark, demo.FACTOR_NAMES, "priority int, factor string, factor_name string")
    return demo.factor_names(counts(spark, sf_dir), mapping)


LOG = r("CASE WHEN count > 0 THEN log10(count) END", 8, "count_log10")


@query("factor_shape_join", using("counts", "zones") + f"""
SELECT c.*, the_geom AS geometry, {LOG} FROM counts c JOIN zones z ON c.zone = z.zone""")
def _factor_shape_join(spark, sf_dir):
    joined = demo.factor_shape_join(counts(spark, sf_dir), geometries(spark, sf_dir))
    return rounded(joined, count_log10=8)


@query("log_scale", using("counts") + f"""
SELECT zone, factor, value, {LOG}, {r('CASE WHEN count > 0 THEN pow(10, log10(count)) END', 6, 'count_again')} FROM counts""")
def _log_scale(spark, sf_dir):
    logged = F.when(F.col("count") > 0, F.log10("count"))
    return rounded(counts(spark, sf_dir).select(
        "zone", "factor", "value", logged.alias("count_log10"),
        demo.unlog10(logged).alias("count_again"),
    ), count_log10=8, count_again=6)


@query("person_zone_borough", using("persons", "zones") + """
SELECT person_id, p.zone, gndr, hshld_incme_grp, gnrt, edctn, ethnc_grp, z.borough
FROM persons p LEFT JOIN zones z ON p.zone = z.zone WHERE p.zone IS NOT NULL""")
def _person_zone_borough(spark, sf_dir):
    return demo.person_zone_borough(
        source(spark, sf_dir, "persons"), source(spark, sf_dir, "zones"), ["longitude", "latitude"]
    )


def _focus_sql(rides, filters):
    return using("counts", "rides_z") + f"""
SELECT * FROM (SELECT c.*, {r('rides_z', 8)},
 ntile(10) OVER (PARTITION BY value ORDER BY rides_z DESC NULLS LAST, c.zone)::INT AS decile
 FROM counts c JOIN {rides} v ON c.zone = v.zone WHERE factor = 'ethnc_grp') {filters}"""


@query("zone_effect_focus", _focus_sql("rides_z", "WHERE decile <= 3"))
def _zone_effect_focus(spark, sf_dir):
    rides_z = outcomes.ride_zscore(zone_volumes(spark, sf_dir))
    focus = demo.zone_effect_focus(
        counts(spark, sf_dir), rides_z, "ethnc_grp", demo.ZONE_EFFECTS["Top 30% Effected Zones"]
    )
    return rounded(focus, rides_z=8)


@query("zone_effect_focus_no_model", _focus_sql("(SELECT DISTINCT zone, 0e0 AS rides_z FROM counts)", ""))
def _zone_effect_focus_no_model(spark, sf_dir):
    focus = demo.zone_effect_focus(counts(spark, sf_dir), None, "ethnc_grp", demo.ZONE_EFFECTS["All Zones"])
    return rounded(focus, rides_z=8)


REUSED = ("gndr", "gnrt", "edctn")


@query("reused_focus", using("counts", "rides_z") + " UNION ALL ".join(f"""
SELECT factor, decile, count(*) AS rows, sum(count)::BIGINT AS persons, {r('max(rides_z)', 8, 'highest')}
FROM (SELECT c.factor, c.count, rides_z, ntile(10) OVER (PARTITION BY value ORDER BY rides_z DESC NULLS LAST, c.zone)::INT AS decile
 FROM counts c JOIN rides_z v ON c.zone = v.zone WHERE factor = '{f}') GROUP BY 1, 2""" for f in REUSED))
def _reused_focus(spark, sf_dir):
    """Ride z-scores of the zones, computed once and kept in memory while several factors read them."""
    with reused(outcomes.ride_zscore(zone_volumes(spark, sf_dir))) as rides_z:
        focused = [demo.zone_effect_focus(counts(spark, sf_dir), rides_z, factor).groupBy("factor", "decile").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("count").alias("persons"), F.max("rides_z").alias("highest"))
            for factor in REUSED]
        return rounded(stage(reduce(DataFrame.unionByName, focused)), highest=8)


def _logged_counts(spark, sf_dir):
    logged = F.when(F.col("count") > 0, F.log10("count")).alias("count_log10")
    return counts(spark, sf_dir).filter("factor = 'ethnc_grp'").select("zone", "value", logged)


step("logged", """
SELECT zone, value, coalesce(CASE WHEN count > 0 THEN log10(count) END, 0) AS x
FROM counts WHERE factor = 'ethnc_grp'""", "counts")


@query("top_factors", using("logged") + f"""
SELECT value, {r('log10(s)', 8, 'count_log10')} FROM (SELECT value, sum(pow(10, x)) AS s FROM logged GROUP BY 1)
ORDER BY s DESC, value LIMIT 4""")
def _top_factors(spark, sf_dir):
    return rounded(demo.top_factors(_logged_counts(spark, sf_dir), "value", "count_log10", log10=True), count_log10=8)


step("normalised", f"""
SELECT zone, value, x AS count_log10_prior, {zscore_sql('pow(10, x)', 'm', 's')} AS count_log10,
 m AS mean_count_log10, s AS std_count_log10
FROM (SELECT *, avg(pow(10, x)) OVER w AS m, stddev(pow(10, x)) OVER w AS s FROM logged WINDOW w AS (PARTITION BY zone))""",
     "logged")
NORMALISED = ("count_log10", "count_log10_prior", "mean_count_log10", "std_count_log10")


@query("group_normalise", using("normalised") + f"""
SELECT zone, value, {', '.join(r(c, 8) for c in NORMALISED)} FROM normalised""")
def _group_normalise(spark, sf_dir):
    normalised = demo.group_normalise(_logged_counts(spark, sf_dir), "zone", "count_log10", log10=True)
    return rounded(normalised, **{c: 8 for c in NORMALISED})


@query("metric_extent", using("normalised") + f"""
SELECT {r('min(count_log10)', 8, 'min_value')}, {r('max(count_log10)', 8, 'max_value')} FROM normalised""")
def _metric_extent(spark, sf_dir):
    normalised = demo.group_normalise(_logged_counts(spark, sf_dir), "zone", "count_log10", log10=True)
    return rounded(demo.metric_extent(normalised, "count_log10"), min_value=8, max_value=8)


step("focus", """
SELECT c.*, rides_z, coalesce(CASE WHEN count > 0 THEN log10(count) END, 0) AS x,
 ntile(10) OVER (PARTITION BY value ORDER BY rides_z DESC NULLS LAST, c.zone) AS decile
FROM counts c JOIN rides_z v ON c.zone = v.zone WHERE factor = 'ethnc_grp'""", "counts", "rides_z")
step("focus_z", f"""
SELECT *, {zscore_sql('pow(10, x)', 'avg(pow(10, x)) OVER w', 'stddev(pow(10, x)) OVER w')} AS z
FROM focus WHERE decile <= 8 WINDOW w AS (PARTITION BY zone)""", "focus")


@query("focus_percent", using("focus_z") + f"""
SELECT zone, value, count, {r(cdf_sql(ppf_sql('p')) + ' * 100', 5, 'percent')}
FROM (SELECT *, {delta_sql('z', 'rides_z')} AS p FROM focus_z)
WHERE value IN (SELECT value FROM focus_z GROUP BY 1 ORDER BY sum(pow(10, x)) DESC, value LIMIT 4)""")
def _focus_percent(spark, sf_dir):
    """Ethnicity against the predicted rides, in the 80 % of zones with most rides."""
    rides_z = outcomes.ride_zscore(zone_volumes(spark, sf_dir))
    focus = demo.zone_effect_focus(
        counts(spark, sf_dir), rides_z, "ethnc_grp", demo.ZONE_EFFECTS["Top 80% Effected Zones"]
    )
    shown = demo.focus_percent(demo.factor_shape_join(focus, geometries(spark, sf_dir)))
    return rounded(shown.select("zone", "value", "count", "percent"), percent=5)


VOLUME_DIGITS = {"mean_total": 6, "mean": 6, "sum_total": 2, "sum_top": 2, "sum": 2}
VOLUME_SQL = ", ".join(r(c, d) for c, d in VOLUME_DIGITS.items())


@query("zone_outcome_volumes", using("volumes") + f"""
SELECT pickup_zone, {VOLUME_SQL}, volume_total, volume_top, volume FROM volumes""")
def _zone_outcome_volumes(spark, sf_dir):
    return rounded(zone_volumes(spark, sf_dir), **VOLUME_DIGITS)


@query("global_zscore", using("rides_z") + f"SELECT zone, rides, {r('rides_z', 8)} FROM rides_z")
def _global_zscore(spark, sf_dir):
    return rounded(outcomes.ride_zscore(zone_volumes(spark, sf_dir)), rides_z=8)


step("deltas", """
SELECT * EXCLUDE (pickup_zone), pickup_zone AS zone, volume_top - volume AS delta_volume,
 abs(volume_top - volume) AS delta_abs_volume, sum_top - sum AS delta_profit, abs(sum_top - sum) AS delta_abs_profit
FROM volumes""", "volumes")
DELTA_DIGITS = {**VOLUME_DIGITS, "delta_profit": 2, "delta_abs_profit": 2}
DELTA_SQL = "zone, " + ", ".join(r(c, d) for c, d in DELTA_DIGITS.items()) + """,
 volume_total, volume_top, volume, delta_volume, delta_abs_volume"""


@query("outcome_deltas", using("deltas") + f"SELECT {DELTA_SQL} FROM deltas")
def _outcome_deltas(spark, sf_dir):
    return rounded(outcomes.outcome_deltas(zone_volumes(spark, sf_dir)), **DELTA_DIGITS)


def _extreme_sql(by):
    return using("deltas", "zones") + f"""
SELECT {DELTA_SQL}, geometry FROM (
 SELECT d.*, the_geom AS geometry FROM (
  (SELECT * FROM deltas ORDER BY {by} DESC NULLS LAST, zone LIMIT 20) UNION ALL
  (SELECT * FROM deltas ORDER BY {by} ASC NULLS LAST, zone LIMIT 20)) d JOIN zones z ON d.zone = z.zone)"""


def _extreme(by):
    def run(spark, sf_dir):
        deltas = outcomes.outcome_deltas(zone_volumes(spark, sf_dir))
        extremes = outcomes.extreme_zones(deltas, by, 20, geometries(spark, sf_dir))
        return rounded(extremes, **DELTA_DIGITS)
    return run


query("extreme_zones", _extreme_sql("delta_volume"))(_extreme("delta_volume"))
query("extreme_zones_profit", _extreme_sql("delta_profit"))(_extreme("delta_profit"))


@query("disparity_star_join", using("rides_z", "deciles", "zones") + f"""
SELECT zone, rides, {r('rides_z', 8)}, factor, quantile, {r('cnt_zscore', 8)}, geometry,
 {r(ppf_sql('p'), 6, 'disparity_z')}
FROM (SELECT v.zone, rides, rides_z, factor, quantile, cnt_zscore, the_geom AS geometry,
  {delta_sql('cnt_zscore', 'rides_z')} AS p
 FROM rides_z v JOIN (SELECT zone, factor, min(overall_quantile) AS quantile,
   max(CASE WHEN overall_quantile = 1 THEN cnt_zscore ELSE 0 END) AS cnt_zscore
   FROM deciles GROUP BY zone, factor) d ON v.zone = d.zone
 JOIN zones z ON v.zone = z.zone)""")
def _disparity_star_join(spark, sf_dir):
    disparity = demo.zone_disparity(deciles(spark, sf_dir), ["zone", "factor"], out="cnt_zscore")
    joined = outcomes.disparity_star_join(zone_volumes(spark, sf_dir), disparity, geometries(spark, sf_dir))
    return rounded(joined, rides_z=8, cnt_zscore=8, disparity_z=6)


@query("zone_counts_dim", using("persons", "zones") + f"""
SELECT zone, count, {LOG}, geometry FROM (SELECT p.zone, count(*) AS count, any_value(the_geom) AS geometry
 FROM persons p JOIN zones z ON p.zone = z.zone GROUP BY 1)""")
def _zone_counts_dim(spark, sf_dir):
    """Counts first, shapes after: the join handles one row per zone, not one per person."""
    counted = source(spark, sf_dir, "persons").groupBy("zone").agg(F.count("zone").alias("count"))
    return rounded(demo.factor_shape_join(counted, geometries(spark, sf_dir)), count_log10=8)
