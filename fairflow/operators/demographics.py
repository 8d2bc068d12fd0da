"""Factor counts per zone, their z-scores, deciles and disparity measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.stats import delta_zscore, normal_cdf, quantile_band, unlog10, zscore
from ..functions.text import slug
from ..session import MAX_BYTES, MAX_ROWS, join_checked, size_checked
from .ranking import ntile_by
from .sampling import hash_sample

# Display order, factor column and display name; zone effects by name.
FACTOR_NAMES = (
    (0, "ethnc_grp", "Ethnicity"), (1, "hshld_incme_grp", "HH Income"), (2, "gnrt", "Age"),
    (3, "marital_status_cif", "Marital Status"), (4, "edctn", "Education"),
    (5, "ethnic_sub_grp", "Ethnic Sub Group"), (6, "gndr", "Gender"),
)
ZONE_EFFECTS = {
    "All Zones": None, "Top 80% Effected Zones": 8,
    "Top 30% Effected Zones": 3, "Top 10% Effected Zones": 1,
}
MISSING_ZSCORE = -9999.0


def factor_counts(df: DataFrame, keys: Sequence[str], factors: Sequence[str]) -> DataFrame:
    """Persons per key, factor and value in long form: ``keys, value, count, factor``.

    One scan for all factors.  A missing value keeps its row, with count 0.
    """
    text = df.select(*keys, *[F.col(f).cast("string").alias(f) for f in factors])
    long = text.unpivot(list(keys), list(factors), "factor", "value")
    counted = long.groupBy(*keys, "factor", "value").agg(F.count("value").alias("count"))
    return counted.select(*keys, "value", "count", "factor")


def factor_zscore(counts: DataFrame, by: Sequence[str] = ("zone", "factor"), value: str = "count",
                  prefix: str = "cnt") -> DataFrame:
    """Mean, deviation and z-score within each group; a group is the values of one factor."""
    group = Window.partitionBy(*by)
    mean, std = f"{prefix}_mean", f"{prefix}_std"
    return counts.withColumns({
        mean: F.avg(value).over(group), std: F.stddev(value).over(group),
    }).withColumn(f"{prefix}_zscore", zscore(F.col(value), F.col(mean), F.col(std)))


def zone_factor_pivot(counts: DataFrame, values: Sequence[str] | None = None, quantile: bool = False,
                      mode: str = "intended", factor: str | None = None) -> DataFrame:
    """One row per zone, one column per ``factor_value``: mean z-score, or lowest band.

    ``values`` names the columns and saves the extra job that finds them.  Values that
    share a slug share a column.
    """
    if factor is not None:
        counts = counts.filter(F.col("factor") == factor)
    scored = factor_zscore(counts.filter(F.col("factor").isNotNull())).select(
        "zone", "cnt_zscore", slug(F.col("factor"), F.col("value")).alias("factor_val")
    ).withColumn("cnt_quantile", quantile_band(F.col("cnt_zscore"), mode))
    cell = F.min("cnt_quantile") if quantile else F.avg("cnt_zscore")
    # Zones are kept even when all their values are missing, so NULL is pivoted and dropped.
    pivoted = scored.groupBy("zone").pivot("factor_val", None if values is None else list(values))
    return pivoted.agg(cell).drop("null")


def disparity_deciles(counts: DataFrame, q: int = 10) -> DataFrame:
    """Tile of each value inside its zone, and inside its factor across all zones.

    A zone holds only the values of a factor, so its tile is a plain window.  A factor
    holds zones times values rows, so that tile is computed over range-partitioned slices.
    """
    # Equal z-scores of different zones may differ in the last bits; they count as equal.
    falling = F.round("cnt_zscore", 12).desc_nulls_last()
    in_zone = Window.partitionBy("zone", "factor").orderBy(falling, F.col("value").asc_nulls_last())
    scored = factor_zscore(counts.filter(F.col("factor").isNotNull()))
    tiled = scored.withColumn("cnt_quantile", F.ntile(q).over(in_zone))
    across = [falling, F.col("zone").asc_nulls_last(), F.col("value").asc_nulls_last()]
    return ntile_by(tiled, ["factor"], across, q, "overall_quantile")


def _top_zscore() -> Column:
    return F.max(F.when(F.col("overall_quantile") == 1, F.col("cnt_zscore")).otherwise(0.0))


def zone_disparity(deciles: DataFrame, by: Sequence[str] = ("zone",), out: str = "disparity") -> DataFrame:
    """Best tile, and the highest z-score among values in the first tile (else 0)."""
    return deciles.groupBy(*by).agg(
        F.min("overall_quantile").alias("quantile"), _top_zscore().alias(out)
    )


def active_zones(disparity: DataFrame) -> DataFrame:
    """Number of zones in the first tile, and of all zones."""
    return disparity.agg(
        F.count_if(F.col("quantile") == 1).alias("active_zones"),
        F.count(F.lit(1)).alias("total_zones"),
    )


def top_decile_values(deciles: DataFrame) -> DataFrame:
    """How often each value is in the first tile of its factor, most frequent first."""
    return (
        deciles.filter(F.col("overall_quantile") == 1)
        .groupBy("factor", "value").agg(F.count("value").alias("count"))
        .orderBy("factor", F.col("count").desc(), F.col("value").asc_nulls_last())
    )


def aux_weights(deciles: DataFrame) -> DataFrame:
    """Per zone and factor: whether it needs mitigation, and a sample weight from 0.5 to 1.5."""
    reduced = deciles.groupBy("zone", "factor").agg(
        F.min("overall_quantile").alias("overall_quantile"),
        F.coalesce(F.max("cnt_zscore"), F.lit(MISSING_ZSCORE)).alias("_z"),
    )
    return reduced.withColumns({
        "needs_mitigation": F.when(F.col("overall_quantile") == 1, 1).otherwise(0),
        "z_percent": normal_cdf(F.col("_z")),
    }).withColumn("sample_weight", 0.5 + F.col("needs_mitigation") * F.col("z_percent")).drop("_z")


def attach_weights(df: DataFrame, weights: DataFrame, factor: str, zone: str = "zone",
                   keys: Sequence[str] = (), fraction: float = 1.0, seed: int = 42,
                   max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Predictions with the mark and weight of their zone for one factor; missing numbers become 0.

    ``fraction`` below 1 samples the predictions by their ``keys`` first.  The weights hold one
    row per zone; they are staged and measured, so the predictions are shuffled only when there
    are more zones than the bounds allow, and then without those of zones that have no weight.
    """
    sampled = df if fraction >= 1 else hash_sample(df, keys, fraction, seed)
    chosen = weights.filter(F.col("factor") == factor).withColumnRenamed("zone", zone)
    return join_checked(sampled, chosen, [zone], "inner", max_rows, max_bytes).fillna(0)


def factor_names(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add priority and display name of the factor, in display order."""
    return df.join(mapping, "factor").orderBy("priority")


def distinct_factors(counts: DataFrame) -> DataFrame:
    return counts.select("factor").distinct()


def factor_shape_join(counts: DataFrame, shapes: DataFrame, geometry: str = "the_geom") -> DataFrame:
    """Counts with the geometry of their zone and their base-10 logarithm (NULL for 0)."""
    shape = shapes.select("zone", F.col(geometry).alias("geometry"))
    return counts.join(shape, "zone").withColumn(
        "count_log10", F.when(F.col("count") > 0, F.log10("count"))
    )


def person_zone_borough(persons: DataFrame, zones: DataFrame, private: Sequence[str] = ()) -> DataFrame:
    """Persons inside a known zone with its borough, without their private columns."""
    dim = zones.select("zone", "borough")
    inside = persons.filter(F.col("zone").isNotNull()).drop("borough", *private)
    return inside.join(dim, "zone", "left")


def zone_effect_focus(counts: DataFrame, rides: DataFrame | None, factor: str,
                      max_decile: int | None = None) -> DataFrame:
    """Factor counts of the zones with the highest ride z-score, by decile per value.

    Without ``rides`` every zone gets z-score 0.
    """
    if rides is None:
        rides = counts.select("zone").distinct().withColumn("rides_z", F.lit(0.0))
    chosen = counts.filter(F.col("factor") == factor).join(rides.select("zone", "rides_z"), "zone")
    order = [F.col("rides_z").desc_nulls_last(), F.col("zone").asc()]
    tiled = ntile_by(chosen, ["value"], order, 10, "decile")
    return tiled if max_decile is None else tiled.filter(F.col("decile") <= max_decile)


def top_factors(df: DataFrame, factor: str, value: str, k: int = 4, log10: bool = False) -> DataFrame:
    """The ``k`` factor values with the largest sum; logged data is summed unlogged."""
    amount = F.coalesce(F.col(value), F.lit(0.0))
    total = F.sum(unlog10(amount) if log10 else amount).alias(value)
    top = df.groupBy(factor).agg(total).orderBy(F.col(value).desc(), F.col(factor).asc()).limit(k)
    return top.withColumn(value, F.log10(value)) if log10 else top


def group_normalise(df: DataFrame, by: str, value: str, log10: bool = False) -> DataFrame:
    """Replace a value by its z-score in the group, keeping the old one as ``value_prior``.

    The group statistics are aggregated first and joined back, so a group may hold any
    number of rows; with few groups the rows are not shuffled at all.
    """
    prior, mean, std = f"{value}_prior", f"mean_{value}", f"std_{value}"
    filled = df.withColumn(prior, F.coalesce(F.col(value), F.lit(0.0)))
    raw = unlog10(F.col(prior)) if log10 else F.col(prior)
    stats = filled.groupBy(F.col(by).alias("_by")).agg(
        F.avg(raw).alias(mean), F.stddev(raw).alias(std)
    )
    joined = filled.join(size_checked(stats), F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
    return joined.withColumn(value, zscore(raw, F.col(mean), F.col(std)))


def focus_percent(focus: DataFrame, factor: str = "value", value: str = "count_log10",
                  by: str = "zone", disparity: str | None = "rides_z", k: int = 4) -> DataFrame:
    """What a map of a focus shows: for the ``k`` largest factor values, the logged value as a
    z-score in its zone, less the ride z-score, as a percentage.

    The zone statistics cover all values; the largest are picked afterwards.
    """
    top = top_factors(focus, factor, value, k, log10=True).select(factor)
    shown, last = group_normalise(focus, by, value, log10=True), value
    if disparity is not None:
        shown, last = delta_zscore(shown, value, disparity, "_delta"), "_delta"
    kept = shown.join(size_checked(top), factor)
    return kept.withColumn("percent", normal_cdf(F.col(last)) * 100).drop("_delta")


def category_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value of each column, in one scan."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = text.unpivot([], list(cols), "column", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def metric_extent(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def bbox_distinct(df: DataFrame, col: str, lon: str, lat: str,
                  lon_range: tuple[float, float], max_lat: float) -> DataFrame:
    """Distinct values of a column strictly inside a longitude range and below a latitude."""
    inside = (F.col(lon) > lon_range[0]) & (F.col(lon) < lon_range[1]) & (F.col(lat) < max_lat)
    return df.filter(inside).select(col).distinct()
