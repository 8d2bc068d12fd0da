"""Predicted and historical outcome volumes per zone, and their disparity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stats import delta_zscore, zscore


def _only(flag: str, value: str) -> Column:
    return F.when(F.col(flag) == 1, F.col(value)).otherwise(0)


def zone_outcome_volumes(df: DataFrame, zone: str = "pickup_zone", pred: str = "is_top_predict",
                         truth: str = "is_top") -> DataFrame:
    """Amounts and volumes per zone over all rows, predicted rows and true rows, in one pass."""
    return df.groupBy(zone).agg(
        F.avg("total_amount").alias("mean_total"),
        F.avg(_only(pred, "total_amount")).alias("mean"),
        F.sum("total_amount").alias("sum_total"),
        F.sum(_only(truth, "total_amount")).alias("sum_top"),
        F.sum(_only(pred, "total_amount")).alias("sum"),
        F.sum("volume").alias("volume_total"),
        F.sum(_only(truth, "volume")).alias("volume_top"),
        F.sum(_only(pred, "volume")).alias("volume"),
    )


def zone_historical_volumes(df: DataFrame, zone: str = "pickup_zone", truth: str = "is_top",
                            split: str = "test") -> DataFrame:
    """The same from the true labels of one split."""
    return df.filter(F.col("dataset") == split).groupBy(zone).agg(
        F.avg("total_amount").alias("mean_total"),
        F.avg(_only(truth, "total_amount")).alias("mean"),
        F.sum("total_amount").alias("sum_total"),
        F.sum(_only(truth, "total_amount")).alias("sum"),
        F.sum("volume").alias("volume_total"),
        F.sum(_only(truth, "volume")).alias("volume"),
    )


def global_zscore(df: DataFrame, value: str, out: str) -> DataFrame:
    """z-score against the whole frame; mean and deviation enter as a scalar subquery."""
    stats = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev(value).alias("std"))).scalar()
    return df.withColumn("_stats", stats).withColumn(
        out, zscore(F.col(value), F.col("_stats.mean"), F.col("_stats.std"))
    ).drop("_stats")


def ride_zscore(volumes: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """``zone, rides, rides_z`` of a frame of zone volumes."""
    named = volumes.select(F.col(zone).alias("zone"), F.col("volume").alias("rides"))
    return global_zscore(named, "rides", "rides_z")


def disparity_star_join(volumes: DataFrame, disparity: DataFrame, shapes: DataFrame,
                        zone: str = "pickup_zone", geometry: str = "the_geom") -> DataFrame:
    """Ride z-score against demographic z-score per zone and factor, with the zone's shape.

    The three sides hold one row per zone (and factor).
    """
    joined = (
        ride_zscore(volumes, zone)
        .join(disparity, "zone")
        .join(shapes.select("zone", F.col(geometry).alias("geometry")), "zone")
    )
    return delta_zscore(joined, "cnt_zscore", "rides_z", "disparity_z")


def outcome_deltas(volumes: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """True minus predicted volume and amount per zone, signed and absolute."""
    return volumes.withColumnRenamed(zone, "zone").withColumns({
        "delta_volume": F.col("volume_top") - F.col("volume"),
        "delta_profit": F.col("sum_top") - F.col("sum"),
    }).withColumns({
        "delta_abs_volume": F.abs("delta_volume"),
        "delta_abs_profit": F.abs("delta_profit"),
    })


def extreme_zones(deltas: DataFrame, by: str, k: int = 20, shapes: DataFrame | None = None,
                  geometry: str = "the_geom") -> DataFrame:
    """The ``k`` highest and the ``k`` lowest zones (a zone may be in both halves)."""
    high = deltas.orderBy(F.col(by).desc_nulls_last(), F.col("zone").asc()).limit(k)
    low = deltas.orderBy(F.col(by).asc_nulls_last(), F.col("zone").asc()).limit(k)
    both = high.unionByName(low)
    if shapes is None:
        return both
    return both.join(shapes.select("zone", F.col(geometry).alias("geometry")), "zone")
