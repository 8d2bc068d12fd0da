"""Ride cleaning, derived features, demand labels and ride statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.calendar import day_of, daypart, ntz, seconds_between, weekpart
from ..functions.stats import quantile_band, zscore
from ..session import MAX_BYTES, MAX_ROWS, join_checked

DEMAND_KEYS = ("pickup_zone", "pickup_daypart", "date_trunc")

# Amounts that add up to a total, raw columns not kept as features,
# and the model's inputs.
TOTAL_PARTS = ("tolls_amount", "tip_amount", "mta_tax", "extra", "fare_amount")
RAW_COLUMNS = (
    "vendor_id", "dropoff_datetime", "pickup_latitude", "pickup_longitude", "rate_code_id",
    "store_and_fwd_flag", "dropoff_longitude", "dropoff_latitude", "fare_amount", "extra",
    "mta_tax", "tolls_amount",
)
LABEL = "is_top"
FEATURES = (
    "passenger_count", "trip_distance", "total_amount", "dropoff_zone", "ride_duration",
    "pickup_hour", "dropoff_hour", "dropoff_daypart", "day_of_week", "weekpart",
    "month_of_year", "week_of_year", "pickup_zone", "pickup_daypart",
)
FIRST_TIME, LAST_TIME = dt.datetime(2009, 1, 1), dt.datetime(2020, 1, 1)


def ride_filter(df: DataFrame, start: dt.datetime = FIRST_TIME, end: dt.datetime = LAST_TIME,
                min_fare: float = 0.0, max_fare: float = 20000.0,
                time: str = "pickup_datetime", fare: str = "fare_amount") -> DataFrame:
    """Rows inside the closed time range with a fare in range; rows without a fare go.

    All conditions are on stored columns, so they reach the Parquet scan.
    """
    return df.filter(
        (F.col(time) >= ntz(start)) & (F.col(time) <= ntz(end))
        & F.col(fare).isNotNull() & (F.col(fare) >= min_fare) & (F.col(fare) <= max_fare)
    )


def time_range_filter(df: DataFrame, time: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return df.filter((F.col(time) >= ntz(start)) & (F.col(time) <= ntz(end)))


def crossfill(df: DataFrame, a: str, b: str) -> DataFrame:
    """Fill each of two columns from the other where it is missing."""
    return df.withColumns({a: F.coalesce(a, b), b: F.coalesce(b, a)})


def repair_total(df: DataFrame, total: str = "total_amount", fare: str = "fare_amount",
                 parts: Sequence[str] = TOTAL_PARTS) -> DataFrame:
    """Keep totals of at least the fare; rebuild the others from their parts."""
    rebuilt = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.withColumn(total, F.when(F.col(total) >= F.col(fare), F.col(total)).otherwise(rebuilt))


def flag_positive(df: DataFrame, col: str = "tolls_amount", out: str = "has_toll") -> DataFrame:
    return df.withColumn(out, F.when(F.col(col) > 0, 1).otherwise(0))


def time_features(df: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime",
                  weekpart_mode: str = "intended") -> DataFrame:
    """Calendar features of the pickup, the dropoff hour, and the duration in seconds."""
    start, end = F.col(pickup), F.col(dropoff)
    return df.withColumns({
        "date_trunc": day_of(start),
        "ride_duration": seconds_between(start, end),
        "pickup_hour": F.hour(start),
        "dropoff_hour": F.hour(end),
        "day_of_week": F.dayofweek(start),
        "month_of_year": F.month(start),
        "week_of_year": F.weekofyear(start),
    }).withColumns({
        "pickup_daypart": daypart(F.col("pickup_hour")),
        "dropoff_daypart": daypart(F.col("dropoff_hour")),
    }).withColumn("weekpart", weekpart(F.col("day_of_week"), F.col("pickup_daypart"), weekpart_mode))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def ride_features(df: DataFrame, weekpart_mode: str = "intended") -> DataFrame:
    """All derived features of rides that carry a pickup and a dropoff zone."""
    derived = time_features(flag_positive(repair_total(df)), weekpart_mode=weekpart_mode)
    return drop_null_keys(derived, ["pickup_zone", "dropoff_zone"]).drop(*RAW_COLUMNS)


def daily_timeline(df: DataFrame, amount: str = "total_amount", day: str = "date_trunc",
                   time: str = "pickup_datetime", demand: str | None = None) -> DataFrame:
    """Mean, max, min and volume per day; ``demand`` adds the mean of amount times label."""
    amount_col = F.col(amount)
    extra = [] if demand is None else [F.avg(amount_col * F.col(demand)).alias("mean_demand")]
    return df.groupBy(day).agg(
        F.avg(amount_col).alias("mean_total"), *extra,
        F.max(amount_col).alias("max_total"),
        F.min(amount_col).alias("min_total"),
        F.count(time).alias("volume"),
    )


def timeline_summary(daily: DataFrame, value: str = "mean_total", volume: str = "volume",
                     day: str = "date_trunc") -> DataFrame:
    """Date range, number of days, total volume and unweighted mean of the daily means."""
    return daily.agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.count(F.lit(1)).alias("days"), F.sum(volume).alias("total_volume"),
        F.avg(value).alias("mean_value"),
    )


def two_ended_counts(df: DataFrame, a: str, b: str, out: str = "zone") -> DataFrame:
    """How often a key occurs at either end, in one scan.

    Rows without a key form one group with count 0 (and no logarithm).
    """
    ends = df.select(F.explode(F.array(a, b)).alias(out))
    return ends.groupBy(out).agg(F.count(out).alias("count")).withColumn(
        "count_log10", F.when(F.col("count") > 0, F.log10("count"))
    )


def daily_volume(df: DataFrame, keys: Sequence[str] = DEMAND_KEYS,
                 time: str = "pickup_datetime") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(time).alias("volume"))


def trailing_zscore(df: DataFrame, by: Sequence[str] = DEMAND_KEYS[:2], day: str = "date_trunc",
                    value: str = "volume", n: int = 30, frame: str = "rows",
                    prefix: str = "vol") -> DataFrame:
    """Mean, deviation and z-score against the ``n`` preceding rows or days of the group.

    ``rows`` counts existing days, ``days`` counts calendar days.  The current day is
    never part of its own frame.  A group holds one row per day.
    """
    ordered = Window.partitionBy(*by)
    if frame == "days":
        number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
        window = ordered.orderBy(number).rangeBetween(-n, -1)
    elif frame == "rows":
        window = ordered.orderBy(day).rowsBetween(-n, -1)
    else:
        raise ValueError(f"unknown frame {frame!r}: use 'rows' or 'days'")
    mean, std = f"{prefix}_mean", f"{prefix}_std"
    return df.withColumns({
        mean: F.avg(value).over(window), std: F.stddev(value).over(window),
    }).withColumn(f"{prefix}_zscore", zscore(F.col(value), F.col(mean), F.col(std)))


def demand_label(daily: DataFrame, max_band: int = 3, mode: str = "intended",
                 prefix: str = "vol") -> DataFrame:
    """Band of the z-score, and the label ``is_top`` for bands up to ``max_band``."""
    band = f"{prefix}_quantile"
    return daily.withColumn(band, quantile_band(F.col(f"{prefix}_zscore"), mode)).withColumn(
        LABEL, F.when(F.col(band) <= max_band, 1).otherwise(0)
    )


def label_joinback(rides: DataFrame, daily: DataFrame, keys: Sequence[str] = DEMAND_KEYS,
                   columns: Sequence[str] | None = None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Attach the daily statistics and labels to every ride of the same zone, part and day.

    The daily table (of ``columns``, if given, only those) is staged and measured by its footers: within the bounds
    the rides are not shuffled at all.  Beyond, a zone with a third of all rides still spreads over its days and
    dayparts, and what remains uneven is split by AQE.
    """
    side = daily if columns is None else daily.select(*keys, *columns)
    return join_checked(rides, side, keys, "left", max_rows, max_bytes)


def label_histograms(df: DataFrame, label: str = LABEL, mode: str = "intended") -> DataFrame:
    """Ride counts by label over binned duration, distance and fare, in one scan.

    Duration bins are 3 minutes wide; ``strict`` divides the seconds by 20 instead of 180.
    """
    per_step = 180 if mode == "intended" else 20
    duration = F.floor(F.col("ride_duration") / per_step).cast("double") * 3
    distance = F.floor(F.col("trip_distance") / 0.5) * 0.5
    fare = F.floor("total_amount").cast("double")

    def bin_of(analysis, metric, keep):
        return F.struct(F.lit(analysis).alias("analysis"), F.when(keep, metric).alias("metric"))

    bins = F.array(
        bin_of("duration", duration, (duration >= 0) & (duration < 240)),
        bin_of("distance", distance, distance < 20),
        bin_of("fare", fare, fare < 80),
    )
    return (
        df.select(label, F.inline(bins)).filter(F.col("metric").isNotNull())
        .groupBy("analysis", "metric", label).agg(F.count("metric").alias("count"))
    )


def split_summary(df: DataFrame, split: str = "dataset", time: str = "pickup_datetime") -> DataFrame:
    day = day_of(F.col(time))
    return df.groupBy(split).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(time).alias("count")
    )
