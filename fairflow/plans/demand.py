"""From raw rides to demand labels: which days and zones are in demand, and what it earns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import daypart, time_range, weekpart
from ..functions.stats import quantile_band
from ..operators import outcomes, rides, sampling
from ..session import stage
from ..sources.fixtures import source
from .registry import (
    band_sql, daypart_sql, query, r, rounded, step, uniform_sql, using, zscore_sql,
)

# The tables hold rides of January 2024; the range leaves out none of them.
START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31)
AS_OF = dt.datetime(2024, 2, 10)
# Digits of a mean amount.  Amounts have two decimals, so the mean of 32 or 64 rows ends in a 5
# after the sixth or seventh and would round by chance.
MEAN = 10


def clean_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides.ride_filter(source(spark, sf_dir, "rides"), START, END)


def featured_rides(spark: SparkSession, sf_dir: str, weekpart_mode: str = "intended") -> DataFrame:
    return rides.ride_features(clean_rides(spark, sf_dir), weekpart_mode)


def labelled_days(featured: DataFrame, frame: str = "rows", mode: str = "intended") -> DataFrame:
    trailing = rides.trailing_zscore(rides.daily_volume(featured), frame=frame)
    return rides.demand_label(trailing, mode=mode)


def labelled(featured: DataFrame, mode: str = "intended") -> DataFrame:
    return rides.label_joinback(featured, labelled_days(featured, mode=mode))


def labelled_rides(spark: SparkSession, sf_dir: str, mode: str = "intended") -> DataFrame:
    return labelled(featured_rides(spark, sf_dir), mode)


def demand_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides to daily earnings weighted by demand: the whole chain."""
    return rides.daily_timeline(labelled_rides(spark, sf_dir), demand=rides.LABEL)


step("clean", """
SELECT * FROM rides WHERE pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime <= TIMESTAMP '2024-12-31'
 AND fare_amount IS NOT NULL AND fare_amount >= 0 AND fare_amount <= 20000""", "rides")

TOTAL = """CASE WHEN total_amount >= fare_amount THEN total_amount
 ELSE tolls_amount + tip_amount + mta_tax + extra + fare_amount END"""
WEEKEND = "(dayofweek(pickup_datetime) = 5 AND pickup_daypart = 'night')"


def features_sql(table: str, weekend: str) -> str:
    return f"""
SELECT *, CASE WHEN {weekend} THEN 'weekend' ELSE 'weekday' END AS weekpart FROM (
 SELECT ride_id, pickup_datetime, pickup_zone, dropoff_zone, passenger_count, trip_distance, tip_amount,
  {TOTAL} AS total_amount, CASE WHEN tolls_amount > 0 THEN 1 ELSE 0 END AS has_toll,
  date_trunc('day', pickup_datetime)::TIMESTAMP AS date_trunc,
  date_diff('second', pickup_datetime, dropoff_datetime) AS ride_duration,
  hour(pickup_datetime)::INT AS pickup_hour, hour(dropoff_datetime)::INT AS dropoff_hour,
  (dayofweek(pickup_datetime) + 1)::INT AS day_of_week, month(pickup_datetime)::INT AS month_of_year,
  week(pickup_datetime)::INT AS week_of_year,
  {daypart_sql('hour(pickup_datetime)')} AS pickup_daypart, {daypart_sql('hour(dropoff_datetime)')} AS dropoff_daypart
 FROM {table} WHERE pickup_zone IS NOT NULL AND dropoff_zone IS NOT NULL)"""


def trailing_sql(daily: str, window: str) -> str:
    z = zscore_sql("volume", "vol_mean", "vol_std")
    return f"""
SELECT *, {z} AS vol_zscore FROM (SELECT *, avg(volume) OVER w AS vol_mean, stddev(volume) OVER w AS vol_std
 FROM {daily} WINDOW w AS (PARTITION BY pickup_zone, pickup_daypart ORDER BY date_trunc {window}))"""


def label_sql(mode: str, trailed: str = "trailed") -> str:
    return f"""
SELECT *, CASE WHEN vol_quantile <= 3 THEN 1 ELSE 0 END AS is_top
FROM (SELECT *, {band_sql('vol_zscore', mode)} AS vol_quantile FROM {trailed})"""


def demand_steps(table: str, prefix: str = "") -> None:
    """The chain from clean rides in ``table`` to labelled rides with a split."""
    p = prefix
    step(f"{p}featured", features_sql(table, WEEKEND + " OR dayofweek(pickup_datetime) IN (0, 6)"), table)
    step(f"{p}daily", f"""
SELECT pickup_zone, pickup_daypart, date_trunc, count(pickup_datetime) AS volume
FROM {p}featured GROUP BY ALL""", f"{p}featured")
    step(f"{p}trailed", trailing_sql(f"{p}daily", "ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING"), f"{p}daily")
    step(f"{p}labelled_days", label_sql("intended", f"{p}trailed"), f"{p}trailed")
    step(f"{p}labelled", f"""
SELECT f.*, d.* EXCLUDE (pickup_zone, pickup_daypart, date_trunc) FROM {p}featured f
LEFT JOIN {p}labelled_days d ON f.pickup_zone = d.pickup_zone AND f.pickup_daypart = d.pickup_daypart
 AND f.date_trunc = d.date_trunc""", f"{p}featured", f"{p}labelled_days")
    step(f"{p}cuts", f"""
SELECT days[least(round_even(n * 0.6e0, 0)::INT, n - 1) + 1] AS train,
 days[least(round_even(n * (0.6e0 + 0.2e0), 0)::INT, n - 1) + 1] AS validate
FROM (SELECT days, len(days)::INT AS n FROM (
 SELECT list_sort(list(DISTINCT date_trunc('day', pickup_datetime)::TIMESTAMP)) AS days FROM {p}featured))""",
         f"{p}featured")
    step(f"{p}split", f"""
SELECT l.*, CASE WHEN pickup_datetime < train THEN 'train' WHEN pickup_datetime < validate THEN 'validate'
 ELSE 'test' END AS dataset FROM {p}labelled l, {p}cuts""", f"{p}labelled", f"{p}cuts")


demand_steps("clean")

query("ride_filter", using("clean") + "SELECT * FROM clean")(clean_rides)


@query("crossfill", using("rides") + """
SELECT ride_id, coalesce(pickup_longitude, dropoff_longitude) AS pickup_longitude,
 coalesce(dropoff_longitude, pickup_longitude) AS dropoff_longitude FROM rides""")
def _crossfill(spark, sf_dir):
    df = source(spark, sf_dir, "rides").select("ride_id", "pickup_longitude", "dropoff_longitude")
    return rides.crossfill(df, "pickup_longitude", "dropoff_longitude")


@query("repair_total", using("rides") + f"SELECT ride_id, {r(TOTAL, 6, 'total_amount')} FROM rides")
def _repair_total(spark, sf_dir):
    repaired = rides.repair_total(source(spark, sf_dir, "rides"))
    return rounded(repaired.select("ride_id", "total_amount"), total_amount=6)


@query("flag_positive", using("rides") + """
SELECT ride_id, CASE WHEN tolls_amount > 0 THEN 1 ELSE 0 END AS has_toll FROM rides""")
def _flag_positive(spark, sf_dir):
    return rides.flag_positive(source(spark, sf_dir, "rides")).select("ride_id", "has_toll")


@query("daypart", using("rides") + f"""
SELECT ride_id, {daypart_sql('hour(pickup_datetime)')} AS pickup_daypart FROM rides""")
def _daypart(spark, sf_dir):
    return source(spark, sf_dir, "rides").select(
        "ride_id", daypart(F.hour("pickup_datetime")).alias("pickup_daypart")
    )


def _weekpart(mode):
    def run(spark, sf_dir):
        df = source(spark, sf_dir, "rides")
        part = daypart(F.hour("pickup_datetime"))
        return df.select("ride_id", weekpart(F.dayofweek("pickup_datetime"), part, mode).alias("weekpart"))
    return run


def _weekpart_sql(weekend):
    return using("rides") + f"""
SELECT ride_id, CASE WHEN {weekend} THEN 'weekend' ELSE 'weekday' END AS weekpart
FROM (SELECT *, {daypart_sql('hour(pickup_datetime)')} AS pickup_daypart FROM rides)"""


query("weekpart", _weekpart_sql(WEEKEND + " OR dayofweek(pickup_datetime) IN (0, 6)"))(_weekpart("intended"))
query("weekpart_strict", _weekpart_sql(WEEKEND))(_weekpart("strict"))

FEATURE_SQL = " SELECT * EXCLUDE (total_amount), " + r("total_amount", 6) + " FROM "


@query("time_features", using("featured") + FEATURE_SQL + "featured")
def _time_features(spark, sf_dir):
    return rounded(featured_rides(spark, sf_dir), total_amount=6)


@query("ride_duration", using("rides") + """
SELECT ride_id, date_diff('second', pickup_datetime, dropoff_datetime) AS ride_duration FROM rides""")
def _ride_duration(spark, sf_dir):
    return rides.time_features(source(spark, sf_dir, "rides")).select("ride_id", "ride_duration")


@query("drop_null_keys", using("rides") + """
SELECT * FROM rides WHERE pickup_longitude IS NOT NULL AND fare_amount IS NOT NULL""")
def _drop_null_keys(spark, sf_dir):
    return rides.drop_null_keys(source(spark, sf_dir, "rides"), ["pickup_longitude", "fare_amount"])


@query("time_range_filter", using("rides") + """
SELECT * FROM rides WHERE pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime <= TIMESTAMP '2024-02-01'""")
def _time_range_filter(spark, sf_dir):
    return rides.time_range_filter(
        source(spark, sf_dir, "rides"), "pickup_datetime", *time_range("last_month", AS_OF)
    )


TIMELINE = (f"SELECT date_trunc, {r('avg(total_amount)', MEAN, 'mean_total')},"
            f" {r('max(total_amount)', 6, 'max_total')}, {r('min(total_amount)', 6, 'min_total')},"
            " count(pickup_datetime) AS volume")
TIMELINE_DIGITS = {"mean_total": MEAN, "max_total": 6, "min_total": 6}


@query("daily_timeline", using("featured") + f"{TIMELINE} FROM featured GROUP BY date_trunc")
def _daily_timeline(spark, sf_dir):
    return rounded(rides.daily_timeline(featured_rides(spark, sf_dir)), **TIMELINE_DIGITS)


@query("daily_timeline_raw", using("clean") + f"""
{TIMELINE} FROM (SELECT pickup_datetime, fare_amount AS total_amount,
 date_trunc('day', pickup_datetime)::TIMESTAMP AS date_trunc FROM clean) GROUP BY date_trunc""")
def _daily_timeline_raw(spark, sf_dir):
    dated = rides.time_features(clean_rides(spark, sf_dir))
    return rounded(rides.daily_timeline(dated, amount="fare_amount"), **TIMELINE_DIGITS)


@query("daily_timeline_demand", using("labelled") + f"""
{TIMELINE}, {r('avg(total_amount * is_top)', MEAN, 'mean_demand')} FROM labelled GROUP BY date_trunc""")
def _daily_timeline_demand(spark, sf_dir):
    return rounded(demand_timeline(spark, sf_dir), mean_demand=MEAN, **TIMELINE_DIGITS)


@query("timeline_summary", using("featured") + f"""
SELECT min(date_trunc) AS first_day, max(date_trunc) AS last_day, count(*) AS days,
 sum(volume)::BIGINT AS total_volume, {r('avg(mean_total)', 6, 'mean_value')}
FROM (SELECT date_trunc, avg(total_amount) AS mean_total, count(*) AS volume FROM featured GROUP BY 1)""")
def _timeline_summary(spark, sf_dir):
    daily = rides.daily_timeline(featured_rides(spark, sf_dir))
    return rounded(rides.timeline_summary(daily), mean_value=6)


ENDS = """
SELECT zone, sum(n)::BIGINT AS count FROM (
 SELECT pickup_zone AS zone, count(pickup_zone) AS n FROM rides GROUP BY 1
 UNION ALL SELECT dropoff_zone, count(dropoff_zone) FROM rides GROUP BY 1) GROUP BY 1"""
step("ends", ENDS, "rides")


@query("two_ended_counts", using("ends") + f"""
SELECT zone, count, {r('CASE WHEN count > 0 THEN log10(count) END', 8, 'count_log10')} FROM ends""")
def _two_ended_counts(spark, sf_dir):
    counts = rides.two_ended_counts(source(spark, sf_dir, "rides"), "pickup_zone", "dropoff_zone")
    return rounded(counts, count_log10=8)


@query("sorted_counts", using("ends") + "SELECT zone, count FROM ends ORDER BY count DESC, zone")
def _sorted_counts(spark, sf_dir):
    counts = rides.two_ended_counts(source(spark, sf_dir, "rides"), "pickup_zone", "dropoff_zone")
    return counts.select("zone", "count").orderBy(F.col("count").desc(), "zone")


@query("daily_volume", using("daily") + "SELECT * FROM daily")
def _daily_volume(spark, sf_dir):
    return rides.daily_volume(featured_rides(spark, sf_dir))


STATS_SQL = " SELECT * EXCLUDE (vol_mean, vol_std, vol_zscore), " + ", ".join(
    r(c, 8) for c in ("vol_mean", "vol_std", "vol_zscore")) + " FROM "
STATS_DIGITS = {"vol_mean": 8, "vol_std": 8, "vol_zscore": 8}


@query("trailing_zscore", using("trailed") + STATS_SQL + "trailed")
def _trailing_zscore(spark, sf_dir):
    daily = rides.daily_volume(featured_rides(spark, sf_dir))
    return rounded(rides.trailing_zscore(daily), **STATS_DIGITS)


# Orders span years with gaps, so the two frames differ.
step("order_days", """
SELECT o_orderpriority, o_orderdate::DATE::TIMESTAMP AS day, count(*) AS volume FROM orders GROUP BY ALL""")


def _order_days(spark, sf_dir):
    day = F.to_date("o_orderdate").cast("timestamp_ntz").alias("day")
    orders = source(spark, sf_dir, "orders")
    return orders.groupBy("o_orderpriority", day).agg(F.count(F.lit(1)).alias("volume"))


def _order_frame(window):
    z = zscore_sql("volume", "vol_mean", "vol_std")
    return using("order_days") + f"""{STATS_SQL} (SELECT *, {z} AS vol_zscore FROM (
 SELECT *, avg(volume) OVER w AS vol_mean, stddev(volume) OVER w AS vol_std FROM order_days
 WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day {window})))"""


@query("trailing_zscore_days", _order_frame(
    "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"))
def _trailing_zscore_days(spark, sf_dir):
    days = rides.trailing_zscore(_order_days(spark, sf_dir), ["o_orderpriority"], "day", frame="days")
    return rounded(days, **STATS_DIGITS)


def _quantile_band(mode):
    def run(spark, sf_dir):
        daily = rides.trailing_zscore(rides.daily_volume(featured_rides(spark, sf_dir)))
        return daily.select(
            *rides.DEMAND_KEYS, quantile_band(F.col("vol_zscore"), mode).alias("vol_quantile")
        )
    return run


def _demand_label(mode):
    def run(spark, sf_dir):
        return rounded(labelled_days(featured_rides(spark, sf_dir), mode=mode), **STATS_DIGITS)
    return run


for _mode, _suffix in (("intended", ""), ("strict", "_strict")):
    query(f"quantile_band{_suffix}", using("trailed") + f"""
SELECT pickup_zone, pickup_daypart, date_trunc, {band_sql('vol_zscore', _mode)} AS vol_quantile
FROM trailed""")(_quantile_band(_mode))
    query(f"demand_label{_suffix}", using("trailed") + f"{STATS_SQL} ({label_sql(_mode)})")(_demand_label(_mode))


@query("label_joinback", using("labelled") + """
SELECT ride_id, pickup_zone, pickup_daypart, date_trunc, volume, vol_quantile, is_top FROM labelled""")
def _label_joinback(spark, sf_dir):
    return labelled_rides(spark, sf_dir).select(
        "ride_id", *rides.DEMAND_KEYS, "volume", "vol_quantile", "is_top"
    )


def _label_histograms(mode):
    def run(spark, sf_dir):
        return rides.label_histograms(labelled_rides(spark, sf_dir), mode=mode)
    return run


def _histogram_sql(width):
    return using("labelled") + f"""
SELECT 'duration' AS analysis, floor(ride_duration / {width}e0) * 3 AS metric, is_top, count(*) AS count FROM labelled
WHERE floor(ride_duration / {width}e0) * 3 >= 0 AND floor(ride_duration / {width}e0) * 3 < 240 GROUP BY ALL
UNION ALL SELECT 'distance', floor(trip_distance / 0.5e0) * 0.5e0 AS metric, is_top, count(*) FROM labelled
WHERE floor(trip_distance / 0.5e0) * 0.5e0 < 20 GROUP BY ALL
UNION ALL SELECT 'fare', floor(total_amount) AS metric, is_top, count(*) FROM labelled
WHERE floor(total_amount) < 80 GROUP BY ALL"""


query("label_histograms", _histogram_sql(180))(_label_histograms("intended"))
query("label_histograms_strict", _histogram_sql(20))(_label_histograms("strict"))

def split_rides(spark, sf_dir):
    return sampling.date_split(labelled_rides(spark, sf_dir), "pickup_datetime")


@query("date_split", using("split") + "SELECT ride_id, pickup_datetime, dataset FROM split")
def _date_split(spark, sf_dir):
    split = sampling.date_split(featured_rides(spark, sf_dir), "pickup_datetime")
    return split.select("ride_id", "pickup_datetime", "dataset")


@query("split_summary", using("split") + """
SELECT dataset, min(date_trunc) AS first_day, max(date_trunc) AS last_day, count(*) AS count FROM split GROUP BY 1""")
def _split_summary(spark, sf_dir):
    split = sampling.date_split(featured_rides(spark, sf_dir), "pickup_datetime")
    return rides.split_summary(split)


TOP = "CASE WHEN is_top = 1 THEN {0} ELSE 0 END"
HISTORY_SQL = f"""
SELECT pickup_zone, {r('avg(total_amount)', MEAN, 'mean_total')}, {r(f"avg({TOP.format('total_amount')})", MEAN, 'mean')},
 {r('sum(total_amount)', 4, 'sum_total')}, {r(f"sum({TOP.format('total_amount')})", 4, 'sum')},
 sum(volume)::BIGINT AS volume_total, sum({TOP.format('volume')})::BIGINT AS volume
FROM {{0}}split WHERE dataset = 'test' GROUP BY 1"""
HISTORY_DIGITS = {"mean_total": MEAN, "mean": MEAN, "sum_total": 4, "sum": 4}


@query("zone_historical_volumes", using("split") + HISTORY_SQL.format(""))
def _zone_historical_volumes(spark, sf_dir):
    volumes = outcomes.zone_historical_volumes(split_rides(spark, sf_dir))
    return rounded(volumes, **HISTORY_DIGITS)


@query("hash_sample", using("rides") + f"""
SELECT ride_id, pickup_datetime FROM rides WHERE {uniform_sql(['ride_id'], 42)} < 0.03e0""")
def _hash_sample(spark, sf_dir):
    df = source(spark, sf_dir, "rides").select("ride_id", "pickup_datetime")
    return sampling.hash_sample(df, ["ride_id"], 0.03)


@query("random_split", using("rides") + f"""
SELECT ride_id, CASE WHEN u < 0.7e0 THEN 'train' WHEN u < 0.85e0 THEN 'valid' ELSE 'test' END AS dataset
FROM (SELECT ride_id, {uniform_sql(['ride_id'], 1)} AS u FROM rides)""")
def _random_split(spark, sf_dir):
    df = source(spark, sf_dir, "rides").select("ride_id")
    return sampling.random_split(df, ["ride_id"], {"train": 0.70, "valid": 0.15, "test": 0.15})


@query("stratified_balance", using("labelled") + f"""
SELECT ride_id, is_top FROM labelled JOIN (SELECT is_top AS c, least(1e0, min(n) OVER () * 1.2e0 / n) AS f
 FROM (SELECT is_top, count(*) AS n FROM labelled GROUP BY 1)) ON is_top = c
WHERE {uniform_sql(['ride_id'], 42)} < f""")
def _stratified_balance(spark, sf_dir):
    df = labelled_rides(spark, sf_dir).select("ride_id", "is_top")
    return sampling.stratified_balance(df, "is_top", ["ride_id"], max_imbalance=1.2)


@query("stratified_split", using("labelled") + f"""
SELECT ride_id, is_top, CASE WHEN row_number() OVER (PARTITION BY is_top ORDER BY u, ride_id)
 <= round(count(*) OVER (PARTITION BY is_top) * 0.2e0) THEN 'test' ELSE 'train' END AS dataset
FROM (SELECT ride_id, is_top, {uniform_sql(['ride_id'], 15)} AS u FROM labelled)""")
def _stratified_split(spark, sf_dir):
    """The split reads its input three times, so the labels are staged."""
    df = stage(labelled_rides(spark, sf_dir).select("ride_id", "is_top"))
    return sampling.stratified_split(df, "is_top", ["ride_id"], exact=True)


@query("stratified_split_hashed", using("labelled") + f"""
SELECT ride_id, is_top, CASE WHEN {uniform_sql(['ride_id'], 15)} < 0.2e0 THEN 'test' ELSE 'train' END AS dataset
FROM labelled""")
def _stratified_split_hashed(spark, sf_dir):
    df = labelled_rides(spark, sf_dir).select("ride_id", "is_top")
    return sampling.stratified_split(df, "is_top", ["ride_id"])
