"""Expressions against the standard library and hand-computed values."""

import datetime as dt
import hashlib
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from fairflow.functions import calendar, hashing, stats, text

NORMAL = NormalDist()


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_normal_cdf(spark):
    xs = [-40.0, -9.0, -7.5, -3.0, -0.5, 0.0, 1e-9, 0.5, 3.0, 7.5, 9.0, 40.0]
    got = values(spark, [(x,) for x in xs], "x double", stats.normal_cdf(F.col("x")))
    assert got == pytest.approx([NORMAL.cdf(x) for x in xs], abs=1e-15)
    assert values(spark, [(None,)], "x double", stats.normal_cdf(F.col("x"))) == [None]


def test_normal_ppf(spark):
    ps = [0.0005, 0.001, 0.02424, 0.02426, 0.3, 0.5, 0.9, 0.97574, 0.97576, 0.9999]
    got = values(spark, [(p,) for p in ps], "p double", stats.normal_ppf(F.col("p")))
    assert got == pytest.approx([NORMAL.inv_cdf(p) for p in ps], abs=1e-8)
    outside = values(spark, [(0.0,), (1.0,), (-1.0,), (None,)], "p double", stats.normal_ppf(F.col("p")))
    assert outside == [None] * 4


def test_delta_zscore_clips_and_keeps_null(spark):
    rows = [(1.0, 0.0), (0.0, 1.0), (9.0, -9.0), (None, 1.0), (1.0, None)]
    df = stats.delta_zscore(spark.createDataFrame(rows, "a double, b double"), "a", "b", "d")
    got = [r["d"] for r in df.collect()]
    assert df.columns == ["a", "b", "d"]
    assert got[0] == pytest.approx(NORMAL.inv_cdf(NORMAL.cdf(1) - 0.5), abs=1e-7)
    assert got[1] == pytest.approx(NORMAL.inv_cdf(0.001), abs=1e-7)
    assert got[2] == pytest.approx(NORMAL.inv_cdf(0.9999), abs=1e-7)
    assert got[3:] == [None, None]


def test_zscore_of_a_constant_is_null(spark):
    z = stats.zscore(F.col("x"), F.col("m"), F.col("s"))
    assert values(spark, [(2.0, 2.0, 0.0), (2.0, 1.0, None), (3.0, 1.0, 2.0)], "x double, m double, s double", z) \
        == [None, None, 1.0]


def test_quantile_band(spark):
    zs = [(0.7,), (0.67448,), (0.1,), (0.0,), (-0.5,), (-0.7,), (None,)]
    assert values(spark, zs, "z double", stats.quantile_band(F.col("z"))) == [1, 1, 2, 2, 3, 4, 4]
    assert values(spark, zs, "z double", stats.quantile_band(F.col("z"), "strict")) == [1, 1, 1, 1, 4, 4, 4]


def test_uniform_matches_md5_and_ignores_partitioning(spark):
    df = spark.range(2000).select("id", hashing.uniform(["id"], 7).alias("u"))
    got = {r["id"]: r["u"] for r in df.collect()}
    assert got[42] == int(hashlib.md5(b"42:7").hexdigest()[:8], 16) / 2**32
    again = {r["id"]: r["u"] for r in spark.range(2000).repartition(17).select(
        "id", hashing.uniform(["id"], 7).alias("u")).collect()}
    assert got == again
    assert abs(sum(got.values()) / len(got) - 0.5) < 0.03


def test_fast_uniform(spark):
    draw = hashing.uniform(["id"], 7, "xxhash64")
    got = sorted(r[0] for r in spark.range(4000).repartition(5).select(draw).collect())
    assert got == sorted(r[0] for r in spark.range(4000).select(draw).collect())
    assert 0 <= got[0] and got[-1] < 1 and len(set(got)) == 4000
    assert max(abs(u - i / 4000) for i, u in enumerate(got)) < 0.03
    with pytest.raises(ValueError):
        hashing.uniform(["id"], 7, "crc32")


def test_daypart_and_weekpart(spark):
    hours = [(h,) for h in range(24)]
    got = values(spark, hours, "h int", calendar.daypart(F.col("h")))
    assert got == (["twilight"] * 5 + ["morning"] * 5 + ["lunch"] * 5 + ["afternoon"] * 3
                   + ["night"] * 5 + ["twilight"])
    rows = [(1, "lunch"), (7, "lunch"), (6, "night"), (6, "lunch"), (3, "night")]
    part = lambda mode: values(spark, rows, "d int, p string", calendar.weekpart(F.col("d"), F.col("p"), mode))
    assert part("intended") == ["weekend", "weekend", "weekend", "weekday", "weekday"]
    assert part("strict") == ["weekday", "weekday", "weekend", "weekday", "weekday"]


def test_time_range():
    assert calendar.time_range("last_month", dt.datetime(2024, 1, 20)) == (
        dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))
    assert calendar.time_range("last_year", dt.datetime(2024, 5, 3)) == (
        dt.datetime(2023, 1, 1), dt.datetime(2023, 12, 31))
    with pytest.raises(ValueError):
        calendar.time_range("yesterday", dt.datetime(2024, 1, 1))


def test_slug(spark):
    rows = [("income", "<$50K"), ("income", "$50K"), ("income", "$50K-$149K"), ("x__y", "a  b"), ("f", None)]
    got = values(spark, rows, "f string, v string", text.slug(F.col("f"), F.col("v")))
    assert got == ["income_50K", "income_50K", "income_50K_149K", "x_y_a_b", None]


def test_day_of_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t")
        assert df.select(calendar.day_of(F.col("t"))).first()[0] == dt.datetime(2024, 3, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unlog10_inverts_log10(spark):
    got = values(spark, [(3.0,), (0.0,)], "x double", stats.unlog10(F.col("x")))
    assert got == [1000.0, 1.0] and math.isclose(got[0], 1000.0)
