"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, stats
from ..sources.fixtures import source
from .registry import cdf_sql, delta_sql, ppf_sql, query, r, rounded, uniform_sql

# Order totals spread over about -3.5 to 3.5 standard deviations.
Z = "(o_totalprice - 250000) / 70000"


def _orders(spark, sf_dir):
    z = (F.col("o_totalprice") - 250000) / 70000
    return source(spark, sf_dir, "orders").select("o_orderkey", z.alias("z"))


@query("normal_cdf", f"SELECT o_orderkey, {r(cdf_sql('z'), 9, 'percent')} FROM (SELECT o_orderkey, {Z} AS z FROM orders)")
def _normal_cdf(spark, sf_dir):
    df = _orders(spark, sf_dir).select("o_orderkey", stats.normal_cdf(F.col("z")).alias("percent"))
    return rounded(df, percent=9)


@query("normal_ppf", f"""
SELECT o_orderkey, {r(ppf_sql('u'), 8, 'z')} FROM (SELECT o_orderkey, {uniform_sql(['o_orderkey'], 3)} AS u FROM orders)""")
def _normal_ppf(spark, sf_dir):
    u = source(spark, sf_dir, "orders").select("o_orderkey", hashing.uniform(["o_orderkey"], 3).alias("u"))
    return rounded(u.select("o_orderkey", stats.normal_ppf(F.col("u")).alias("z")), z=8)


@query("delta_zscore", f"""
SELECT o_orderkey, {r(ppf_sql('p'), 6, 'delta_z')} FROM (SELECT o_orderkey, {delta_sql('z', 'z2')} AS p
 FROM (SELECT o_orderkey, {Z} AS z, (o_custkey % 61 - 30) / 10e0 AS z2 FROM orders))""")
def _delta_zscore(spark, sf_dir):
    z2 = (F.col("o_custkey") % 61 - 30) / 10
    df = source(spark, sf_dir, "orders").select(
        "o_orderkey", ((F.col("o_totalprice") - 250000) / 70000).alias("z"), z2.alias("z2")
    )
    delta = stats.delta_zscore(df, "z", "z2", "delta_z")
    return rounded(delta.select("o_orderkey", "delta_z"), delta_z=6)


@query("row_fingerprint", """
SELECT event_id, md5(concat_ws(':', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type)) AS fingerprint
FROM events""")
def _row_fingerprint(spark, sf_dir):
    return source(spark, sf_dir, "events").select(
        "event_id", hashing.fingerprint("event_id", "user_id", "event_type").alias("fingerprint")
    )
