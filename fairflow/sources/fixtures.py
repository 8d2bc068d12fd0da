"""Ride, zone, person, score and run views over the given tables.

Each view is plain SQL that Spark and DuckDB evaluate to the same rows, so one text
serves the Spark queries and their SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_ADD = "timestampadd(SECOND, CAST(60+(event_id*7919)%5400 AS INT), ts)"
DUCK_ADD = "ts + to_seconds(60+(event_id*7919)%5400)"

SOURCES = {
    "zones": ("nation", "region"),
    "rides": ("events",),
    "persons": ("customer", "nation", "region"),
    "scored": ("lineitem",),
    "runs": ("supplier",),
}

VIEWS = {
    "zones": """
SELECT n.n_nationkey AS zone_id, n.n_name AS zone, r.r_name AS borough,
 concat('POLYGON ((',x0+1,' ',y0+1,', ',x0+19,' ',y0+2,', ',x0+18,' ',y0+15,', ',x0+2,' ',y0+14,', ',x0+1,' ',y0+1,')',
  CASE WHEN n_nationkey%6=0 THEN concat(', (',x0+8,' ',y0+6,', ',x0+12,' ',y0+6,', ',x0+12,' ',y0+10,', ',x0+8,' ',y0+10,', ',x0+8,' ',y0+6,')') ELSE '' END, ')') AS the_geom
FROM (SELECT *, 20*(n_nationkey%5) AS x0, 16*CAST(floor(n_nationkey/5) AS INT) AS y0 FROM {nation}) n
JOIN {region} r ON n.n_regionkey=r.r_regionkey""",
    "rides": """
SELECT event_id AS ride_id, ts AS pickup_datetime, {ADD} AS dropoff_datetime,
 CASE WHEN event_id%97=0 THEN NULL ELSE CAST((event_id*7919)%10000 AS DOUBLE)/100 END AS pickup_longitude,
 CASE WHEN event_id%97=0 THEN NULL ELSE CAST((event_id*104729)%8000 AS DOUBLE)/100 END AS pickup_latitude,
 CAST((event_id*15485863)%10000 AS DOUBLE)/100 AS dropoff_longitude,
 CAST((event_id*32452843)%8000 AS DOUBLE)/100 AS dropoff_latitude,
 concat('Z',user_id%5) AS pickup_zone, concat('Z',(event_id*13+user_id)%7) AS dropoff_zone,
 1+event_id%5 AS passenger_count, CAST((event_id*31)%250 AS DOUBLE)/10 AS trip_distance, fare_amount,
 CASE WHEN event_id%7=0 THEN CAST(5.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
 CAST(event_id%40 AS DOUBLE)/4 AS tip_amount, CAST(0.5 AS DOUBLE) AS mta_tax, CAST(event_id%3 AS DOUBLE)/2 AS extra,
 CASE WHEN event_id%11=0 THEN NULL WHEN event_id%13=0 THEN fare_amount-1
      ELSE fare_amount+1+CAST(event_id%40 AS DOUBLE)/4 END AS total_amount
FROM (SELECT *, CASE WHEN event_id%53=0 THEN NULL WHEN event_id%59=0 THEN -value ELSE value END AS fare_amount FROM {events}) e""",
    "persons": """
SELECT c_custkey AS person_id, n_name AS zone, r_name AS borough,
 CASE c_custkey%3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE NULL END AS gndr,
 CASE WHEN c_acctbal<0 THEN NULL WHEN c_acctbal<3000 THEN '<$50K' WHEN c_acctbal<6000 THEN '$50K-$149K' ELSE '$150K+' END AS hshld_incme_grp,
 CASE WHEN (c_custkey*7919)%100<45 THEN 'GenX' WHEN (c_custkey*7919)%100<80 THEN 'Millennials' ELSE 'Seniors' END AS gnrt,
 c_mktsegment AS edctn, concat('Group ',CAST(floor(sqrt(c_custkey%36)) AS INT)) AS ethnc_grp,
 CAST((c_custkey*104729)%10000 AS DOUBLE)/100 AS longitude, CAST((c_custkey*7919)%8000 AS DOUBLE)/100 AS latitude
FROM {customer} JOIN {nation} ON c_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey""",
    "scored": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
 l_linestatus AS needs_mitigation, concat('NATION_',l_suppkey%25) AS zone,
 l_quantity/100 + l_discount*5 AS score, l_tax+0.5 AS weight,
 CASE WHEN (l_orderkey*7919+l_linenumber*104729+l_partkey*31)%100
        < (l_quantity+l_discount*500)*CASE WHEN l_linestatus='O' THEN 0.7 ELSE 1.0 END THEN 1 ELSE 0 END AS label,
 l_extendedprice AS total_amount, l_returnflag
FROM {lineitem}""",
    "runs": """
SELECT concat('run-',s_suppkey) AS run_id, concat('model_',s_suppkey%3) AS model_name,
 CASE WHEN s_suppkey%4=0 AND s_suppkey%3<>2 THEN 1 ELSE 0 END AS production,
 0.5+CAST((s_suppkey*37)%50 AS DOUBLE)/100 AS auc, 0.5+CAST((s_suppkey*17)%50 AS DOUBLE)/100 AS accuracy,
 CAST((s_suppkey*29)%100 AS DOUBLE)/100 AS decision_threshold
FROM {supplier}""",
}

# The columns that together identify a row of ``scored``.
SCORED_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view over given tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    tables = {t: source(spark, sf_dir, t) for t in SOURCES[name]}
    return spark.sql(VIEWS[name].replace("{ADD}", SPARK_ADD), **tables)


def duck_view(name: str) -> str:
    """The same view as DuckDB text over the registered tables."""
    text = VIEWS[name].replace("{ADD}", DUCK_ADD)
    for table in SOURCES[name]:
        text = text.replace("{" + table + "}", table)
    return text.strip()
