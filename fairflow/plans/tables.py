"""Scans, sinks, projections and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.stats import ratio
from ..operators import demographics, models
from ..session import scratch_path
from ..sources import ingest
from ..sources.catalog import Catalog
from ..sources.fixtures import source
from ..sources.scores import ScoreStore
from .registry import query, r, rounded, using

PART = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType()),
])


def _tables(spark, sf_dir) -> Catalog:
    return Catalog(spark, sf_dir, suffix=".parquet")


def _scratch(spark) -> Catalog:
    return Catalog(spark, scratch_path(spark, "tables"))


@query("scan_table", "SELECT * FROM orders")
def _scan_table(spark, sf_dir):
    return _tables(spark, sf_dir).table("orders")


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _csv_roundtrip(spark, sf_dir):
    """The files carry a leading index column, which the import drops."""
    path = scratch_path(spark, "csv")
    indexed = source(spark, sf_dir, "part").select(F.col("p_partkey").alias("_c0"), *PART.names)
    indexed.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("_c0", T.LongType()), *PART.fields])
    return ingest.read_csv(spark, path, schema, text=["p_name"])


@query("normalise_columns", """
SELECT c_custkey AS custkey, c_name AS mtfcc, c_nationkey AS zip, c_acctbal AS aland FROM customer""")
def _normalise_columns(spark, sf_dir):
    raw = source(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CUSTKEY"), F.col("c_name").alias("MTFCC20"),
        F.col("c_nationkey").alias("ZCTA5CE20"), F.col("c_acctbal").alias("ALAND20"),
    )
    return ingest.normalise_columns(raw, {"ZCTA5CE20": "zip"})


@query("import_shapes", using("zones") + """
SELECT CAST(zone_id AS VARCHAR) AS zip, zone AS name, the_geom, n_regionkey, n_name
FROM zones LEFT JOIN nation ON zone_id = n_nationkey""")
def _import_shapes(spark, sf_dir):
    """Shapes written as CSV come back as a table with attributes by key."""
    path = scratch_path(spark, "shapes")
    source(spark, sf_dir, "zones").select(
        F.col("zone_id").alias("_c0"), F.col("zone_id").alias("ZCTA5CE20"), F.col("zone").alias("NAME20"), "the_geom"
    ).write.option("header", True).csv(path)
    return ingest.import_shapes(
        _scratch(spark), "shapes", path, "the_geom", "_c0 int, ZCTA5CE20 string, NAME20 string, the_geom string",
        "ZCTA5CE20", source(spark, sf_dir, "nation"), "n_nationkey",
        ["n_regionkey", "n_name"],
    )


@query("overwrite_roundtrip", "SELECT s_suppkey, s_name, s_acctbal * 2 AS doubled FROM supplier")
def _overwrite_roundtrip(spark, sf_dir):
    """The second write replaces rows and schema of the first."""
    catalog, supplier = _scratch(spark), source(spark, sf_dir, "supplier")
    catalog.overwrite(supplier, "supplier")
    changed = supplier.select("s_suppkey", "s_name", (F.col("s_acctbal") * 2).alias("doubled"))
    return catalog.overwrite(changed, "supplier")


@query("get_or_create", """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _get_or_create(spark, sf_dir):
    """Built by the first call, read by the second, whose builder must not run."""
    catalog = _scratch(spark)

    def build():
        customer, nation = source(spark, sf_dir, "customer"), source(spark, sf_dir, "nation")
        joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))

    def fail():
        raise AssertionError("the table exists")

    catalog.get_or_create("customers", build)
    return catalog.get_or_create("customers", fail)


@query("inline_dimension", """
SELECT o_orderpriority, urgency, count(*) AS orders FROM orders
JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) d(p, urgency)
 ON o_orderpriority = p GROUP BY ALL""")
def _inline_dimension(spark, sf_dir):
    rows = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]
    dim = ingest.inline_dimension(spark, rows, "o_orderpriority string, urgency int")
    counted = source(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(dim, "o_orderpriority")


@query("feature_set_projection", using("persons") + """
SELECT person_id, gndr, hshld_incme_grp, gnrt, edctn, ethnc_grp FROM persons""")
def _feature_set_projection(spark, sf_dir):
    return ingest.feature_set(source(spark, sf_dir, "persons"), private=("zone", "borough", "longitude", "latitude"))


@query("preview_limit", "SELECT * FROM events ORDER BY ts, event_id LIMIT 50")
def _preview_limit(spark, sf_dir):
    return source(spark, sf_dir, "events").orderBy("ts", "event_id").limit(50)


@query("dim_filter", using("persons") + """
SELECT person_id, zone, gnrt FROM persons WHERE borough = 'ASIA' AND gnrt = 'GenX'""")
def _dim_filter(spark, sf_dir):
    persons = source(spark, sf_dir, "persons")
    return persons.filter((F.col("borough") == "ASIA") & (F.col("gnrt") == "GenX")).select(
        "person_id", "zone", "gnrt"
    )


@query("bbox_distinct", using("persons") + """
SELECT DISTINCT zone FROM persons WHERE longitude > 20 AND longitude < 60 AND latitude < 41.1""")
def _bbox_distinct(spark, sf_dir):
    return demographics.bbox_distinct(
        source(spark, sf_dir, "persons"), "zone", "longitude", "latitude", (20.0, 60.0), 41.1
    )


@query("fill_nulls", using("rides") + """
SELECT ride_id, coalesce(fare_amount, -9999) AS fare_amount, coalesce(pickup_longitude, 0) AS pickup_longitude,
 coalesce(total_amount, 0) AS total_amount FROM rides""")
def _fill_nulls(spark, sf_dir):
    df = source(spark, sf_dir, "rides").select("ride_id", "fare_amount", "pickup_longitude", "total_amount")
    return models.fill_nulls(df, {"fare_amount": -9999.0}, 0)


@query("union_all", """
SELECT 'customer' AS origin, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def _union_all(spark, sf_dir):
    def part(name, prefix):
        return source(spark, sf_dir, name).select(
            F.lit(name).alias("origin"), F.col(f"{prefix}_nationkey").alias("nationkey"),
            F.col(f"{prefix}_acctbal").alias("acctbal"),
        )
    return reduce(DataFrame.unionByName, [part("customer", "c"), part("supplier", "s")])


@query("align_columns", """
SELECT c_custkey AS id, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier""")
def _align_columns(spark, sf_dir):
    customer = source(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_mktsegment AS segment", "c_nationkey AS nationkey", "c_acctbal AS acctbal")
    supplier = source(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS acctbal", "s_nationkey AS nationkey", "s_suppkey AS id", "s_name AS name")
    a, b = ingest.align_columns(customer, supplier)
    return a.unionByName(b)


@query("dimension_lookup", """
SELECT s_suppkey, s_nationkey, n_name, n_regionkey FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey""")
def _dimension_lookup(spark, sf_dir):
    dim = source(spark, sf_dir, "nation")
    suppliers = source(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return ingest.dimension_lookup(suppliers, dim, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])


@query("enrich_custom", """
SELECT o_orderkey, o_totalprice, c_mktsegment, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey""")
def _enrich_custom(spark, sf_dir):
    orders, customer = source(spark, sf_dir, "orders"), source(spark, sf_dir, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        "o_orderkey", "o_totalprice", "c_mktsegment", "c_acctbal"
    )


@query("json_map_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events""")
def _json_map_extract(spark, sf_dir):
    events = source(spark, sf_dir, "events").select("event_id", "props")
    return ingest.json_map_extract(events, "props", ["k", "absent"])


PROFILED = ("gndr", "hshld_incme_grp", "gnrt", "edctn", "ethnc_grp")


@query("category_profile", using("persons") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM persons WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in PROFILED))
def _category_profile(spark, sf_dir):
    return demographics.category_profile(
        source(spark, sf_dir, "persons"), PROFILED
    )


@query("score_reattach", using("rides") + f"""
SELECT ride_id, pickup_datetime, {r('trip_distance / 25', 8, 'score')} FROM rides""")
def _score_reattach(spark, sf_dir):
    """Scores computed by one job are stored by the row's own id, not a generated one, and come back in another."""
    rides = source(spark, sf_dir, "rides")
    store = ScoreStore.write(rides.select("ride_id", ratio(F.col("trip_distance"), F.lit(25.0)).alias("score")), "ride_id")
    return rounded(store.attach(rides.select("ride_id", "pickup_datetime")), score=8)
