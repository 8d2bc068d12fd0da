"""Edge cases with hand-computed results, and results that must not depend on partitioning."""

import datetime as dt
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fairflow.operators import demographics as demo, ranking, rides, sampling
from fairflow.session import build_session, size_checked, staging_root
from fairflow.sources import ingest
from fairflow.sources.catalog import Catalog


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- ranking -----------------------------------------------------------------------------

def skewed(spark, parts):
    """A group with nine tenths of the rows, a small one, and a NULL group; many equal values."""
    data = [("hot" if i % 10 else None if i % 20 else "cold", float(i % 7), i) for i in range(3000)]
    random.Random(parts).shuffle(data)
    return spark.createDataFrame(data, "g string, v double, id long").repartition(parts)


def expected_numbers(data):
    groups = {}
    for g, v, i in data:
        groups.setdefault(g, []).append((-v, i))
    return {i: n + 1 for members in groups.values() for n, (_, i) in enumerate(sorted(members))}


@pytest.mark.parametrize("parts", [1, 17])
def test_row_numbers_of_a_hot_group(spark, parts):
    df = skewed(spark, parts)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["row_number"] for r in ranking.row_numbers(df, order, ["g"]).collect()}
    assert got == expected_numbers([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("n", [1, 3, 10, 4000])
def test_ntile_equals_the_window_function(spark, n):
    df = skewed(spark, 5)
    from pyspark.sql import Window

    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranking.ntile_by(df, ["g"], order, n, "tile")
    want = df.withColumn("tile", F.ntile(n).over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got, "id", "tile") == rows(want, "id", "tile")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """The exchanges of rows in a plan, broadcasts and gatherings of one row a task left out."""
    return [x for x in plan_of(df).splitlines() if "Exchange " in x and "Broadcast" not in x and "SinglePartition" not in x]


def test_hot_group_is_spread_over_slices(spark):
    """No slice holds more than a fraction of a group with 90 % of all rows; rows move once."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = skewed(spark, 5)
        order = [F.col("v").desc(), F.col("id").asc()]
        sliced = ranking.sorted_slices(df, order, ["g"])
        assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] < 3000 * 0.3
        assert len(exchanges(sliced)) == 1
        numbered = ranking.row_numbers(df, order, ["g"])
        assert all("_rows" in x or "_slice" in x for x in exchanges(numbered))  # only the offsets
        assert {r["group_rows"] for r in numbered.filter("g = 'hot'").select("group_rows").distinct().collect()} == {2700}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_row_numbers_without_groups_and_empty(spark):
    df = spark.createDataFrame([(3, 10), (1, 5), (2, 7)], "k int, v int").repartition(3)
    assert rows(ranking.row_numbers(df, [F.col("k").asc()]), "k", "row_number", "group_rows") == [(1, 1, 3), (2, 2, 3), (3, 3, 3)]
    assert ranking.row_numbers(df.filter("k > 5"), [F.col("k").asc()]).count() == 0


def steps_of(df, descending=False, cells=8):
    got = ranking.step_totals(df, "k", {"v": F.sum("v"), "n": F.count(F.lit(1))}, descending, cells)
    return [tuple(r) for r in got.orderBy(F.col("k").desc() if descending else "k").collect()]


def wanted_steps(data, descending=False):
    held, out = {}, []
    for k, v in data:
        if k is not None:
            a, b = held.get(k + 0.0, (0, 0))
            held[k + 0.0] = a + v, b + 1
    total = sum(v for v, _ in held.values()), sum(n for _, n in held.values())
    before = (0, 0)
    for k in sorted(held, reverse=descending):
        out.append((k, *held[k], *before, *total))
        before = before[0] + held[k][0], before[1] + held[k][1]
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["spread", "hot", "few", "one", "none", "ends"])
def test_step_totals(spark, kind, descending):
    r = random.Random(3)
    data = {
        "spread": [(r.random(), i) for i in range(500)],
        "hot": [(0.25 if i % 3 else r.random(), i) for i in range(900)],
        "few": [(float(i % 5), i) for i in range(300)] + [(None, 1)],
        "one": [(-0.0 if i % 2 else 0.0, 1) for i in range(50)],
        "none": [(None, 1)],
        "ends": [(float("inf"), 1), (float("-inf"), 2), (0.5, 3), (float("inf"), 4), (1e-320, 5)] * 3,
    }[kind]
    for parts in (1, 7):
        df = spark.createDataFrame(data, "k double, v long").repartition(parts)
        assert steps_of(df, descending) == wanted_steps(data, descending)


def test_step_totals_of_whole_numbers_beyond_doubles(spark):
    base = 1 << 60
    data = [(base + i % 3, i) for i in range(200)]
    df = spark.createDataFrame(data, "k long, v long").repartition(3)
    assert [r[:3] for r in steps_of(df)] == [(base + m, sum(v for k, v in data if k == base + m), len([1 for k, _ in data if k == base + m]))
                                             for m in range(3)]
    assert [r[4] for r in steps_of(df)] == [0, 67, 134]


def test_curves_move_the_rows_once(spark):
    from fairflow.operators import metrics

    df = spark.range(4000).select((F.col("id") * 0.618033988749 % 1).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    for run in (metrics.roc_auc, metrics.pr_curve, metrics.roc_curve):
        moved = [x for x in exchanges(run(df, "label", "score")) if "REPARTITION_BY_COL" in x]
        assert len(moved) == 1
        # What else is exchanged are the frequent scores, combined in their tasks.
        assert len(exchanges(run(df, "label", "score"))) <= 2 and "rangepartitioning" not in plan_of(run(df, "label", "score"))


# --- sampling ----------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 17])
def test_samples_and_splits_do_not_depend_on_partitioning(spark, parts):
    base = spark.range(3000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    df = base.repartition(parts)
    for run in (
        lambda d: sampling.hash_sample(d, ["id"], 0.1),
        lambda d: sampling.random_split(d, ["id"], {"a": 0.6, "b": 0.2, "c": 0.2}),
        lambda d: sampling.stratified_balance(d, "y", ["id"], 2),
        lambda d: sampling.stratified_split(d, "y", ["id"]),
        lambda d: sampling.stratified_split(d, "y", ["id"], exact=True),
    ):
        assert sorted(map(tuple, run(df).collect())) == sorted(map(tuple, run(base.coalesce(1)).collect()))


def test_exact_stratified_split_meets_the_share(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 30, 1).otherwise(0).alias("y"))
    split = sampling.stratified_split(df, "y", ["id"], test=0.2, exact=True)
    assert rows(split.filter("dataset = 'test'").groupBy("y").count(), "y", "count") == [(0, 194), (1, 6)]


def test_exact_split_equals_a_full_ranking(spark):
    """A hot class, a tiny one, one too small for a test row, and rows without a class."""
    from pyspark.sql import Window
    from fairflow.functions.hashing import uniform

    label = F.when(F.col("id") < 2, "one").when(F.col("id") < 40, "few").when(F.col("id") < 300, None).otherwise("hot")
    df = spark.range(6000).select("id", label.alias("y")).repartition(11)
    ranked = Window.partitionBy("y").orderBy("u", "id")
    want = df.withColumn("u", uniform(["id"], 15)).withColumn("n", F.row_number().over(ranked)).withColumn(
        "dataset", F.when(F.col("n") <= F.round(F.count(F.lit(1)).over(Window.partitionBy("y")) * 0.2), "test")
        .otherwise("train"))
    got = sampling.stratified_split(df, "y", ["id"], test=0.2, exact=True)
    assert got.columns == ["id", "y", "dataset"]
    assert rows(got, "id", "dataset") == rows(want, "id", "dataset")


def test_balance_bounds_the_classes(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 100, 1).otherwise(0).alias("y"))
    kept = dict(rows(sampling.stratified_balance(df, "y", ["id"], 10).groupBy("y").count(), "y", "count"))
    assert kept[1] == 100 and abs(kept[0] - 1000) < 120


@pytest.mark.parametrize("days, expected", [
    (10, {"train": 6, "validate": 2, "test": 2}),
    (4, {"train": 2, "validate": 1, "test": 1}),
    (2, {"train": 1, "test": 1}),
    (1, {"test": 1}),
])
def test_date_split(spark, days, expected):
    """The second cut is clamped to the last day when there are few days."""
    df = spark.createDataFrame([(day(i),) for i in range(days)], "t timestamp_ntz")
    got = dict(rows(sampling.date_split(df, "t").groupBy("dataset").count(), "dataset", "count"))
    assert got == expected


def test_date_split_of_nothing(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert sampling.date_split(empty, "t").count() == 0


# --- rides -------------------------------------------------------------------------------

def test_ride_filter_keeps_both_bounds(spark):
    t0, t1 = day(0), day(5)
    data = [(t0, 0.0), (t1, 20000.0), (t0, -0.01), (t1, 20000.01), (day(-1), 5.0), (day(6), 5.0), (t0, None)]
    df = spark.createDataFrame(data, "pickup_datetime timestamp_ntz, fare_amount double")
    assert rides.ride_filter(df, t0, t1).count() == 2


def test_ride_filter_is_pushed_into_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(day(0), 1.0)], "pickup_datetime timestamp_ntz, fare_amount double")
    df.write.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = rides.ride_filter(spark.read.parquet(str(tmp_path / "r")))._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.rindex("PushedFilters"):]
    assert "GreaterThanOrEqual(pickup_datetime" in pushed and "LessThanOrEqual(fare_amount" in pushed


def test_crossfill_and_repair(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), (None, None), ("a", "b")], "p string, d string")
    assert [tuple(r) for r in rides.crossfill(df, "p", "d").collect()] == [
        ("a", "a"), ("b", "b"), (None, None), ("a", "b")]
    schema = "total_amount double, fare_amount double, tolls_amount double, tip_amount double," \
             " mta_tax double, extra double"
    data = [(10.0, 8.0, 1.0, 1.0, 1.0, 1.0), (7.0, 8.0, 1.0, 1.0, 1.0, 1.0), (None, 8.0, 1.0, 1.0, 1.0, 1.0),
            (None, 8.0, None, 1.0, 1.0, 1.0)]
    got = rides.repair_total(spark.createDataFrame(data, schema))
    assert [r["total_amount"] for r in got.collect()] == [10.0, 12.0, 12.0, None]


def test_trailing_frames_differ_where_days_are_missing(spark):
    data = [("z", day(0), 1), ("z", day(1), 3), ("z", day(40), 9), ("z", day(41), 5)]
    df = spark.createDataFrame(data, "zone string, d timestamp_ntz, volume int")

    def means(frame):
        got = rides.trailing_zscore(df, ["zone"], "d", frame=frame)
        return [r["vol_mean"] for r in got.orderBy("d").collect()]

    assert means("rows") == [None, 1.0, 2.0, pytest.approx(13 / 3)]
    assert means("days") == [None, 1.0, None, 9.0]
    first = rides.trailing_zscore(df, ["zone"], "d").orderBy("d").collect()
    assert first[0]["vol_zscore"] is None and first[1]["vol_zscore"] is None
    assert first[2]["vol_zscore"] == pytest.approx(7 / math.sqrt(2))


def test_two_ended_counts_keep_a_null_row(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a")], "p string, d string")
    got = rides.two_ended_counts(df, "p", "d").collect()
    assert {(r["zone"], r["count"]) for r in got} == {("a", 3), ("b", 1), (None, 0)}
    assert sum(r["count"] for r in got) == 4
    assert {r["zone"]: r["count_log10"] for r in got}[None] is None


def test_histogram_widths(spark):
    df = spark.createDataFrame([(179, 0.4, 5.5, 1), (180, 19.9, 79.9, 0), (-1, 20.0, 80.0, 0), (None, None, None, 1)],
                               "ride_duration long, trip_distance double, total_amount double, is_top int")
    got = rows(rides.label_histograms(df), "analysis", "metric", "is_top", "count")
    assert got == [("distance", 0.0, 1, 1), ("distance", 19.5, 0, 1), ("duration", 0.0, 1, 1),
                   ("duration", 3.0, 0, 1), ("fare", 5.0, 1, 1), ("fare", 79.0, 0, 1)]
    strict = rows(rides.label_histograms(df, mode="strict").filter("analysis = 'duration'"), "metric", "count")
    assert strict == [(24.0, 1), (27.0, 1)]


# --- demographics ------------------------------------------------------------------------

def people(spark):
    return spark.createDataFrame(
        [("z1", "F", "a"), ("z1", "F", None), ("z1", None, "b"), ("z2", "M", "<$50K"), ("z2", "M", "$50K")],
        "zone string, gndr string, inc string")


def test_factor_counts_keep_missing_values_with_zero(spark):
    got = demo.factor_counts(people(spark), ["zone"], ["gndr", "inc"])
    assert got.columns == ["zone", "value", "count", "factor"]
    found = {(r["zone"], r["factor"], r["value"]): r["count"] for r in got.collect()}
    assert found == {
        ("z1", "gndr", "F"): 2, ("z1", "gndr", None): 0, ("z2", "gndr", "M"): 2,
        ("z1", "inc", "a"): 1, ("z1", "inc", "b"): 1, ("z1", "inc", None): 0,
        ("z2", "inc", "<$50K"): 1, ("z2", "inc", "$50K"): 1,
    }


def test_zscore_of_single_and_constant_groups(spark):
    z = {(r["zone"], r["factor"], r["value"]): r["cnt_zscore"]
         for r in demo.factor_zscore(demo.factor_counts(people(spark), ["zone"], ["gndr", "inc"])).collect()}
    assert z[("z2", "gndr", "M")] is None            # one value
    assert z[("z2", "inc", "$50K")] is None          # equal counts
    assert z[("z1", "gndr", "F")] == pytest.approx(1 / math.sqrt(2))


def test_pivot_drops_the_null_column_and_merges_equal_slugs(spark):
    counts = demo.factor_counts(people(spark), ["zone"], ["gndr", "inc"])
    found = demo.zone_factor_pivot(counts, quantile=True)
    assert "null" not in found.columns
    assert set(found.columns) == {"zone", "gndr_F", "gndr_M", "inc_a", "inc_b", "inc_50K"}
    given = demo.zone_factor_pivot(counts, ["gndr_F", "inc_50K"])
    assert given.columns == ["zone", "gndr_F", "inc_50K"] and given.count() == 2


def test_pivot_and_long_form_agree(spark):
    scored = demo.factor_zscore(demo.factor_counts(people(spark), ["zone"], ["gndr"]))
    wide = demo.zone_factor_pivot(scored.select("zone", "factor", "value", "count"), ["gndr_F", "gndr_M"])
    back = wide.unpivot(["zone"], ["gndr_F", "gndr_M"], "slug", "z").filter("z IS NOT NULL")
    assert rows(back, "zone", "z") == rows(scored.filter("value IS NOT NULL AND cnt_zscore IS NOT NULL")
                                           .withColumn("z", F.col("cnt_zscore")), "zone", "z")


def test_deciles_give_null_scores_a_tile(spark):
    counts = spark.createDataFrame([(f"z{i}", "v", 5, "f") for i in range(7)] + [("z9", "v", 3, "f"), ("z9", "w", 9, "f")],
                                   "zone string, value string, count long, factor string")
    got = demo.disparity_deciles(counts, 3)
    assert got.count() == 9 and got.filter("overall_quantile IS NULL").count() == 0
    assert rows(got.filter("overall_quantile = 1"), "zone", "value") == [("z0", "v"), ("z9", "v"), ("z9", "w")]


def test_aux_weights(spark):
    deciles = spark.createDataFrame([("a", "f", 1, 0.0), ("a", "f", 4, -1.0), ("b", "f", 2, 3.0), ("c", "f", 1, None)],
                                    "zone string, factor string, overall_quantile int, cnt_zscore double")
    got = {r["zone"]: (r["needs_mitigation"], r["sample_weight"]) for r in demo.aux_weights(deciles).collect()}
    assert got == {"a": (1, 1.0), "b": (0, 0.5), "c": (1, 0.5)}


def test_top_factors_unlog_before_summing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.2), ("c", None)], "f string, x double")
    got = demo.top_factors(df, "f", "x", k=2, log10=True).collect()
    assert [r["f"] for r in got] == ["a", "b"] and got[0]["x"] == pytest.approx(math.log10(20))


def test_group_normalise_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    got = demo.group_normalise(df, "g", "x").collect()
    assert len(got) == 3
    assert sorted(r["x"] for r in got if r["g"] is None) == [pytest.approx(-1 / math.sqrt(2)), pytest.approx(1 / math.sqrt(2))]


# --- sources -----------------------------------------------------------------------------

def test_csv_rules(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(0, "07001", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "_c0 int, ZCTA5CE20 string, the_geom string") \
        .write.option("header", True).csv(path)
    got = ingest.read_csv(spark, path, "_c0 int, ZCTA5CE20 string, the_geom string")
    got = ingest.normalise_columns(got, {"ZCTA5CE20": "zip"})
    assert got.columns == ["zip", "the_geom"] and got.first()["zip"] == "07001"
    inferred = ingest.read_csv(spark, path, text=["the_geom"])
    assert dict(inferred.dtypes)["the_geom"] == "string"


def test_normalised_names_must_not_collide(spark):
    with pytest.raises(ValueError, match="collide"):
        ingest.normalise_columns(spark.createDataFrame([(1, 2)], "A1 int, a2 int"))


def test_lookup_keeps_unknown_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    got = ingest.dimension_lookup(df, dim, {"k": "id"}, ["name"])
    assert got.columns == ["k", "name"]
    assert {tuple(r) for r in got.collect()} == {(1, "one"), (2, None), (None, None)}


def test_catalog(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    assert not catalog.exists("t")
    built = []

    def build():
        built.append(1)
        return spark.range(5).withColumn("part", F.col("id") % 2)

    assert catalog.get_or_create("t", build).count() == 5
    assert catalog.get_or_create("t", build).count() == 5 and built == [1]
    assert catalog.overwrite(spark.range(3).withColumn("other", F.lit("x")), "t").columns == ["id", "other"]
    assert catalog.append(spark.range(2).withColumn("other", F.lit("y")), "t").count() == 5
    assert catalog.table("t", ["other"]).columns == ["other"]
    split = catalog.overwrite(spark.range(4).withColumn("part", F.col("id") % 2), "p", partition_by=["part"])
    assert split.filter("part = 1").count() == 2


def test_catalog_of_another_format(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), {"moved": str(tmp_path / "elsewhere")}, fmt="orc")
    assert not catalog.exists("moved")
    assert catalog.overwrite(spark.range(7), "moved").count() == 7
    assert (tmp_path / "elsewhere").exists() and spark.read.orc(str(tmp_path / "elsewhere")).count() == 7


def test_projection_prunes_the_scan(spark, sf_dir):
    df = Catalog(spark, sf_dir, suffix=".parquet").table("lineitem", ["l_orderkey", "l_tax"])
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in df._jdf.queryExecution().toString()


def test_size_check_switches_the_join(spark):
    fact = spark.range(1000).withColumn("k", F.col("id") % 5)
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = fact.join(size_checked(dim), "k")
    large = fact.join(size_checked(dim, max_rows=4), "k")
    wide = fact.join(size_checked(dim, max_bytes=10), "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(small)
    assert "SortMergeJoin" in plan(large) and "SortMergeJoin" in plan(wide)
    assert rows(small, "id", "v") == rows(large, "id", "v") == rows(wide, "id", "v")


def test_staging_root_reads_the_session_setting(spark):
    assert staging_root(spark) == staging_root(build_session())


def test_inline_checks_fail_when_the_plan_runs(spark):
    from fairflow.operators import fairness

    df = spark.createDataFrame([(1, 0.5, "a"), (0, 0.5, "b"), (0, 0.2, "c")], "y int, s double, g string")
    with pytest.raises(PySparkException, match="expected 2 protected groups"):
        fairness.fair_fit(df, "y", "s", "g").collect()


def test_staged_tables_are_columnar_and_pruned(spark):
    from fairflow.session import stage

    df = spark.range(100).selectExpr("id", "id * 2 AS twice", "CASE WHEN id % 2 = 0 THEN 'a' END AS part")
    staged = stage(df, ["part"])
    assert staged.columns == df.columns and rows(staged, "id", "twice", "part") == rows(df, "id", "twice", "part")
    plan = staged.filter("part = 'a'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "PartitionFilters: [isnotnull(part" in plan
    assert "ExistingRDD" not in plan


def test_size_is_measured_without_gathering_rows(spark):
    df = spark.range(1000).repartition(4)
    checked = size_checked(df)
    assert checked.count() == 1000 and "ExistingRDD" not in checked._jdf.queryExecution().toString()
