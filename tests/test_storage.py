"""What is written: replaced tables, staged folders, measured sides, scores and runs."""

import datetime as dt
import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fairflow.operators import demographics as demo, fairness, metrics, models, registry, rides
from fairflow.session import (
    join_checked, may_match, reused, scratch_path, ship_package, size_checked, split_matches, stage, staging_scope,
)
from fairflow.sources import versions
from fairflow.sources.catalog import Catalog
from fairflow.sources.scores import ScoreStore


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- replaced tables ---------------------------------------------------------------------

def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path):
    def fails_late(v):
        if v > 700:
            raise RuntimeError("lost half way")
        return v

    catalog = Catalog(spark, str(tmp_path))
    catalog.overwrite(spark.range(10), "t")
    with pytest.raises(PySparkException, match="lost half way"):
        catalog.overwrite(spark.range(0, 1000, 1, 8).select(F.udf(fails_late, "long")("id").alias("id")), "t")
    assert ids(catalog.table("t")) == list(range(10))
    assert not list(Path(tmp_path, "t", "_versions").glob("[!.]*"))
    with pytest.raises(PySparkException, match="lost half way"):
        catalog.overwrite(spark.range(1000).select(F.udf(fails_late, "long")("id").alias("id")), "u")
    assert not catalog.exists("u") and not Path(tmp_path, "u").exists()


def test_a_table_is_replaced_from_itself_and_old_versions_go(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    catalog.overwrite(spark.range(10), "t")
    reader = catalog.table("t")
    for turn in range(3):
        changed = catalog.overwrite(catalog.table("t").select((F.col("id") + 1).alias("id"), F.lit(turn).alias("turn")), "t")
        if turn == 0:  # a reader that resolved the version before goes on
            assert ids(reader) == list(range(10))
    assert ids(changed) == list(range(3, 13)) and changed.columns == ["id", "turn"]
    assert len([p for p in Path(tmp_path, "t", "_versions").iterdir() if p.is_dir()]) == 2


def test_a_plain_folder_becomes_versioned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    catalog = Catalog(spark, str(tmp_path))
    assert catalog.exists("t") and not catalog.exists("u") and catalog.location("t") == path
    catalog.overwrite(catalog.table("t").filter("id > 2"), "t")
    assert ids(catalog.table("t")) == [3, 4] and ids(spark.read.parquet(path)) == list(range(5))
    catalog.append(spark.range(7, 8), "t")
    assert ids(catalog.table("t")) == [3, 4, 7]
    catalog.overwrite(spark.range(1).withColumn("p", F.lit(3)), "t", ["p"])
    assert ids(catalog.table("t")) == [0] and not list(Path(path).glob("*.parquet"))


def test_tables_of_other_formats_and_partitions(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), fmt="orc")
    catalog.overwrite(spark.range(20).withColumn("p", F.col("id") % 3), "t", ["p"])
    assert "p=1" in [p.name for p in Path(catalog.location("t")).iterdir()] and ids(catalog.table("t")) == list(range(20))


def test_files_added_at_the_same_time(spark, tmp_path):
    path, errors = str(tmp_path / "runs"), []

    def add(k):
        try:
            versions.add_file(spark.range(k, k + 1), path, f"run-{k}")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and ids(spark.read.parquet(path)) == list(range(6))
    with pytest.raises(FileExistsError):
        versions.add_file(spark.range(1), path, "run-3")
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == []


# --- staged folders ----------------------------------------------------------------------

def folders(scope):
    return [p for p in scope.paths if Path(p.removeprefix("file:")).exists()]


def test_a_scope_drops_what_a_later_step_replaced(spark):
    with staging_scope(spark) as outer:
        with staging_scope(spark) as scope:
            first = stage(spark.range(10))
            other = stage(spark.range(3).agg(F.max("id").alias("top")))
            second = stage(first.filter(F.col("id") > other.scalar()))
            assert len(folders(scope)) == 3
            scope.drop(first.filter(F.col("id") > other.scalar()))  # what a subquery reads stays too
            assert len(folders(scope)) == 2 and ids(first.filter(F.col("id") > other.scalar())) == list(range(3, 10))
            third = stage(first.limit(5))
            scope.drop(third)
            assert len(folders(scope)) == 1 and third.count() == 5
        assert outer.paths and folders(outer) == outer.paths
    with pytest.raises(ValueError):
        with staging_scope(spark) as scope:
            stage(spark.range(1))
            raise ValueError
    assert not folders(scope)


def test_after_the_debiased_outcomes_only_their_inputs_are_on_disk(spark, sf_dir):
    from fairflow.plans.debias import debiased_outcomes

    with staging_scope(spark) as scope:
        result = debiased_outcomes(spark, sf_dir)
        left, rows = folders(scope), result.count()
        assert rows and 0 < len(left) <= 4  # the scored rows, and per factor the weights joined to them
        scope.drop(result)
        assert folders(scope) == left and result.count() == rows
        scope.drop()
        assert not folders(scope)


def test_a_reused_result_is_computed_once_and_released(spark):
    hits = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        hits.add(1)
        return v

    with reused(spark.range(10).select(counted("id").alias("id"))) as kept:
        assert kept.count() == 10 and ids(kept) == list(range(10)) and kept.storageLevel.useMemory
        assert hits.value == 10
    assert not kept.storageLevel.useMemory


# --- measured sides ----------------------------------------------------------------------

@pytest.fixture()
def jobs(spark):
    """How many jobs a call starts."""
    def count(run):
        tracker, group = spark.sparkContext.statusTracker(), f"g{id(run)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))
    return count


def test_measuring_starts_no_job_of_its_own(spark, jobs):
    dim = spark.range(50).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert jobs(lambda: size_checked(dim)) == jobs(lambda: stage(dim)) == 1


def test_repeated_values_are_measured_at_full_size(spark):
    wide = spark.range(1000).withColumn("t", F.repeat(F.lit("x"), 1000))
    joined = spark.range(10).join(size_checked(wide, max_bytes=500_000), "id")
    assert "SortMergeJoin" in plan_of(joined) and joined.count() == 10
    assert "BroadcastHashJoin" in plan_of(spark.range(10).join(size_checked(wide, max_bytes=1_500_000), "id"))


@pytest.mark.parametrize("bits", [1 << 10, 1 << 26])
def test_rows_that_cannot_match_go_before_the_shuffle(spark, bits):
    big = spark.range(5000).select("id", (F.col("id") % 997).alias("k"), F.lit("a").alias("g")).unionByName(
        spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(None).cast("long").alias("k"), F.lit("a").alias("g")))
    side = spark.range(0, 200, 2).select(F.col("id").alias("k"), F.lit("a").alias("g"))
    kept = may_match(big, side, ["k", "g"], bits)
    assert kept.columns == big.columns and kept.join(side, ["k", "g"]).count() == big.join(side, ["k", "g"]).count()
    assert kept.count() < 5000 * (0.25 if bits < 1 << 20 else 0.13) and kept.filter("k IS NULL").count() == 0


def test_rows_split_by_what_may_match(spark):
    big = spark.range(3000).select("id", F.struct((F.col("id") % 50).alias("a")).alias("k"))
    side = spark.range(5).select(F.struct(F.col("id").alias("a")).alias("k"))
    some, none = split_matches(big, side, ["k"], 1 << 20)
    assert some.count() == 300 and none.count() == 2700 and none.join(side, "k").count() == 0
    some, none = split_matches(big, side.limit(0), ["k"])
    assert some.count() == 0 and none.count() == 3000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_on_both_sides_of_the_bound(spark, how):
    big = spark.range(300).select("id", (F.col("id") % 40).alias("k"))
    side = spark.range(0, 60, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small, large = (join_checked(big, side, ["k"], how, max_rows=m) for m in (20, 19))
    assert "BroadcastHashJoin" in plan_of(small) and "SortMergeJoin" in plan_of(large)
    assert ("bitmap" in plan_of(large)) == (how == "inner")
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def test_bounds_of_the_operators(spark):
    trips = spark.range(100).select("id", (F.col("id") % 5).alias("pickup_zone"), F.lit("am").alias("pickup_daypart"),
                                    F.lit(1).alias("pickup_datebin"))
    daily = trips.select("pickup_zone", "pickup_daypart", "pickup_datebin").distinct().withColumn("volume", F.lit(3)).withColumn("x", F.lit(4))
    keys = ["pickup_zone", "pickup_daypart", "pickup_datebin"]
    weights = spark.createDataFrame([(z, "f", 1, 0.5) for z in range(4)], "zone long, factor string, needs_mitigation int, sample_weight double")
    mapping = spark.createDataFrame([(0, 9, 1.0), (1, 8, 1.0)], "k int, new_k int, prob double")
    for rows, join in ((1000, "BroadcastHashJoin"), (1, "SortMergeJoin")):
        labelled = rides.label_joinback(trips, daily, keys, ["volume"], max_rows=rows)
        assert join in plan_of(labelled) and labelled.columns[-1] == "volume" and labelled.filter("volume = 3").count() == 100
        marked = demo.attach_weights(trips, weights, "f", "pickup_zone", max_rows=rows)
        assert join in plan_of(marked) and marked.count() == 80
        moved = fairness.apply_random_mapping(trips.select("id", (F.col("id") % 3).cast("int").alias("k")), mapping, ["k"], ["k"], ["id"], max_rows=rows)
        assert join in plan_of(moved) and ids(moved.select("k").distinct(), "k") == [2, 8, 9]


# --- scores and runs ---------------------------------------------------------------------

def test_scores_come_back_without_moving(spark, tmp_path):
    people = spark.range(500).select(F.col("id").alias("person"), (F.col("id") % 7).alias("v"))
    path = str(tmp_path / "scores")
    store = ScoreStore.write(people.select("person", (F.col("v") / 7).alias("score")), "person", 8, path)
    joined = store.attach(people.repartition(3))
    assert joined.count() == 500 and joined.filter("abs(score - v / 7) > 1e-12").count() == 0
    for found in (store, ScoreStore.open(spark, path, "person", 8)):
        plan = plan_of(found.attach(people))
        assert "SortMergeJoin" in plan
        scores = plan[plan.index("SortMergeJoin"):].split("\n")
        side = "\n".join(scores[max(n for n, line in enumerate(scores) if "Exchange" in line) + 1:])
        assert "Bucketed: true" in side or "SelectedBucketsCount" in plan
        assert plan.count("Exchange") == 1
        found.forget()


def test_runs_keep_their_predictions(spark, tmp_path):
    store = registry.RunStore(spark, str(tmp_path))

    def add(k):
        run = registry.run_record(spark, f"{k}e{k}", "m", {"auc": k / 10}, {"k": k}, dt.datetime(2024, 1, 1))
        rows = spark.range(k).select("id", F.when(F.col("id") % 2 == 0, "test").otherwise("train").alias("dataset"))
        store.add(run, rows)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(1, 6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    best = registry.require_model(store.runs(), "m")
    assert store.runs().count() == 5 and best["run_id"] == "5e5"  # never taken for a number
    assert ids(store.predictions("5e5")) == [0, 1, 2, 3, 4] and ids(store.predictions("5e5", "test")) == [0, 2, 4]
    assert "PartitionFilters: [isnotnull(dataset" in plan_of(store.predictions("5e5", "test"))


def test_figures_follow_from_the_stored_predictions(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") * 7919 % 100 / 100).alias("x")).withColumn("y", (F.col("x") + F.col("id") % 3 / 5 > 0.7).cast("int"))
    pipeline = models.feature_pipeline([], ["x"], "y", models.logistic("y"))
    store = registry.RunStore(spark, str(tmp_path))
    models.train_and_record(df.filter("id % 4 > 0"), df.filter("id % 4 = 0"), pipeline, "y", "m", store=store, keys=["id"])
    run = store.runs().first()
    test = store.predictions(run["run_id"], "test")
    assert test.count() == 100 and ids(test) == list(range(0, 400, 4))
    assert metrics.roc_auc(test, "y", "y_probability").first()["auc"] == pytest.approx(run["metrics"]["auc"])


def test_the_package_travels(spark):
    ship_package(spark)
    ship_package(spark)  # once a context

    def where(_):
        import fairflow
        yield fairflow.__name__

    assert spark.sparkContext.parallelize([1], 1).mapPartitions(where).collect() == ["fairflow"]
    assert any(f.endswith("fairflow.zip") for f in map(str, spark.sparkContext._python_includes))


def test_scratch_paths_are_below_the_shared_folder(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
