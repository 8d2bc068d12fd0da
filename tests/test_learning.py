"""Metrics, thresholds, fairness adjustment, models and the runs table."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fairflow.operators import fairness as fair, metrics, models, registry
from fairflow.operators.threshold import TunedThreshold, TunedThresholdModel
from fairflow.session import spread
from fairflow.sources.catalog import Catalog
from fairflow.sources.ingest import align_columns

SCHEMA = "id long, y int, s double, g string, w double"


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(3)
    data = []
    for i in range(2000):
        g = "a" if rng.random() < 0.7 else "b"
        s = round(rng.random(), 2)
        data.append((i, int(rng.random() < s * (1.0 if g == "a" else 0.6)), s, g, round(rng.uniform(0.5, 2), 2)))
    return data, spark.createDataFrame(data, SCHEMA).repartition(7).cache()


def test_auc_and_its_mirror(spark, sample):
    data, df = sample
    pos = [s for _, y, s, _, _ in data if y]
    neg = [s for _, y, s, _, _ in data if not y]
    want = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    auc = metrics.roc_auc(df, "y", "s").first()["auc"]
    assert auc == pytest.approx(want)
    mirrored = metrics.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert mirrored == pytest.approx(1 - auc)


def test_curves_have_their_end_points(sample):
    data, df = sample
    roc = metrics.roc_curve(df, "y", "s").collect()
    assert len(roc) == len({s for _, _, s, _, _ in data}) + 1
    assert any(r["threshold"] is None and (r["fpr"], r["tpr"]) == (0, 0) for r in roc)
    lowest = min((r for r in roc if r["threshold"] is not None), key=lambda r: r["threshold"])
    assert (lowest["fpr"], lowest["tpr"]) == (1, 1)
    pr = metrics.pr_curve(df, "y", "s").collect()
    assert any(r["threshold"] is None and (r["precision"], r["recall"]) == (1, 0) for r in pr)


@pytest.mark.parametrize("mode", ["intended", "strict"])
def test_tuned_threshold_is_numpys_percentile(sample, mode):
    data, df = sample
    rate = np.mean([y for _, y, _, _, _ in data])
    ranked = [d[1] if mode == "strict" else d[2] for d in data]
    got = metrics.tuned_threshold(df, "y", "s", mode).first()
    assert got["event_rate"] == pytest.approx(rate * 100)
    assert got["threshold"] == pytest.approx(np.percentile(ranked, 100 - rate * 100))


def test_tuned_threshold_with_equal_labels(spark):
    ones = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert metrics.tuned_threshold(ones, "y", "s").first()["threshold"] == pytest.approx(0.2)
    zeros = spark.createDataFrame([(0, 0.2), (0, 0.9)], "y int, s double")
    assert metrics.tuned_threshold(zeros, "y", "s").first()["threshold"] == pytest.approx(0.9)


@pytest.mark.parametrize("strict", [True, False])
def test_sweep_equals_a_loop(sample, strict):
    data, df = sample
    grid = [0.0, 0.25, 0.5, 0.51, 0.99, 1.0]  # 0.25 and 0.5 are scores as well
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.threshold_sweep(
        df, "y", "s", grid, strict=strict).collect()}
    called = (lambda s, t: s > t) if strict else (lambda s, t: s >= t)
    assert got == {
        t: (sum(y for _, y, s, _, _ in data if called(s, t)),
            sum(1 - y for _, y, s, _, _ in data if called(s, t))) for t in grid
    }


def test_best_threshold_takes_the_first_maximum(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, s double")
    best = metrics.best_threshold(metrics.threshold_sweep(df, "y", "s", [0.2, 0.4, 0.6])).first()
    assert best["threshold"] == 0.2 and best["balanced_accuracy"] == 1


def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert got["1"]["recall"] == 0 and got["1"]["support"] == 0 and got["0"]["recall"] == 0.5
    assert got["accuracy"]["f1"] == 0.5 and got["weighted avg"]["precision"] == 1
    cells = metrics.confusion_matrix(df, "y", "p")
    assert cells.count() == 4 and cells.agg(F.sum("share")).first()[0] == 1


# --- fairness ----------------------------------------------------------------------------

def rates_by_hand(data, group, field=2):
    rows = [d for d in data if d[3] == group]
    neg, pos = [d for d in rows if not d[1]], [d for d in rows if d[1]]
    fpr = sum(d[4] * d[field] for d in neg) / sum(d[4] for d in neg)
    fnr = sum(d[4] * (1 - d[field]) for d in pos) / sum(d[4] for d in pos)
    return fpr, fnr, sum(d[4] for d in pos) / sum(d[4] for d in rows)


def test_generalised_rates(sample):
    data, df = sample
    got = {r["g"]: r for r in fair.group_rates(df, "g", "y", "s", weight="w").collect()}
    for group in "ab":
        fpr, fnr, base = rates_by_hand(data, group)
        assert got[group]["generalized_fpr"] == pytest.approx(fpr)
        assert got[group]["generalized_fnr"] == pytest.approx(fnr)
        assert got[group]["base_rate"] == pytest.approx(base)


def test_rates_without_negatives_or_positives_are_zero(spark):
    df = spark.createDataFrame([("p", 1, 0.4, 1), ("n", 0, 0.4, 0)], "g string, y int, s double, c int")
    got = {r["g"]: r for r in fair.group_rates(df, "g", "y", "s", "c").collect()}
    assert got["p"]["generalized_fpr"] == 0 and got["n"]["generalized_fnr"] == 0 and got["n"]["tpr"] == 0


def test_unprivileged_is_everyone_else(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("c", 0), (None, 0), (None, 0)], "g string, y int")
    assert fair.mean_difference(df, "g", "a", "y").first()[0] == pytest.approx(0.25 - 0.5)
    with pytest.raises(ValueError, match="unknown metrics"):
        fair.metric_difference(df, ["precision"], "g", "a", "y")


@pytest.mark.parametrize("constraint", fair.CONSTRAINTS)
def test_fit_and_smaller_gap(sample, constraint):
    data, df = sample
    fitted = {r["group"]: r for r in fair.fair_fit(df, "y", "s", "g", constraint, "w").collect()}
    cost, trivial = {}, {}
    for group in "ab":
        fpr, fnr, base = rates_by_hand(data, group)
        constant = [(*d[:2], base, *d[3:]) for d in data]
        tfpr, tfnr, _ = rates_by_hand(constant, group)
        pick = lambda f, n: {"fpr": f, "fnr": n, "weighted": f * (1 - base) + n * base}[constraint]
        cost[group], trivial[group] = pick(fpr, fnr), pick(tfpr, tfnr)
        assert fitted[group]["cost"] == pytest.approx(cost[group])
        assert fitted[group]["trivial_cost"] == pytest.approx(trivial[group])
    low, high = sorted("ab", key=cost.get)
    assert fitted[high]["mix_rate"] == 0
    want = (cost[high] - cost[low]) / (trivial[low] - cost[low])
    assert fitted[low]["mix_rate"] == pytest.approx(want)
    if 0 < want < 1:
        params = fair.fair_fit(df, "y", "s", "g", constraint, "w")
        adapted = fair.fair_adapt(df, params, "s", "g", ["id"])
        before = fair.fair_score(df, "y", "s", "g", constraint, "w").first()[0]
        after = fair.fair_score(adapted, "y", "adapted_prob", "g", constraint, "w").first()[0]
        assert after < before


def test_equal_costs_change_nothing(spark):
    data = [(i, i % 2, 0.3, g, 1.0) for i, g in enumerate("aabb")]
    df = spark.createDataFrame(data, SCHEMA)
    params = fair.fair_fit(df, "y", "s", "g")
    assert [r["mix_rate"] for r in params.collect()] == [0, 0]
    assert {r["adapted_prob"] for r in fair.fair_adapt(df, params, "s", "g", ["id"]).collect()} == {0.3}


@pytest.mark.parametrize("parts", [1, 17])
def test_adapting_does_not_depend_on_partitioning(sample, parts):
    _, df = sample
    params = fair.fair_fit(df, "y", "s", "g", weight="w")
    run = lambda d: sorted((r["id"], r["adapted_prob"]) for r in fair.fair_adapt(d, params, "s", "g", ["id"]).collect())
    assert run(df.repartition(parts)) == run(df)


def test_unseen_group_fails(spark, sample):
    _, df = sample
    params = fair.fair_fit(df, "y", "s", "g")
    with pytest.raises(PySparkException, match="not seen in the fit"):
        fair.fair_adapt(df.withColumn("g", F.lit("new")), params, "s", "g", ["id"]).collect()


def test_adapting_is_a_projection(sample):
    _, df = sample
    params = fair.fair_fit(df, "y", "s", "g")
    plan = fair.fair_adapt(df, params, "s", "g", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("scalar-subquery")[0].count("Join") == 0


def test_check_groups(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "g string, y int")
    with pytest.raises(ValueError, match="2 protected groups"):
        fair.check_groups(df, "g", "y")
    with pytest.raises(ValueError, match="missing columns"):
        fair.check_groups(df, "other", "y")
    with pytest.raises(ValueError, match="binary classification"):
        fair.check_groups(df.filter("y = 0"), "g", "y")
    fair.check_groups(df, "g", "y", binary=False)
    fair.check_groups(df.filter("g <> 'c'"), "g", "y")
    with pytest.raises(ValueError, match="positive label"):
        fair.check_groups(df.filter("g <> 'c'"), "g", "y", pos_label=7)


def test_random_mapping(spark):
    df = spark.range(4000).select("id", F.lit("d").alias("d"), F.lit(0).alias("y")).repartition(9)
    mapping = spark.createDataFrame([("d", 0, 1, 0.25), ("d", 0, 2, 0.5)], "d string, y int, new_y int, prob double")
    got = dict(r[:] for r in fair.apply_random_mapping(df, mapping, ["d", "y"], ["y"], ["id"]).groupBy("y").count().collect())
    assert sum(got.values()) == 4000
    assert abs(got[1] - 1000) < 120 and abs(got[2] - 2000) < 150 and abs(got[0] - 1000) < 120
    other = df.withColumn("d", F.lit(None).cast("string"))
    assert fair.apply_random_mapping(other, mapping, ["d", "y"], ["y"], ["id"]).filter("y = 0").count() == 4000


def test_align_columns(spark):
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    b = spark.createDataFrame([(9, 8)], "z int, x int")
    left, right = align_columns(a, b)
    assert left.columns == right.columns == ["x", "z"]
    with pytest.raises(ValueError):
        align_columns(a.select("x"), b.select("z"))


# --- models ------------------------------------------------------------------------------

def test_stage_fits_saves_and_loads(spark, sample, tmp_path):
    data, df = sample
    stage = TunedThreshold(inputCol="s", labelCol="y", predictionCol="p", outputCol="prob")
    stage.save(str(tmp_path / "stage"))
    assert TunedThreshold.load(str(tmp_path / "stage")).getInputCol() == "s"
    model = stage.fit(df)
    rate = np.mean([d[1] for d in data])
    assert model.getTunedThreshold() == pytest.approx(np.percentile([d[2] for d in data], 100 * (1 - rate)))
    called = model.transform(df).agg(F.avg("p")).first()[0]
    assert abs(called - rate) < 0.02
    model.save(str(tmp_path / "model"))
    loaded = TunedThresholdModel.load(str(tmp_path / "model"))
    assert loaded.getTunedThreshold() == model.getTunedThreshold() and loaded.getPredictionCol() == "p"
    strict = stage.copy().setMode("strict").fit(df)
    assert strict.getTunedThreshold() == pytest.approx(np.percentile([d[1] for d in data], 100 * (1 - rate)))


def test_fitting_needs_labels(spark):
    df = spark.createDataFrame([(None, 0.5)], "y int, s double")
    with pytest.raises(ValueError, match="labelled rows"):
        TunedThreshold(inputCol="s", labelCol="y", predictionCol="p", outputCol="prob").fit(df)


def test_train_record_and_reload(spark, sample, tmp_path):
    _, df = sample
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    categorical, numeric = models.split_features(df, ["s", "g", "w"])
    assert (categorical, numeric) == (["g"], ["s", "w"])
    forest = models.random_forest("y", 5, maxDepth=3)
    pipeline = models.feature_pipeline(categorical, numeric, "y", forest)
    model, run = models.train_and_record(train, test, pipeline, "y", "demo", {"numTrees": 5}, str(tmp_path))
    row = run.first()
    assert 0.5 < row["metrics"]["auc"] <= 1 and row["params"]["numTrees"] == "5" and row["production"] == 0
    loaded = PipelineModel.load(f"{tmp_path}/{row['run_id']}")
    score = lambda m: sorted((r["id"], r["y_probability"], r["y_predict"]) for r in m.transform(test).collect())
    assert score(loaded) == score(model)
    kept = models.score(test, model, ["id"], row["run_id"])
    assert kept.columns[-1] == "id" and "model_id" in kept.columns and "s" not in kept.columns
    assert registry.require_model(run, "demo")["run_id"] == row["run_id"]


def test_grid_search_is_skipped_for_one_fold(spark, sample):
    _, df = sample
    forest = models.random_forest("y", 3, maxDepth=2)
    pipeline = models.feature_pipeline([], ["s"], "y", forest)
    same, best, points, model = models.grid_search(pipeline, forest, df, {"numTrees": [2, 3]}, folds=1)
    assert same is pipeline and best == {} and points == [] and model is None
    tuned, best, points, model = models.grid_search(pipeline, forest, df, {"numTrees": [2, 3]}, folds=2)
    assert best["numTrees"] in (2, 3) and len(points) == 2
    assert tuned.getStages()[-2].getNumTrees() == model.stages[-2].getNumTrees == best["numTrees"]


def test_first_trees_of_a_forest_are_a_forest(spark, sample):
    """All trees give the model's own scores; fewer give the mean over those trees."""
    from pyspark.ml.functions import vector_to_array

    _, df = sample
    forest = models.random_forest("y", 7, maxDepth=3).copy()
    forest.setLeafCol("_leaf")
    model = models.feature_pipeline([], ["s", "w"], "y", forest).fit(df)
    trees = model.stages[1]
    chances = models.leaf_chances(trees, spark)
    assert len(chances) == 7 and all(0 <= p <= 1 for tree in chances for p in tree)
    scored = model.transform(df).withColumn("own", vector_to_array("y_prob_vect")[1])
    got = scored.select("id", "own", "features", *models.prefix_scores(scored, "_leaf", chances, [1, 3, 7])).collect()
    assert all(abs(r["own"] - r["_trees_7"]) < 1e-12 for r in got)
    for r in got[:20]:
        each = [t.predictProbability(r["features"])[1] for t in trees.trees]
        assert r["_trees_1"] == pytest.approx(each[0]) and r["_trees_3"] == pytest.approx(sum(each[:3]) / 3)


def test_grid_search_fits_one_forest_per_fold(spark, sample, monkeypatch):
    _, df = sample
    fits = []
    real = models.RandomForestClassifier._fit

    def counted(self, dataset):
        fits.append(self.getNumTrees())
        return real(self, dataset)

    monkeypatch.setattr(models.RandomForestClassifier, "_fit", counted)
    forest = models.random_forest("y", 3, maxDepth=2)
    search = models.grid_search(models.feature_pipeline([], ["s"], "y", forest), forest, df, {"maxDepth": [1, 3], "numTrees": [8, 2, 4]}, folds=3)
    assert sorted(fits[:-1]) == [8] * 6 and fits[-1] == search.best["numTrees"] and len(search.points) == 6
    assert {tuple(p) for p in search.points} == {("maxDepth", "numTrees", "auc")}


def test_forest_fits_use_every_core(spark, monkeypatch):
    """Narrow rows lie in one file, yet folds, winner and scores run in as many tasks as there are cores."""
    rows = spark.range(20000).select(
        "id", F.when((F.col("id") * 7919) % 101 < F.col("id") % 100, 1).otherwise(0).alias("y"), (F.col("id") % 100 / 100).alias("s"))
    fits, scores, cores = [], [], spark.sparkContext.defaultParallelism
    fit, prefix = models.RandomForestClassifier._fit, models.prefix_scores

    def counted(self, dataset):
        fits.append((dataset.rdd.getNumPartitions(), dataset.count()))
        return fit(self, dataset)

    def scored(rows, *rest):
        scores.append(rows.rdd.getNumPartitions())
        return prefix(rows, *rest)

    monkeypatch.setattr(models.RandomForestClassifier, "_fit", counted)
    monkeypatch.setattr(models, "prefix_scores", scored)
    forest = models.random_forest("y", 2, maxDepth=2)
    models.grid_search(models.feature_pipeline([], ["s"], "y", forest), forest, rows.coalesce(1), {"numTrees": [1, 2]}, folds=3)
    assert [n for n, _ in fits] == [min(cores, 13)] * 3 + [min(cores, 19)]
    assert sum(n for _, n in fits[:3]) == 40000 and fits[3][1] == 20000
    assert scores == [min(cores, 6)] * 3


def test_prefixes_are_scored_in_one_evaluation(spark, sample):
    _, df = sample
    leaves = df.select("id", array_to_vector(F.array(F.lit(1.0), F.lit(0.0), F.lit(2.0))).alias("_leaf"))
    chances = [[0.1, 0.9], [0.5], [0.2, 0.4, 0.8]]
    got = leaves.select(*models.prefix_scores(leaves, "_leaf", chances, [1, 2, 3]))
    assert got.distinct().collect() == [(0.9, (0.9 + 0.5) / 2, (0.9 + 0.5 + 0.8) / 3)]
    assert set(re.findall(r"pythonUDF\d+", got._jdf.queryExecution().executedPlan().toString())) == {"pythonUDF0"}


def test_rows_are_spread_by_number(spark):
    df = spark.range(1000).coalesce(1)
    parts = lambda rows: [len(p) for p in rows.rdd.glom().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert parts(spread(df)) == [1000] and parts(spread(df.limit(0))) == [0]
    assert len(parts(spread(df, few=10))) == min(cores, 100)
    many = parts(spread(df, few=10, many=25))
    assert len(many) == 40 and max(many) <= 50 and sum(many) == 1000


def test_grid_search_over_other_parameters(spark, sample):
    _, df = sample
    model = models.logistic("y", maxIter=5)
    search = models.grid_search(models.feature_pipeline([], ["s"], "y", model), model, df, {"regParam": [0.0, 10.0]}, folds=2)
    assert search.best["regParam"] in (0.0, 10.0) and search.model.stages[-1].getTunedThreshold() > 0


def test_vector_scores(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0]), (2, [0.0, 0.0], [1.0])], "id int, a array<double>, b array<double>")
    got = models.vector_udf_score(df, ["a", "b"], 3, lambda: lambda v: v @ np.array([1.0, 10.0, 100.0]))
    assert {r["id"]: r["score"] for r in got.collect()} == {1: 321.0, 2: 100.0}


def test_imputing_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 5), (3.0, 5)], "x double, c int")
    got = models.impute_with_indicators(df, ["x"]).collect()
    assert sorted((r["x"], r["x_missing"]) for r in got) == [(1.0, 0), (2.0, 1), (3.0, 0)]
    scaled = models.standardise(df, ["x", "c"]).collect()
    assert {r["c_scaled"] for r in scaled} == {None}


def test_runs_table_grows(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for i, auc in enumerate((0.6, 0.8)):
        run = registry.run_record(spark, f"r{i}", "m", {"auc": auc}, {"k": i}, dt.datetime(2024, 1, 1))
        runs = registry.record(catalog, run)
    assert runs.count() == 2 and registry.require_model(catalog.table("runs"), "m")["run_id"] == "r1"


def test_lookup_prefers_production_then_metric(spark):
    ts = dt.datetime(2024, 1, 1)
    record = lambda i, name, auc, production: registry.run_record(spark, i, name, {"auc": auc}, {}, ts, production)
    runs = record("r1", "m", 0.9, 0).unionAll(record("r2", "m", 0.7, 1)).unionAll(record("r3", "m", 0.8, 1)) \
        .unionAll(record("r4", "n", 0.6, 0)).unionAll(record("r5", "n", 0.65, 0))
    assert registry.require_model(runs, "m")["run_id"] == "r3"
    assert registry.require_model(runs, "n")["run_id"] == "r5"
    assert registry.require_model(runs)["run_id"] == "r3"
    with pytest.raises(LookupError):
        registry.require_model(runs, "missing")
    best = registry.model_compare(runs, ["m", "n"], metrics=["auc"])
    assert {r["model_name"]: r["run_id"] for r in best.collect()} == {"m": "r3", "n": "r5"}


def test_unknown_labels_and_scores_count_in_no_rate(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("a", 0, None), ("a", 1, 0.9), ("a", None, 0.1), ("b", 1, 0.2)],
                               "g string, y int, s double")
    got = {r.g: r for r in fair.group_rates(df, "g", "y", score="s").collect()}
    assert (got["a"].generalized_fpr, got["a"].rows) == (0.5, 4)
    assert abs(got["a"].generalized_fnr - 0.1) < 1e-12 and got["a"].base_rate == 0.5
    assert metrics.roc_auc(df, "y", "s").first().auc == 0.5


@pytest.mark.parametrize("groups", [1, 3])
def test_other_numbers_of_groups_fail(spark, groups):
    df = spark.createDataFrame([(f"g{k % groups}", k % 2, 0.3) for k in range(12)], "g string, y int, s double")
    with pytest.raises(Exception, match="expected 2 protected groups"):
        fair.fair_score(df, "y", "s", "g").collect()
    params = df.groupBy(F.col("g").alias("group")).agg(F.lit(0.5).alias("base_rate"), F.lit(0.1).alias("mix_rate"))
    with pytest.raises(Exception, match="expected 2 fitted groups"):
        fair.fair_adapt(df, params, "s", "g", ["y"]).collect()


def test_several_protected_columns_and_positive_label(spark):
    rows = [("a", k % 2, "yes" if k % 3 else "no", k / 12) for k in range(12)]
    df = spark.createDataFrame(rows, "g string, h int, y string, s double")
    one = df.withColumn("p", (F.col("g") == "a") & (F.col("h") == 1)).withColumn("z", (F.col("y") == "yes").cast("int"))
    both = fair.generalized_rate_gaps(df, ["g", "h"], ("a", 1), "y", "s", pos_label="yes").first()
    assert tuple(both) == tuple(fair.generalized_rate_gaps(one, "p", True, "z", "s").first())
    fit = fair.fair_fit(df, "y", "s", ["g", "h"], priv=("a", 1), pos_label="yes")
    assert {r.group for r in fit.collect()} == {True, False}
    adapted = fair.fair_adapt(df, fit, "s", ["g", "h"], ["s"], priv=("a", 1))
    assert adapted.columns == [*df.columns, "adapted_prob"] and adapted.count() == 12
    with pytest.raises(ValueError, match="values"):
        fair.is_privileged(["g", "h"], ("a",))
