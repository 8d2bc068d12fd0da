"""Forests grown from packed bins: against brute force, Spark's own trees, and what Spark refuses."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier as SparkForest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fairflow.operators import forests, models


@pytest.fixture(scope="module")
def rows(spark):
    """A label that depends on a number and on a category; another number says nothing."""
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10000)) / 10000
    df = spark.range(6000).select("id", F.round(u(1), 3).alias("a"), F.round(u(2), 1).alias("b"),
                                  F.concat(F.lit("c"), F.floor(u(3) * 6).cast("string")).alias("c"), u(4).alias("_u"))
    chance = 0.1 + 0.5 * F.col("a") + F.when(F.col("c").isin("c1", "c4"), 0.35).otherwise(0)
    return df.withColumn("y", (F.col("_u") < chance).cast("int")).drop("_u").repartition(5).cache()


def assembled(rows):
    pipeline = models.feature_pipeline(["c"], ["a", "b"], "y", models.random_forest("y", 1))
    return models.Pipeline(stages=pipeline.getStages()[:2]).fit(rows).transform(rows)


def grown(monkeypatch, forest, df):
    """The fitted forest; it is an error if Spark's own fit is used."""
    with monkeypatch.context() as patch:
        patch.setattr(SparkForest, "_fit", lambda *a: pytest.fail("left to Spark"))
        return forest.fit(df)


def test_one_tree_is_the_best_tree(rows, monkeypatch):
    """Without draws every node has the best of all splits, by brute force over thresholds and sets of categories."""
    df = assembled(rows)
    model = grown(monkeypatch, models.random_forest("y", 1, maxDepth=3, bootstrap=False), df)
    data = df.select(vector_to_array("features").alias("x"), "y").collect()
    x, y = np.array([r["x"] for r in data]), np.array([r["y"] for r in data])
    gini = lambda v: 0.0 if not len(v) else 2 * v.mean() * (1 - v.mean())
    nodes, = forests.saved_nodes(model, rows.sparkSession)

    def best(held):
        found = 0.0
        for f in range(3):
            values = np.unique(x[held, f])
            share = lambda c: y[held & (x[:, f] == c)].mean()
            order = sorted(values, key=share) if f == 0 else list(values)
            for k in range(1, len(order)):
                left = np.isin(x[:, f], order[:k])
                a, b = y[held & left], y[held & ~left]
                found = max(found, gini(y[held]) - (len(a) * gini(a) + len(b) * gini(b)) / held.sum())
        return found

    def check(node, held):
        assert node["impurityStats"] == [float((y[held] == c).sum()) for c in (0, 1)] and node["rawCount"] == held.sum()
        if node["leftChild"] < 0:
            return
        split = node["split"]
        values, side = x[:, split["featureIndex"]], split["leftCategoriesOrThreshold"]
        left = np.isin(values, side) if split["numCategories"] >= 0 else values <= side[0]
        assert node["gain"] == pytest.approx(best(held))
        check(nodes[node["leftChild"]], held & left)
        check(nodes[node["rightChild"]], held & ~left)

    assert nodes[0]["leftChild"] > 0
    check(nodes[0], np.ones(len(y), dtype=bool))


def test_scores_rank_as_well_as_sparks(rows, monkeypatch):
    df = assembled(rows)
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    params = dict(featuresCol="features", labelCol="y", numTrees=30, maxBins=1000, seed=5, rawPredictionCol="y_prob_raw")
    ours, theirs = grown(monkeypatch, models.random_forest("y", 30, 5), train), SparkForest(**params).fit(train)
    auc = models.BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="y_prob_raw")
    assert isinstance(ours, RandomForestClassificationModel) and ours.getNumTrees == 30
    assert auc.evaluate(ours.transform(test)) == pytest.approx(auc.evaluate(theirs.transform(test)), abs=0.02)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.1)


@pytest.mark.parametrize("spark_grown", [False, True])
def test_leaves_are_those_of_the_model(spark, rows, monkeypatch, spark_grown):
    df = assembled(rows)
    forest = (SparkForest(labelCol="y", leafCol="_leaf", numTrees=4, seed=1) if spark_grown
              else models.random_forest("y", 4).copy().setLeafCol("_leaf"))
    model = forest.fit(df) if spark_grown else grown(monkeypatch, forest, df)
    got = model.transform(df).select(vector_to_array("features").alias("x"), vector_to_array("_leaf").alias("leaf")).collect()
    find = forests.leaf_finder(forests.saved_nodes(model, spark))()
    assert (find(np.array([r["x"] for r in got])) == np.array([r["leaf"] for r in got])).all()


def test_a_seed_grows_one_forest(spark, rows, monkeypatch):
    """Rows are sorted in their block, so the order in which a partition's rows arrive does not matter."""
    df = assembled(rows).coalesce(1)
    turned = df.sortWithinPartitions(F.desc("id"))
    first, second, other = (forests.saved_nodes(grown(monkeypatch, models.random_forest("y", 3, seed), d), spark)
                            for seed, d in ((1, df), (1, turned), (2, df)))
    assert first == second != other


def test_many_values_are_cut_into_equal_parts():
    values = np.random.default_rng(1).random(20000)
    cuts = forests.cut_points(values, 9)
    assert len(cuts) == 9 and np.allclose(np.diff(np.searchsorted(np.sort(values), cuts)), 2000, atol=2)
    assert forests.cut_points(np.array([3.0, 1.0, 1.0, 2.0]), 9).tolist() == [1.5, 2.5]
    assert forests.cut_points(np.array([4.0, 4.0]), 9).tolist() == []


def test_rows_are_drawn_as_poisson():
    table = forests.draw_table(1.0, True)
    times = np.bincount(np.bincount(forests._drawn(table, 100000, 7, 1), minlength=100000)) / 100000
    assert times[:4] == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.006)
    assert forests._drawn(None, 5, 7).tolist() == [0, 1, 2, 3, 4]
    once = forests._drawn(forests.draw_table(0.25, False), 100000, 7)
    assert len(once) == len(set(once)) == pytest.approx(25000, rel=0.03)


@pytest.mark.parametrize("label", [None, -1, 0.5])
def test_labels_that_spark_refuses_fail(rows, label):
    df = assembled(rows).withColumn("y", F.when(F.col("id") == 7, F.lit(label)).otherwise(F.col("y")))
    with pytest.raises(Exception):
        models.random_forest("y", 2).fit(df)


def test_more_classes_and_weights_are_left_to_spark(rows):
    df = assembled(rows)
    three = models.random_forest("y", 2, maxDepth=2).fit(df.withColumn("y", (F.col("id") % 3).cast("int")))
    assert three.numClasses == 3 and three.getNumTrees == 2
    assert models.random_forest("y", 2, maxDepth=2, weightCol="a").fit(df).getNumTrees == 2


def test_forest_takes_no_fit_of_sparks(rows, monkeypatch):
    """Spark's fit keeps 800 bytes a row for 200 trees and is carried on to 34,000 CPU seconds at 6 GB: the search must not use it."""
    pipeline = models.feature_pipeline(["c"], ["a", "b"], "y", forest := models.random_forest("y", 4))
    with monkeypatch.context() as patch:
        patch.setattr(SparkForest, "_fit", lambda *a: pytest.fail("left to Spark"))
        search = models.grid_search(pipeline, forest, rows, {"numTrees": [2, 4]}, folds=2)
    assert all(0.6 < p["auc"] < 1 for p in search.points) and search.model.stages[-2].getNumTrees == search.best["numTrees"]
