"""Training pipelines, scoring and feature preparation on Spark ML."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from itertools import accumulate, product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier as SparkForest,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import reused, spread, stage
from .forests import RandomForestClassifier, leaf_finder, saved_nodes
from .metrics import accuracy_at_threshold, class_balance, classification_report, roc_auc
from .registry import RunStore, run_record
from .threshold import TunedThreshold

# Tree counts searched, the default, and room for categories per split.
TREE_COUNTS, DEFAULT_TREES, MAX_BINS = (20, 50, 100, 200), 100, 1000


def split_features(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Sorted categorical (string) and numeric columns among ``features``."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return sorted(c for c in features if c in text), sorted(c for c in features if c not in text)


def output_columns(label: str) -> dict[str, str]:
    return {
        "predictionCol": f"{label}_predict", "probabilityCol": f"{label}_prob_vect",
        "rawPredictionCol": f"{label}_prob_raw",
    }


def random_forest(label: str, trees: int = DEFAULT_TREES, seed: int = 42, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxBins=MAX_BINS, seed=seed,
        **output_columns(label), **params,
    )


def boosted_trees(label: str, validation: str, tolerance: float = 0.01, seed: int = 42, **params) -> GBTClassifier:
    """Boosted trees that stop when the rows flagged by ``validation`` no longer improve."""
    names = output_columns(label)
    trees = GBTClassifier(
        labelCol=label, featuresCol="features", maxBins=MAX_BINS, seed=seed,
        validationIndicatorCol=validation, validationTol=tolerance,
        predictionCol=names["predictionCol"], **params,
    )
    return trees.setProbabilityCol(names["probabilityCol"]).setRawPredictionCol(names["rawPredictionCol"])


def logistic(label: str, weight: str | None = None, **params) -> LogisticRegression:
    model = LogisticRegression(labelCol=label, featuresCol="features", **output_columns(label), **params)
    return model if weight is None else model.setWeightCol(weight)


def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str,
                     classifier: Estimator, scale: bool = False) -> Pipeline:
    """Index categories by frequency, assemble, train, and tune the threshold.

    Unseen categories get an index of their own; a missing number is an error.  ``scale``
    standardises the vector.
    """
    stages = []
    if categorical:
        stages.append(StringIndexer(
            inputCols=list(categorical), outputCols=[f"{c}_INT" for c in categorical],
            stringOrderType="frequencyDesc", handleInvalid="keep",
        ))
    assembled = "assembled" if scale else "features"
    stages.append(VectorAssembler(
        inputCols=[f"{c}_INT" for c in categorical] + list(numeric), outputCol=assembled,
    ))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=True, withStd=True))
    stages += [classifier, TunedThreshold(
        inputCol=f"{label}_prob_vect", predictionCol=f"{label}_predict",
        outputCol=f"{label}_probability", labelCol=label,
    )]
    return Pipeline(stages=stages)


def leaf_chances(model: RandomForestClassificationModel, spark: SparkSession) -> list[list[float]]:
    """The chance of the second class in every leaf of every tree, leaves in the order `leafCol` numbers them."""
    return node_chances(saved_nodes(model, spark))


def node_chances(forest: Sequence[Sequence[dict]]) -> list[list[float]]:
    """`leaf_chances` of the saved nodes; a leaf has no children."""
    counts = [[node["impurityStats"] for node in tree if node["leftChild"] < 0] for tree in forest]
    return [[c[1] / sum(c) if sum(c) else 0.0 for c in tree] for tree in counts]


def prefix_scores(scored: DataFrame, col: str, chances: Sequence[Sequence[float]], counts: Sequence[int],
                  finder: Callable | None = None, features: int = 0) -> list[Column]:
    """``_trees_<n>``: the score of the forest of the first n trees, for every n, from one pass over the rows.

    ``col`` holds the leaves reached, or ``features`` numbers from which the function that ``finder`` makes finds them.  The
    chances are looked up and summed in Arrow batches, the trees in their order.
    """
    table, first = [p for tree in chances for p in tree], [0, *accumulate(map(len, chances))][:-1]

    def make_predict():
        import numpy as np

        chance, start, n = np.array(table, dtype="float64"), np.array(first, dtype="int64"), np.array(counts)
        find = (lambda leaves: leaves.astype("int64")) if finder is None else finder()
        return lambda rows: np.cumsum(chance[start + find(rows)], axis=1)[:, n - 1] / n

    predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=1 << 14,
                                input_tensor_shapes=[[features or len(chances)]])
    scores = predict(vector_to_array(col))
    return [F.get(scores, F.lit(i)).alias(f"_trees_{n}") for i, n in enumerate(counts)]


class Search(NamedTuple):
    """The pipeline with the best parameters, those, the mean metric of every point, and the fitted winner."""
    pipeline: Pipeline
    best: dict[str, object]
    points: list[dict[str, object]]
    model: PipelineModel | None


def grid_search(pipeline: Pipeline, classifier: Estimator, df: DataFrame,
                grid: Mapping[str, Sequence] | None = None,
                folds: int = 3, seed: int = 42, parallelism: int = 2) -> Search:
    """Cross-validated search by area under the ROC curve; by default over tree counts.

    The trees of a random forest are grown independently, so a forest of fewer trees is the first part of
    a larger one: each fold fits the largest forest only and scores its held-out rows with all tree counts in one
    pass.  The winner is fitted once, on all rows and with its threshold.  Fits and scores run on every core, however few
    bytes the rows have.  With one fold the search is skipped and the classifier keeps its own parameters.
    """
    if folds <= 1:
        return Search(pipeline, {}, [], None)
    grid = {k: list(v) for k, v in (grid or {"numTrees": TREE_COUNTS}).items()}
    counts = sorted(grid["numTrees"]) if isinstance(classifier, SparkForest) and "numTrees" in grid else []
    others = [k for k in grid if not (counts and k == "numTrees")]
    label, spark = classifier.getLabelCol(), df.sparkSession
    # The draw is written with its row, so that no row changes its fold.
    dealt = stage(df.withColumn("_fold", F.floor(F.rand(seed) * folds).cast("int")), ["_fold"])

    def evaluate(task: tuple) -> list[float]:
        values, fold = task
        extra = {classifier.getParam(k): v for k, v in zip(others, values)}
        if counts:
            extra |= {classifier.numTrees: counts[-1]}
        # Only ranks matter to the metric, so threshold stages are left out of the search.
        stages = [s for s in pipeline.copy(extra).getStages() if not isinstance(s, TunedThreshold)]
        fitted = Pipeline(stages=stages).fit(spread(dealt.filter(F.col("_fold") != fold).drop("_fold")))
        held = spread(dealt.filter(F.col("_fold") == fold).drop("_fold"))
        if counts:
            at, forest = next((i, s) for i, s in enumerate(fitted.stages) if isinstance(s, RandomForestClassificationModel))
            scored, nodes = PipelineModel(fitted.stages[:at]).transform(held), saved_nodes(forest, spark)
            scores = prefix_scores(scored, forest.getFeaturesCol(), node_chances(nodes), counts, leaf_finder(nodes), forest.numFeatures)
        else:
            scored, scores = fitted.transform(held), [F.col(classifier.getRawPredictionCol())]
        with reused(scored.select(label, *scores)) as narrow:
            return [BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=c, metricName="areaUnderROC").evaluate(narrow)
                    for c in narrow.columns[1:]]

    combos = list(product(*[grid[k] for k in others]))
    tasks = [(values, fold) for values in combos for fold in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        found = pool.map(inheritable_thread_target(spark)(evaluate), tasks)
    points = []
    for k, values in enumerate(combos):
        per_fold = found[k * folds:(k + 1) * folds]
        for i, n in enumerate(counts or [None]):
            point = {**({} if n is None else {"numTrees": n}), **dict(zip(others, values))}
            points.append({**{k: point[k] for k in grid}, "auc": float(sum(m[i] for m in per_fold) / folds)})
    best = {k: v for k, v in max(points, key=lambda p: p["auc"]).items() if k != "auc"}
    tuned = pipeline.copy({classifier.getParam(k): v for k, v in best.items()})
    return Search(tuned, best, points, tuned.fit(spread(dealt.drop("_fold"))))


def train_and_record(train: DataFrame, test: DataFrame, pipeline: Pipeline, label: str, model_name: str,
                     params: Mapping[str, object] | None = None, model_root: str | None = None,
                     store: RunStore | None = None, keys: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """Fit, measure on the test rows, and describe the run as one row of the runs table.

    Every metric is an aggregate over the scored rows; the driver sees a handful of numbers.
    With ``model_root`` the fitted pipeline is saved below it under its run id.  A ``store`` keeps the run, the
    pipeline and the scored rows of both sides: ``keys``, label, score, prediction and ``dataset``.
    """
    spark = train.sparkSession
    model = pipeline.fit(train)
    cut = model.stages[-1].getTunedThreshold()
    score, pred = f"{label}_probability", f"{label}_predict"
    # Each side goes through the model once; the metrics read three narrow columns.
    scored = {side: stage(model.transform(df).select(*keys, label, score, pred)) for side, df in (("train", train), ("test", test))}
    report = classification_report(scored["test"], label, pred)
    balance = class_balance(train, label).first()
    metrics = {
        "auc": roc_auc(scored["test"], label, score).first()["auc"],
        "train_auc": roc_auc(scored["train"], label, score).first()["auc"],
        "accuracy": report.filter("class = 'accuracy'").first()["f1"],
        "train_accuracy": accuracy_at_threshold(scored["train"], label, score, cut).first()["accuracy"],
        "test_accuracy": accuracy_at_threshold(scored["test"], label, score, cut).first()["accuracy"],
        "samples": float(balance["samples_pos"] + balance["samples_neg"]),
    }
    described = {
        "decision_threshold": cut, "samples_pos": balance["samples_pos"],
        "samples_neg": balance["samples_neg"], "samples_ratio": balance["samples_ratio"], **(params or {}),
    }
    run_id = uuid.uuid4().hex
    if model_root is not None:
        model.write().overwrite().save(f"{model_root.rstrip('/')}/{run_id}")
    run = run_record(spark, run_id, model_name, metrics, described, dt.datetime.now())
    if store is not None:
        sides = [rows.withColumn("dataset", F.lit(side)) for side, rows in scored.items()]
        store.add(run, sides[0].unionByName(sides[1]), model)
    return model, run


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] = (), model_id: str | None = None) -> DataFrame:
    """Apply a model.  With ``keep`` the result is the columns the model adds, then those."""
    scored = model.transform(df)
    if model_id is not None:
        scored = scored.withColumn("model_id", F.lit(model_id))
    if not keep:
        return scored
    added = [c for c in scored.columns if c not in set(df.columns)]
    return scored.select(*added, *[c for c in keep if c not in added])


def vector_udf_score(df: DataFrame, cols: Sequence[str], size: int, make_model, out: str = "score",
                     batch_size: int = 4096) -> DataFrame:
    """Score the concatenation of several array columns, ``size`` numbers in all, with a Python
    model in Arrow batches.

    ``make_model`` returns a function from a 2-d float array to one score per row.  It is
    called once per Python worker and kept there.
    """
    def make_predict():
        import numpy as np

        model = make_model()
        return lambda vectors: np.asarray(model(vectors), dtype="float64").reshape(-1)

    predict = predict_batch_udf(
        make_predict, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[size]]
    )
    vector = F.concat(*[F.col(c).cast("array<double>") for c in cols])
    return df.withColumn(out, predict(vector))


def standardise(df: DataFrame, cols: Sequence[str], population: bool = False) -> DataFrame:
    """Centre and scale columns in one aggregate; ``population`` divides by n instead of n - 1."""
    spread = F.stddev_pop if population else F.stddev
    stats = df.agg(F.struct(*[
        c for name in cols
        for c in (F.avg(name).alias(f"{name}_mean"), spread(name).alias(f"{name}_std"))
    ])).scalar()
    return df.withColumn("_stats", stats).withColumns({
        f"{c}_scaled": F.try_divide(F.col(c) - F.col(f"_stats.{c}_mean"), F.col(f"_stats.{c}_std"))
        for c in cols
    }).drop("_stats")


def impute_with_indicators(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill missing numbers with the column mean and flag them in ``<column>_missing``."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    return df.withColumn("_means", means).withColumns({
        **{f"{c}_missing": F.col(c).isNull().cast("int") for c in cols},
        **{c: F.coalesce(F.col(c).cast("double"), F.col(f"_means.{c}")) for c in cols},
    }).drop("_means")


def fill_nulls(df: DataFrame, constants: Mapping[str, object] | None = None, numeric=None) -> DataFrame:
    """Per-column constants first, then one value for every other missing number."""
    if constants:
        df = df.fillna(dict(constants))
    return df if numeric is None else df.fillna(numeric)


def embedding_columns(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """An array column as an ML vector."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))

