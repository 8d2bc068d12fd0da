"""The runs table: one row per trained model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..sources import versions
from ..sources.catalog import Catalog

RUN_SCHEMA = (
    "run_id string, model_name string, production int, date string, ts timestamp_ntz,"
    " metrics map<string,double>, params map<string,string>, tags map<string,string>"
)


def run_record(spark: SparkSession, run_id: str, model_name: str, metrics: Mapping[str, float],
               params: Mapping[str, object], ts: dt.datetime, production: int = 0,
               tags: Mapping[str, object] | None = None) -> DataFrame:
    row = (
        run_id, model_name, production, ts.strftime("%Y%m%d"), ts,
        {k: float(v) for k, v in metrics.items() if v is not None},
        {k: str(v) for k, v in params.items()}, {k: str(v) for k, v in (tags or {}).items()},
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def record(catalog: Catalog, run: DataFrame, name: str = "runs") -> DataFrame:
    """Add a run (one row) to the runs table, which is created by the first one.

    Each run is a file of its own, added by one rename: writers may work at the same time.
    """
    versions.add_file(run, catalog.location(name), f"run-{run.first()['run_id']}", catalog.fmt)
    return catalog.table(name)


class RunStore:
    """Runs with their models and their predictions below one folder.

    ``runs`` holds one file per run, ``models/<run id>`` its pipeline, ``predictions/<run id>`` its scored rows by
    dataset.  The run's own row is written last, so a run that can be looked up is whole.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.catalog = Catalog(spark, self.root)

    def model_path(self, run_id: str) -> str:
        return f"{self.root}/models/{run_id}"

    def prediction_path(self, run_id: str) -> str:
        return f"{self.root}/predictions/{run_id}"

    def add(self, run: DataFrame, predictions: DataFrame | None = None, model=None) -> DataFrame:
        """Keep a run; ``predictions`` have a ``dataset`` column, by which they are partitioned.  All runs."""
        run_id = run.first()["run_id"]
        if model is not None:
            model.write().overwrite().save(self.model_path(run_id))
        if predictions is not None:
            predictions.write.partitionBy("dataset").parquet(self.prediction_path(run_id))
        return record(self.catalog, run)

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.catalog.location("runs"))

    def predictions(self, run_id: str, dataset: str | None = None) -> DataFrame:
        """The stored rows of one run, or of one dataset of it, which alone is then read."""
        rows = self.spark.read.parquet(self.prediction_path(run_id))
        return rows if dataset is None else rows.filter(F.col("dataset") == dataset)


def _metric(runs: DataFrame, name: str):
    return F.col(name) if name in runs.columns else F.col("metrics").getItem(name)


def _tagged(runs: DataFrame, tags: Mapping[str, object] | None) -> DataFrame:
    for tag, value in (tags or {}).items():
        runs = runs.filter(F.col("tags").getItem(tag) == str(value))
    return runs


def model_lookup(runs: DataFrame, name: str | None = None, metric: str = "auc",
                 tags: Mapping[str, object] | None = None) -> DataFrame:
    """The best run: production runs first, then the others, by falling metric.

    Any ``tags`` must be there; tags compare as text.  The result is empty when nothing matches; ``require_model`` raises.
    """
    found = _tagged(runs, tags).filter(F.col("production").cast("string").isin("1", "0"))
    if name is not None:
        found = found.filter(F.col("model_name").cast("string") == str(name))
    return found.orderBy(
        F.col("production").cast("string").desc(), _metric(runs, metric).desc_nulls_last(),
        F.col("run_id").asc(),
    ).limit(1)


def require_model(runs: DataFrame, name: str | None = None, metric: str = "auc",
                  tags: Mapping[str, object] | None = None) -> Row:
    row = model_lookup(runs, name, metric, tags).first()
    if row is None:
        raise LookupError(f"no run of model {name!r} in the registry")
    return row


def model_compare(runs: DataFrame, names: Sequence[str], metrics: Sequence[str] = ("auc", "accuracy"),
                  metric: str = "auc") -> DataFrame:
    """The metrics of the best run of each model, in one pass over the runs."""
    eligible = runs.filter(
        F.col("model_name").isin(*names) & F.col("production").cast("string").isin("1", "0")
    )
    # The smallest run id wins a tie, as in model_lookup; a missing metric comes last.
    worst = F.coalesce(-_metric(runs, metric), F.lit(float("inf")))
    order = F.struct((-F.col("production").cast("int")).alias("_p"), worst.alias("_m"), "run_id",
                     *[_metric(runs, m).alias(m) for m in metrics])
    return eligible.groupBy("model_name").agg(F.min(order).alias("_best")).select(
        "model_name", "_best.run_id", *[F.col(f"_best.{m}").alias(m) for m in metrics])


FIT_COLUMNS = ("base_rate", "cost", "trivial_cost", "mix_rate")


def adaptation_record(fit: DataFrame, run_id: str, factor: str, threshold: float, ts: dt.datetime,
                      tags: Mapping[str, object] | None = None, production: int = 0) -> DataFrame:
    """A fitted score adjustment (two rows) as a run named ``mitigate_<factor>``."""
    rows = sorted(fit.collect(), key=lambda row: str(row["group"]))
    params: dict[str, object] = {"decision_threshold": threshold}
    for k, row in enumerate(rows):
        params[f"group_{k}"] = row["group"]
        params.update({f"{c}_{k}": row[c] for c in FIT_COLUMNS})
    gap = abs(rows[0]["cost"] - rows[1]["cost"])
    return run_record(fit.sparkSession, run_id, f"mitigate_{factor}", {"cost_gap": gap}, params, ts, production,
                      {"factor": factor, **(tags or {})})


def adaptation_of(spark: SparkSession, run: Row, group_type: str = "string") -> tuple[DataFrame, float]:
    """The fitted rows of a recorded adjustment and its decision threshold."""
    params = run["params"]
    rows = [(params[f"group_{k}"], *[float(params[f"{c}_{k}"]) for c in FIT_COLUMNS]) for k in range(2)]
    fit = spark.createDataFrame(rows, "group string, " + ", ".join(f"{c} double" for c in FIT_COLUMNS))
    return fit.withColumn("group", F.col("group").cast(group_type)), float(params["decision_threshold"])
