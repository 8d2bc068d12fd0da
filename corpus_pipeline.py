"""The corpus pipeline: documents through five training-data operators, one stage after another.

1. toxic documents go; 2. one document of each group of near copies stays; 3. documents contaminated by
the benchmark go, and shorter passages of it are cut; 4. personal data get pseudonyms; 5. documents are
sampled to the target mixture.  Every stage but the last returns the columns of ``documents``; the last
adds the weight and the probability of each sampled document.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from fairflow.llm import decontaminate, minhash, mixing, pii, toxicity
from fairflow.llm.staging import staged
from fairflow.session import staging_scope

#: The secret of the pseudonyms; unset, the public key of the registered query serves.
KEY = os.environ.get("CORPUS_KEY", pii.QUERY_KEY)


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars of changed texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(pii.pseudonymise(docs, KEY))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
]

#: Trained scores, hashes of word sets and keyed permutations are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it, and what was
    staged on the way to it goes then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with staging_scope(spark) as scope:
        for _, stage in STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir))
            scope.drop(docs)
        sample = STAGES[-1][1](spark, docs, sf_dir)
        scope.drop(sample)
    return sample
