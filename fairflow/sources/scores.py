"""Scores kept by id, so that joining them back moves only the other side."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path


class ScoreStore:
    """Scores written by one job, bucketed and sorted by their id, and joined back by any number of others.

    ``path`` is a shared folder; without one the store lives as long as the session.  A bucketed table needs an entry in
    the session's catalog, which `open` makes again in another session.
    """

    def __init__(self, spark: SparkSession, table: str, id_col: str):
        self.spark, self.table, self.id_col = spark, table, id_col

    @classmethod
    def write(cls, scores: DataFrame, id_col: str, buckets: int | None = None, path: str | None = None) -> "ScoreStore":
        """Buckets default to the session's shuffle partitions, so the other side's exchange fits them."""
        spark = scores.sparkSession
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"scores_{uuid.uuid4().hex}"
        # Dealt as the buckets are, every task writes its own buckets only, one file each.
        dealt = scores.repartition(count, F.col(id_col))
        dealt.write.bucketBy(count, id_col).sortBy(id_col).option("path", path or scratch_path(spark, "scores")).saveAsTable(table)
        return cls(spark, table, id_col)

    @classmethod
    def open(cls, spark: SparkSession, path: str, id_col: str, buckets: int) -> "ScoreStore":
        """A store that another session wrote to ``path`` with so many buckets."""
        table = f"scores_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{id_col}`) SORTED BY (`{id_col}`)"
                  f" INTO {buckets} BUCKETS LOCATION '{path}'")
        return cls(spark, table, id_col)

    def scores(self) -> DataFrame:
        return self.spark.table(self.table)

    def attach(self, df: DataFrame, how: str = "inner") -> DataFrame:
        """The rows of ``df`` with their scores: a merge join that exchanges ``df`` alone."""
        return df.join(self.scores().hint("merge"), self.id_col, how)

    def forget(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
