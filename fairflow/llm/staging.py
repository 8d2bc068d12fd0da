"""Derived tables written below the shared folder: computed once, safe from lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import _within, scratch_path

#: What one task is trusted with, whatever the size of the input: rows, and bytes of files.
FEW_ROWS, FEW_BYTES = 1 << 14, 4 << 20


def staged(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet in the folder of ``spark.checkpoint.dir`` and read them back."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_few(df: DataFrame) -> tuple[DataFrame, bool]:
    """The staged rows, and whether they are few: these come back as one partition, and grouping, windows and merge joins
    of such frames need no exchange.

    A step over a handful of rows otherwise costs a task for each shuffle partition, and the driver keeps an account of
    every task and stage.  Rows and bytes are read from the footers; more rows than ``FEW_ROWS`` stay dealt over all tasks.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    few = _within(spark, path, FEW_ROWS, FEW_BYTES)
    return (rows.coalesce(1) if few else rows), few
