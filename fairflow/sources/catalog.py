"""Named tables below one root folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from . import versions


class Catalog:
    """Maps table names to folders of files.

    ``paths`` overrides the location of single tables; every other name lives at
    ``root/name``.  ``fmt`` is any file source of the session: ``parquet`` and ``orc`` are
    built in, ``delta`` works where its package is installed and keeps versions itself; for the others
    see `versions`.
    """

    def __init__(self, spark: SparkSession, root: str, paths: dict[str, str] | None = None,
                 suffix: str = "", fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.paths = dict(paths or {})
        self.suffix = suffix
        self.fmt = fmt

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.location(name))

    def location(self, name: str) -> str:
        """The folder of the present version of a table."""
        return self.path(name) if self.fmt == "delta" else versions.resolve(self.spark, self.path(name))

    def path(self, name: str) -> str:
        return self.paths.get(name, f"{self.root}/{name}{self.suffix}")

    def table(self, name: str, cols: Sequence[str] | None = None) -> DataFrame:
        """Load a table; with ``cols`` only those columns are read from the files."""
        df = self._read(name)
        return df if cols is None else df.select(*cols)

    def exists(self, name: str) -> bool:
        try:
            self._read(name)
        except AnalysisException as error:
            # A written table without rows or an absent folder; anything else is a real fault.
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_MISSING_DELTA_TABLE"):
                return False
            raise
        return True

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table, schema included, and return the written rows (which cuts the lineage).

        Readers see the old rows until the new ones are complete; a write that fails leaves the old ones.
        """
        if self.fmt == "delta":
            df.write.format(self.fmt).mode("overwrite").option("overwriteSchema", "true").partitionBy(*partition_by).save(self.path(name))
        else:
            versions.replace(df, self.path(name), self.fmt, partition_by)
        return self.table(name)

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        df.write.format(self.fmt).mode("append").partitionBy(*partition_by).save(self.location(name))
        return self.table(name)

    def get_or_create(self, name: str, builder: Callable[[], DataFrame]) -> DataFrame:
        """Read a table, building and writing it first when it is absent."""
        return self.table(name) if self.exists(name) else self.overwrite(builder(), name)
