"""CSV ingestion, column naming rules and attribute lookups."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import json_map
from .catalog import Catalog


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             drop: Sequence[str] = ("_c0",), text: Sequence[str] = ()) -> DataFrame:
    """CSV with a header.  A declared ``schema`` saves the extra pass that inference
    needs.  ``drop`` names index columns, ``text`` columns to keep as strings."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path).drop(*drop)
    return df.withColumns({c: F.col(c).cast("string") for c in text})


def normalise_columns(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case column names without trailing digits; ``rename`` is applied first.

    Two columns that would end up with one name are an error.
    """
    rename = rename or {}
    names = [re.sub(r"\d+$", "", rename.get(c, c).lower()) for c in df.columns]
    clashes = [name for name, n in Counter(names).items() if n > 1 or not name]
    if clashes:
        raise ValueError(f"column names collide after normalising: {clashes}")
    return df.toDF(*names)


def dimension_lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str] | str,
                     cols: Sequence[str]) -> DataFrame:
    """Left-join ``cols`` of a dimension; unknown keys give NULLs.

    ``on`` is a shared column name or ``{left: right}``.  The dimension is reduced to
    its key and ``cols``; no hint is set, so Spark broadcasts it only if it measures
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    keyed = dim.select(*[F.col(r).alias(f"_key_{l}") for l, r in pairs.items()], *cols)
    joined = df.join(keyed, [df[l] == keyed[f"_key_{l}"] for l in pairs], "left")
    return joined.drop(*[f"_key_{l}" for l in pairs])


def json_map_extract(df: DataFrame, col: str, keys: Iterable[str]) -> DataFrame:
    """One string column per key of a JSON object column; the source column is dropped.

    The parsed map is held in one column, so the text is parsed once per row.
    """
    parsed = df.withColumn("_map", json_map(F.col(col)))
    return parsed.withColumns({k: F.col("_map").getItem(k) for k in keys}).drop("_map", col)


def import_shapes(catalog: Catalog, name: str, path: str, geometry: str,
                  schema: T.StructType | str | None = None, key: str | None = None,
                  lookup: DataFrame | None = None, lookup_key: str = "zip",
                  cols: Sequence[str] = ()) -> DataFrame:
    """CSV of shapes to a table: geometry kept as text, names normalised, attributes looked up.

    ``key`` names the column that becomes ``zip``; without it nothing is looked up.  The
    written table is returned, so later steps start from files.
    """
    shapes = read_csv(catalog.spark, path, schema, text=[geometry])
    shapes = normalise_columns(shapes, {} if key is None else {key: "zip"})
    if key is not None and lookup is not None:
        text_key = lookup.withColumn(lookup_key, F.col(lookup_key).cast("string"))
        shapes = dimension_lookup(
            shapes.withColumn("zip", F.col("zip").cast("string")), text_key, {"zip": lookup_key}, cols
        )
    return catalog.overwrite(shapes, name)


def feature_set(df: DataFrame, cols: Sequence[str] | None = None,
                private: Sequence[str] = ()) -> DataFrame:
    """Column projection of a feature table; ``private`` columns never pass through."""
    keep = df.columns if cols is None else list(cols)
    blocked = set(private)
    return df.select(*[c for c in keep if c not in blocked])


def inline_dimension(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A dimension written in code.  Its size is that of the literal in the program."""
    return spark.createDataFrame(list(rows), schema)


def align_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to their shared columns in the order of ``a``."""
    shared = [c for c in a.columns if c in set(b.columns)]
    if not shared:
        raise ValueError("the frames share no column")
    return a.select(*shared), b.select(*shared)
