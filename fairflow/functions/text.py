"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# What of a value's text stays in a column name.
OTHER_CHARACTERS, UNDERSCORES = "[^0-9a-zA-Z]+", "_+"


def slug(factor: Column, value: Column) -> Column:
    """``factor_value`` with every run of other characters turned into one underscore."""
    clean = F.regexp_replace(value, OTHER_CHARACTERS, "_")
    return F.regexp_replace(F.concat(factor, F.lit("_"), clean), UNDERSCORES, "_")


def json_map(text: Column) -> Column:
    """JSON object text as ``MAP<STRING,STRING>``."""
    return F.from_json(text, "MAP<STRING,STRING>")
