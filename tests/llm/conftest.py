import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make(spark):
    """(id, text) or (id, text, lang, source) rows as a documents table."""
    def build(rows, parts=3):
        full = [(*r, *(None, None)[:4 - len(r)], len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return build


@pytest.fixture(scope="session")
def texts():
    """The documents of the smallest table."""
    import pyarrow.parquet as pq
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table]
