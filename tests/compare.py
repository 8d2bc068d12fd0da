"""Runs registered queries next to their SQL in DuckDB and compares every value.

As a program:  python tests/compare.py [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TESTDATA = Path("/root/testdata")

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted((TESTDATA / sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """What is wrong, or None.  Types count: an INTEGER is not a BIGINT."""
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(expected_types)
    if sorted(df.columns) != order:
        return f"columns {sorted(df.columns)} != {order}"
    types = {c: KINDS.get(t, t) for c, t in df.dtypes}
    wrong = {c: (types[c], expected_types[c]) for c in order if types[c] != expected_types[c]}
    names = [d[0] for d in result.description]
    want = sorted(repr([row[names.index(c)] for c in order]) for row in result.fetchall())
    got = sorted(repr([row[c] for c in order]) for row in df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            bad = sum(x != y for x, y in zip(got, want))
            return f"{bad} of {len(want)} rows differ: {order} {a} expected {b}"
    return f"types {wrong}" if wrong else None


def session():
    from fairflow.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf: str, names: list[str]) -> None:
    import traceback
    from __spark_entry__ import oracle_sql, queries

    spark, con, failed = session(), duck(sf), []
    oracles = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, str(TESTDATA / sf))
            wrong = difference(df, con, oracles[name]) if name in oracles else (
                None if df.collect() else "no rows")
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        print(f"{'FAIL' if wrong else 'ok  '} {name:28s} {time.time() - start:6.2f}s {wrong or ''}", flush=True)
        if wrong:
            failed.append(name)
    print(f"{len(failed)} failed of {len(queries())}: {failed}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "sf0.01", sys.argv[2:])
