"""The query registry and the SQL building blocks shared by the checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import stats
from ..functions.calendar import DAYPARTS
from ..sources.fixtures import VIEWS, duck_view

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
STEPS: dict[str, tuple[str, tuple[str, ...]]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; without ``sql`` only its rows can be checked."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return register


def step(name: str, sql: str, *needs: str) -> None:
    """Name a SQL step that later texts can build on."""
    STEPS[name] = (sql.strip(), needs)


def using(*names: str) -> str:
    """``WITH`` clause with the named views and steps and everything they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in STEPS[name][1] if name in STEPS else ():
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    texts = [f"{n} AS MATERIALIZED ({STEPS[n][0] if n in STEPS else duck_view(n)})"
             for n in ordered if n in STEPS or n in VIEWS]
    return "WITH " + ",\n".join(texts) + "\n"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns, so that the order of a floating point sum does not show."""
    return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in digits.items()})


def r(expr: str, digits: int, alias: str | None = None) -> str:
    """The same in SQL; adding zero turns a negative zero into zero."""
    return f"round({expr}, {digits}) + 0.0 AS {alias or expr}"


def num(value: float) -> str:
    """A double literal."""
    return f"{value!r}::DOUBLE" if "e" in repr(value) else f"{value!r}e0"


def uniform_sql(keys: Sequence[str], seed: int) -> str:
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws(':', {text}, '{seed}')), 1, 8) AS BIGINT) / 4294967296e0)"


def zscore_sql(x: str, mean: str, std: str) -> str:
    return f"(({x}) - ({mean})) / nullif({std}, 0)"


def daypart_sql(hour: str) -> str:
    cases = " ".join(f"WHEN {hour} < {limit} THEN '{name}'" for limit, name in DAYPARTS)
    return f"CASE {cases} ELSE 'twilight' END"


def band_sql(z: str, mode: str = "intended") -> str:
    if mode == "strict":
        z1, z2, z3 = f"{z}*0.67448e0", f"{z}*0e0", f"{z}*-0.67448e0"
    else:
        z1, z2, z3 = "0.67448e0", "0", "-0.67448e0"
    return f"CASE WHEN {z} >= {z1} THEN 1 WHEN {z} >= {z2} THEN 2 WHEN {z} >= {z3} THEN 3 ELSE 4 END"


def _poly_sql(x: str, coefficients: Sequence[float]) -> str:
    text = num(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {num(c)})"
    return text


def cdf_sql(x: str) -> str:
    a, e = f"abs({x})", f"exp(-({x}) * ({x}) / 2)"
    near = f"{e} * {_poly_sql(a, stats.CDF_NUMERATOR)} / {_poly_sql(a, stats.CDF_DENOMINATOR)}"
    far = f"{e} / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65e0))))) / {num(stats.SQRT_TWO_PI)}"
    tail = f"CASE WHEN {a} < {num(stats.CDF_SPLIT)} THEN {near} WHEN {a} <= 37 THEN {far} ELSE 0 END"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) > 0 THEN 1 - ({tail}) ELSE ({tail}) END)"


def ppf_sql(p: str) -> str:
    def tail(q: str) -> str:
        return (f"{_poly_sql(q, stats.PPF_TAIL_NUMERATOR)} / {_poly_sql(q, stats.PPF_TAIL_DENOMINATOR)}")

    c = f"(({p}) - 0.5e0)"
    s = f"({c} * {c})"
    middle = (f"{c} * {_poly_sql(s, stats.PPF_CENTRAL_NUMERATOR)}"
              f" / {_poly_sql(s, stats.PPF_CENTRAL_DENOMINATOR)}")
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - ({p})))"
    return (f"(CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN ({p}) < 0.02425e0 THEN {tail(low)}"
            f" WHEN ({p}) > 1 - 0.02425e0 THEN -({tail(high)}) ELSE {middle} END)")


def delta_sql(x1: str, x2: str) -> str:
    """Clipped probability difference; NULL if either z-score is."""
    gap = f"{cdf_sql(x1)} - {cdf_sql(x2)}"
    return (f"(CASE WHEN ({x1}) IS NULL OR ({x2}) IS NULL THEN NULL"
            f" ELSE greatest(least({gap}, 0.9999e0), 0.001e0) END)")


def pred_at(score: str, threshold: float) -> Column:
    return F.when(F.col(score) >= threshold, 1).otherwise(0)
