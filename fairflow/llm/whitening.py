"""Embedding whitening: weighted multiplicity covariance.

1. *Lattice.*  Every entry c of a vector, as double, becomes the whole number floor(scale * c), so that equal
   vectors are equal to the last bit.  Identical x vectors are grouped with their number of rows.
2. *Weights.*  The fit list holds each distinct x vector once with the weight one, or, with
   ``weights="count"``, with its number of rows.  Sums are exact.
3. *Covariance.*  Tasks centre the vectors by the mean, then multiply (one weighted matrix product a batch)
   and add up; the partial matrices are added in two steps, row by row, so no task holds more than a
   few hundred rows of them.  Only the finished d x d matrix comes to the driver.
4. *Whitening.*  Each distinct vector is projected once on the leading unit eigenvectors, over the root of the
   eigenvalue, and joined back to its rows.  Vectors with a thousandth of all rows or more, at most a
   thousand, are broadcast; the others meet by a merge join.

Defined results.  A row whose vector is NULL or holds a NULL, NaN or infinite entry is left out.  Vectors of
another length than most rows have (ties: the shorter length) lack entries and are left out as well.  Entries beyond the range of
64 bits stay at its ends.  Ids are passed on as they are, NULL and repeated ones too; other columns are ignored.
A component without variance (an eigenvalue of zero to double precision) has NULL for its whitened value and does
not count for the identity error.  A deviation beyond 64 bits is NULL.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .register import query
from .staging import staged

SCALE = 256
COMPONENTS = 4
HOT_SHARE = 1000
PARTS = 256
_LONG = (1 << 63) - 1


def lattice(embeddings: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """_id and x of every row with a whole vector."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    broken = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return embeddings.filter(vec.isNotNull() & ~broken).select(
        F.col(f"`{id_col}`").alias("_id"), F.transform(vec, lambda c: F.floor(c * float(scale))).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _weight(batch: pa.RecordBatch, counted: bool) -> np.ndarray:
    return batch.column("copies").to_numpy() if counted else np.ones(len(batch), np.int64)


def _sums(counted: bool):
    """The weights and the exact weighted sums of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not len(batch):
                continue
            x, w = _matrix(batch.column("x")), _weight(batch, counted)
            fits = np.abs(x.astype(float)).max(initial=0) * float(w.sum()) < 2.0 ** 62
            sums = (w @ x).tolist() if fits else [sum(map(int.__mul__, w.tolist(), c)) for c in x.T.tolist()]
            n += int(w.sum())
            total = sums if total is None else [a + b for a, b in zip(total, sums)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([[Decimal(s) for s in total]], pa.list_(pa.decimal128(38, 0)))], ["n", "sums"])
    return run


def _products(mean: np.ndarray, counted: bool):
    """The centred, weighted products of one task, a row of the matrix each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            if len(batch):
                c = _matrix(batch.column("x")) - mean
                step = c.T @ (_weight(batch, counted)[:, None] * c)
                out = step if out is None else out + step
        if out is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(out)), pa.int32()), pa.array([task] * len(out), pa.int32()),
                 pa.array(list(out), pa.list_(pa.float64()))], ["i", "part", "row"])
    return run


def _add(table: pa.Table) -> pa.Table:
    """Rows of one place added in the order of their tasks, so that a retried task changes nothing."""
    table = table.sort_by("part")
    rows = np.array(table.column("row").to_pylist())
    return pa.table({"i": table.column("i").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "row": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})


@dataclass
class Model:
    """What a fit knows: weights n, exact sums, unit components (a column each) and their eigenvalues."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def varied(self) -> np.ndarray:
        """Which components have a variance."""
        return self.values > self.trace * len(self.sums) * np.finfo(float).eps


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """x and copies of every distinct vector of the usual length."""
    grouped = staged(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")))
    usual = grouped.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), "d").first()
    return grouped.filter(F.size("x") == (usual["d"] if usual else 0))


def fit(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one") -> Model | None:
    """The leading components of the fit list (x, copies); None without vectors."""
    if weights not in ("one", "count"):
        raise ValueError(f"unknown weights {weights!r}: use 'one' or 'count'")
    counted = weights == "count"
    partial = staged(vectors.mapInArrow(_sums(counted), "n long, sums array<decimal(38,0)>"))
    n = partial.agg(F.sum("n")).first()[0]
    if not n:
        return None
    by_place = partial.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s"))
    sums = [int(r["s"]) for r in sorted(by_place.collect())]  # one number a dimension
    if not sums:
        return None
    schema = "i int, part int, row array<double>"
    mean = np.array([s / n for s in sums])
    products = vectors.mapInArrow(_products(mean, counted), schema)
    some = products.groupBy("i", (F.col("part") % PARTS)).applyInArrow(_add, schema)
    rows = sorted(some.groupBy("i").applyInArrow(_add, schema).collect())  # one row a dimension
    v = np.array([r["row"] for r in rows]) / n
    values, columns = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    columns = columns[:, order]
    largest = np.abs(columns).argmax(axis=0)
    columns = columns * np.where(columns[largest, np.arange(columns.shape[1])] < 0, -1.0, 1.0)
    return Model(int(n), sums, columns, values[order], float(np.trace(v)))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sum) ** 2, exactly; None beyond 64 bits."""
    rough = ((float(n) * x - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    reach = float(n) * np.abs(x.astype(float)).max(initial=0) + max(abs(s) for s in sums)
    if reach < 2.0 ** 62 and (rough < 9e18).all():
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    out: list[int | None] = []
    for row, about in zip(x, rough):
        exact = sum((n * v - s) ** 2 for v, s in zip(row.tolist(), sums)) if about < 1e19 else None
        out.append(exact if exact is not None and exact <= _LONG else None)
    return out


def _whitened(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, varied = model.mean, model.varied()
        scale = np.sqrt(np.where(varied, model.values, 1.0))
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("x"))
                z = (x - mean) @ model.components / scale
                given = [[v if k else None for v, k in zip(row, varied)] for row in z.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("x"), batch.column("copies"), pa.array(_deviations(x, model.n, model.sums), pa.int64()),
                     pa.array(given, pa.list_(pa.float64()))], ["x", "copies", "deviation", "whitened"])
    return run


def whiten_vectors(vectors: DataFrame, model: Model) -> DataFrame:
    """x, copies, deviation and whitened of every distinct vector, written once."""
    return staged(vectors.mapInArrow(_whitened(model), "x array<long>, copies long, deviation long, whitened array<double>"))


def identity_error(whitened: DataFrame, model: Model, weights: str = "one") -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list less the identity; None without variance."""
    places = np.flatnonzero(model.varied()).tolist()
    if not places:
        return None
    weight = F.col("copies").cast("double") if weights == "count" else F.lit(1.0)

    def average(value: Column) -> Column:
        return F.sum(weight * value) / F.sum(weight)

    z = [F.get("whitened", k) for k in places]
    means = whitened.agg(*[average(v).alias(f"m{k}") for k, v in enumerate(z)]).first()
    pairs = [(a, b) for a in range(len(z)) for b in range(a, len(z))]
    moments = whitened.agg(*[average((z[a] - means[a]) * (z[b] - means[b])).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(moments[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def join_back(rows: DataFrame, whitened: DataFrame, total: int) -> DataFrame:
    """_id, copies, deviation and whitened of every row."""
    hot = whitened.filter(F.col("copies") * HOT_SHARE >= total)  # HOT_SHARE vectors at most
    rest = whitened.filter(F.col("copies") * HOT_SHARE < total)
    often = rows.join(F.broadcast(hot), "x")
    seldom = rows.join(F.broadcast(hot.select("x")), "x", "left_anti").join(rest.hint("merge"), "x")
    return often.unionByName(seldom).drop("x")


OUT = "component int, n long, copies long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           weights: str = "one", scale: int = SCALE) -> DataFrame:
    """The id column and ``OUT`` per row with a whole vector and component."""
    rows = lattice(embeddings, id_col, vec_col, scale)
    vectors = distinct_vectors(rows)
    model = fit(vectors, components, weights)
    if model is None:
        names = [f"CAST(NULL AS {kind}) AS {name}" for name, kind in (f.split() for f in OUT.split(", "))]
        return rows.filter("false").select(F.col("_id").alias(id_col), *map(F.expr, names))
    whitened = whiten_vectors(vectors, model)
    total = vectors.agg(F.sum("copies")).first()[0]
    error = identity_error(whitened, model, weights)
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    shares = F.array(*[F.lit(v).cast("double") for v in explained])
    return join_back(rows, whitened, total).select(
        F.col("_id").alias(id_col), "copies", "deviation", F.posexplode("whitened").alias("_at", "whitened"),
    ).select(
        id_col, (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "copies", "deviation",
        "whitened", F.get(shares, F.col("_at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(embeddings).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "copies")
