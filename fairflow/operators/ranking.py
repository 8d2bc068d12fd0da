"""Ranks, tiles and running totals over groups of any size.

A window function sorts each of its partitions in one task, which is fine for the
days of a zone but not for a third of a huge table.  Both ways here move the rows once:

* `row_numbers` and `ntile_by` range partition the rows over the whole sort key, sort
  within the partitions and number the rows where they lie.  A small table, one row per
  partition and group, says how many rows of a group lie in front.
* `step_totals` reduces rows to distinct keys with running sums.  A sketch of the keys gives
  cut points, a histogram over them the sums in front of each cell, and the rows of a cell
  are reduced and summed up in place.  A key that several cut points hit is frequent: it
  is a cell of its own, whose sums the histogram already has, and its rows never move.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import size_checked, stage

BEFORE, TOTAL = "_before", "_total"
CELLS = 512
_PLACES = 33  # monotonically_increasing_id holds the place within the partition in its lower 33 bits


def sorted_slices(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The rows in order, with the group, the slice and the place ``_at`` that numbers them: one exchange."""
    placed = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn(
        "_at", F.monotonically_increasing_id())
    return placed.withColumns({
        "_group": F.struct(*by) if by else F.lit(0), "_slice": F.shiftright("_at", _PLACES),
    })


def row_numbers(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Add ``row_number`` (from 1) and ``group_rows`` within each group.

    ``order`` must be a total order within a group, or the result depends on chance.
    """
    sliced = stage(sorted_slices(df, order, by))
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    edges = sliced.groupBy("_group", "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    offsets = edges.select(
        "_group", "_slice", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("group_rows"),
    )
    # One row per slice without groups: never more than the session's shuffle partitions.
    offsets = size_checked(offsets) if by else F.broadcast(offsets)
    return sliced.join(offsets, ["_group", "_slice"]).select(
        *df.columns, (F.col("_at") + F.col("_shift") + 1).alias("row_number"), "group_rows")


def ntile_by(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, out: str) -> DataFrame:
    """SQL ``ntile(n)`` over groups of any size; ``order`` needs a unique tiebreak.

    The first ``rows % n`` tiles hold one row more than the others.
    """
    numbered = row_numbers(df, order, by).withColumns({
        "_small": F.expr(f"group_rows div {n}"),
        "_wide": F.expr(f"group_rows % {n}"),
    })
    tile = F.expr(
        "CASE WHEN row_number <= _wide * (_small + 1) THEN (row_number - 1) div (_small + 1) + 1"
        " ELSE _wide + (row_number - 1 - _wide * (_small + 1)) div greatest(_small, 1) + 1 END"
    )
    return numbered.select(*df.columns, tile.cast("int").alias(out))


def literal_array(values: Sequence, kind: str) -> Column:
    """A constant array; as one text it takes one call to build, however long."""
    return F.split(F.lit(",".join(str(v).lower().replace("inf", "Infinity") for v in values)), ",").cast(f"array<{kind}>")


def _cut_points(rows: DataFrame, key: str, cells: int) -> tuple[list[float], list[bool]]:
    """Ascending cut points, and whether each is a frequent key; one mergeable sketch per task."""
    shares = ", ".join(f"{k / cells!r}D" for k in range(1, cells))
    found = rows.agg(F.expr(f"percentile_approx(`{key}`, array({shares}), {20 * cells})")).first()[0] or []
    times = Counter(float(v) for v in found if math.isfinite(v))
    cuts = sorted(times) or [0.0]
    return cuts, [times[c] > 1 for c in cuts]


def step_cells(rows: DataFrame, key: str, cells: int = CELLS) -> tuple[DataFrame, list[bool]]:
    """The rows with the number of their cell, ascending as their keys, and which cells hold one key only.

    Cut point k opens cell 2k + 2; a frequent key at it has the cell 2k + 1 for itself.
    """
    cuts, frequent = _cut_points(rows, key, cells)
    bucket = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=key, outputCol="_bucket", handleInvalid="keep")
    # NaN, the bucket after the last, sorts behind all others, as in SQL.
    k = F.col("_bucket").cast("int")
    edges = literal_array([-math.inf, *cuts, math.inf], "double")
    alone = literal_array([False, *frequent, False], "boolean")
    on_edge = F.get(alone, k) & (F.get(edges, k) == F.col(key))
    cell = F.when(on_edge, 2 * k - 1).otherwise(2 * k)
    return bucket.transform(rows).withColumn("_cell", cell).drop("_bucket"), [
        c % 2 == 1 and c // 2 < len(cuts) and frequent[c // 2] for c in range(2 * len(cuts) + 3)]


def cell_steps(cut: DataFrame, key: str, sums: Mapping[str, Column], descending: bool) -> DataFrame:
    """Distinct keys with their sums and the sums ahead within the cell: one exchange, by cell."""
    ahead = Window.partitionBy("_cell").orderBy(F.col(key).desc() if descending else F.col(key).asc()).rowsBetween(
        Window.unboundedPreceding, -1)
    steps = cut.repartition("_cell").groupBy("_cell", key).agg(*[c.alias(n) for n, c in sums.items()])
    return steps.withColumns({n + BEFORE: F.coalesce(F.sum(n).over(ahead), F.lit(0)) for n in sums})


def step_totals(df: DataFrame, key: str, sums: Mapping[str, Column], descending: bool = False,
                cells: int = CELLS) -> DataFrame:
    """Distinct values of ``key`` with, for each sum, its value, ``_before`` (all keys ahead) and ``_total``.

    ``sums`` are aggregates that are never NULL; rows without a key are left out.  Only the histogram, two rows per cut
    point, passes through the driver.  Where keys repeat a lot, rows are first combined within their tasks.
    """
    kind = dict(df.dtypes)[key]
    known = df.filter(F.col(key).isNotNull())
    if kind in ("double", "float"):  # zero has two signs, which are one key
        known = known.withColumn(key, F.col(key) + F.lit(0.0).cast(kind))
    rows = stage(known)
    cut, alone = step_cells(rows.withColumn("_key", F.col(key).cast("double")), "_key", cells)
    cut = cut.drop("_key")
    if kind not in ("double", "float", "int", "smallint", "tinyint"):  # several keys may be one double
        alone = [False] * len(alone)
    counted = cut.groupBy("_cell").agg(*[c.alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("_rows"),
                                       F.approx_count_distinct(key, 0.05).alias("_keys")).collect()
    histogram = {r["_cell"]: r for r in counted}
    places = sorted(histogram, reverse=descending)
    offsets: dict[str, list] = {}
    totals: dict[str, object] = {}
    for n in sums:
        ahead, held = [0] * len(alone), 0
        for c in places:
            ahead[c], held = held, held + histogram[c][n]
        offsets[n], totals[n] = ahead, held
    moving = [c for c in histogram if not alone[c]]
    many_rows_a_key = sum(histogram[c]["_rows"] for c in moving) > 4 * sum(histogram[c]["_keys"] for c in moving)
    is_alone = F.col("_cell").isin([c for c in histogram if alone[c]])
    light, heavy = cut.filter(~is_alone), cut.filter(is_alone)
    if many_rows_a_key:
        combined = light.groupBy("_cell", key).agg(*[c.alias(n) for n, c in sums.items()])
        steps = cell_steps(combined, key, {n: F.sum(n) for n in sums}, descending)
    else:
        steps = cell_steps(light, key, sums, descending)
    often = heavy.groupBy("_cell", key).agg(*[c.alias(n) for n, c in sums.items()]).withColumns(
        {n + BEFORE: F.lit(0) for n in sums})
    kinds = {n: steps.schema[n].dataType for n in sums}
    return steps.unionByName(often).select(
        key, *sums,
        *[(F.col(n + BEFORE) + F.get(literal_array(offsets[n], kinds[n].simpleString()), F.col("_cell"))).alias(n + BEFORE) for n in sums],
        *[F.lit(totals[n]).cast(kinds[n]).alias(n + TOTAL) for n in sums])
