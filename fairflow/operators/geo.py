"""Grid cells, shapes as cells, and points in shapes.

The grid halves longitude and latitude ``res`` times.  A cell is only ever a join key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Cells and edges closer than this (in degrees) are treated as touching, so that rounding
# can only ever cause an extra exact test, never a missed one.
TOUCH = 1e-9


def _column_of(lon: Column, res: int) -> Column:
    return F.floor((lon + 180.0) * float(2 ** res) / 360.0)


def _row_of(lat: Column, res: int) -> Column:
    return F.floor((lat + 90.0) * float(2 ** res) / 180.0)


def _lon_at(column: Column, res: int) -> Column:
    return column * (360.0 / 2 ** res) - 180.0


def _lat_at(row: Column, res: int) -> Column:
    return row * (180.0 / 2 ** res) - 90.0


def _cell(cx: Column, cy: Column, res: int) -> Column:
    return F.concat(F.lit(f"{res}:"), cx.cast("string"), F.lit(":"), cy.cast("string"))


def point_cell(df: DataFrame, lat: str, lon: str, res: int, out: str = "cell") -> DataFrame:
    """Add the cell of a point (NULL without coordinates); an existing column is kept as it is."""
    if out in df.columns:
        return df
    return df.withColumn(out, _cell(_column_of(F.col(lon), res), _row_of(F.col(lat), res), res))


def _points(ring: Column) -> Column:
    """``x y, x y, ...`` as an array of points."""
    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(F.get(xy, 0).cast("double").alias("x"), F.get(xy, 1).cast("double").alias("y"))

    return F.transform(F.split(ring, ","), point)


def _edges(wkt: Column) -> Column:
    """Edges of all rings of a POLYGON or MULTIPOLYGON text, as one array.

    Holes are rings like any other: a point is inside when it lies inside an odd number.
    """
    rings = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)

    def edges(points: Column, ring: Column) -> Column:
        n = F.size(points) - 1
        return F.transform(
            F.arrays_zip(F.slice(points, 1, n).alias("a"), F.slice(points, 2, n).alias("b")),
            lambda e, i: F.struct(
                ring.alias("ring"), i.alias("i"), e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"),
                e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(F.transform(rings, _points), edges))


def shape_edges(df: DataFrame, key: str | Sequence[str], wkt: str) -> DataFrame:
    """Edge table ``key, ring, i, x1, y1, x2, y2`` of a shape table."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, F.inline(_edges(F.col(wkt))))


def _crossing(edge, lat: Column) -> Column:
    """Longitude at which an edge meets a latitude; a flat edge has none."""
    return (edge["x2"] - edge["x1"]) * F.try_divide(lat - edge["y1"], edge["y2"] - edge["y1"]) + edge["x1"]


def _span(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(low, high))


def _center_cells(shapes: DataFrame, keys: list[str], res: int) -> DataFrame:
    """Scanline fill: the crossings of each grid row with the edges, in pairs, bound the cells
    whose centre is inside.  Work grows with edges and cells, not with their product."""
    edges = shapes.select(*keys, "_shape", F.inline("_edges"))
    edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    crossed = edges.filter(F.col("y1") != F.col("y2")).select(
        *keys, "_shape", "x1", "y1", "x2", "y2",
        _span(_row_of(low, res) - 1, _row_of(high, res) + 1).alias("cy"),
    ).withColumn("_lat", _lat_at(F.col("cy") + 0.5, res))
    hits = crossed.filter(
        (F.col("y1") > F.col("_lat")) != (F.col("y2") > F.col("_lat"))
    ).withColumn("_x", _crossing(edge, F.col("_lat")))
    scanline = Window.partitionBy(*keys, "_shape", "cy").orderBy("_x")
    runs = hits.withColumns({
        "_n": F.row_number().over(scanline), "_end": F.lead("_x").over(scanline),
    }).filter((F.col("_n") % 2 == 1) & (F.col("_end") > F.col("_x")))
    filled = runs.select(
        *keys, "cy", "_x", "_end",
        _span(_column_of(F.col("_x"), res) - 1, _column_of(F.col("_end"), res) + 1).alias("cx"),
    ).withColumn("_lon", _lon_at(F.col("cx") + 0.5, res))
    inside = (F.col("_lon") >= F.col("_x")) & (F.col("_lon") < F.col("_end"))
    return filled.filter(inside).select(*keys, _cell(F.col("cx"), F.col("cy"), res).alias("cell"))


def _with_extent(shapes: DataFrame) -> DataFrame:
    def ends(field: str) -> Column:
        return F.transform("_edges", lambda e: e[field])

    def extreme(pick, of, axis: str) -> Column:
        return pick(of(ends(f"{axis}1")), of(ends(f"{axis}2")))

    return shapes.withColumns({
        "_xmin": extreme(F.least, F.array_min, "x"), "_xmax": extreme(F.greatest, F.array_max, "x"),
        "_ymin": extreme(F.least, F.array_min, "y"), "_ymax": extreme(F.greatest, F.array_max, "y"),
    })


def _parsed(df: DataFrame, keys: list[str], wkt: str) -> DataFrame:
    return df.select(
        *keys, F.xxhash64(F.col(wkt)).alias("_shape"), _edges(F.col(wkt)).alias("_edges")
    ).filter(F.size("_edges") > 0)


def shape_cells(df: DataFrame, key: str | Sequence[str], wkt: str, res: int,
                mode: str = "center") -> DataFrame:
    """``key, cell`` pairs covering each shape.

    ``center`` takes the cells whose centre is inside, so disjoint shapes share no cell.
    ``bbox`` takes every cell that meets the shape's bounding box.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shapes = _parsed(df, keys, wkt)
    if mode == "center":
        return _center_cells(shapes, keys, res)
    if mode != "bbox":
        raise ValueError(f"unknown cover {mode!r}: use 'center' or 'bbox'")
    rows = _with_extent(shapes).select(
        *keys, "_xmin", "_xmax", _span(_row_of(F.col("_ymin"), res), _row_of(F.col("_ymax"), res)).alias("cy")
    )
    cells = rows.select(
        *keys, "cy", _span(_column_of(F.col("_xmin"), res), _column_of(F.col("_xmax"), res)).alias("cx")
    )
    return cells.select(*keys, _cell(F.col("cx"), F.col("cy"), res).alias("cell"))


def _cell_number(cx: Column, cy: Column) -> Column:
    """A cell of one resolution as a bigint, the key of an index."""
    return cy * F.lit(1 << 32) + cx


def _walked(edges: DataFrame, res: int) -> DataFrame:
    """Every edge once per grid row it touches, with the first and last column it meets there."""
    bottom, top = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.select("*", _span(_row_of(bottom - TOUCH, res), _row_of(top + TOUCH, res)).alias("cy")).withColumns({
        "_low": _lat_at(F.col("cy"), res) - TOUCH, "_high": _lat_at(F.col("cy") + 1, res) + TOUCH,
    })
    edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}

    def x_at(lat: Column, flat: str) -> Column:
        return F.coalesce(_crossing(edge, F.least(F.greatest(lat, bottom), top)), F.col(flat))

    return rows.withColumns({"_a": x_at(F.col("_low"), "x1"), "_b": x_at(F.col("_high"), "x2")}).withColumns({
        "_first": _column_of(F.least("_a", "_b") - TOUCH, res), "_last": _column_of(F.greatest("_a", "_b") + TOUCH, res),
    }).drop("_a", "_b")


def shape_cells_inside(df: DataFrame, key: str, wkt: str, res: int) -> tuple[DataFrame, DataFrame]:
    """The cells of a shape's border with what decides there, and the runs of cells wholly inside.

    Each edge is walked through the cells it meets, row by row.  A cell tests the edges that meet it.  Of the
    edges further right only what the ray's height decides is left: an edge crosses it if one of its ends
    lies above and the other does not, so an end above the row flips the cells to its left, and an end
    within the row cancels against that of the next edge, except in the cells that only one of the two
    meets; there the cell keeps its height.  The flips are a running count along the row.

    Work grows with the edges and the cells they meet.  Rings must be closed, as in any WKT.  Both results have
    ``key, cy``; border cells ``cx, base, edges, ends``, runs ``first, last``.
    """
    edges = _parsed(df.select(key, wkt).distinct(), [key], wkt).select(key, "_shape", F.inline("_edges"))
    walked = _walked(edges, res)
    place = [key, "_shape", "cy"]
    above = [F.col(y) > F.col("_high") for y in ("y1", "y2")]
    edge_type = "struct<x1:double,y1:double,x2:double,y2:double>"
    met = walked.filter(F.col("y1") != F.col("y2")).select(
        *place, _span(F.col("_first"), F.col("_last")).alias("cx"), F.col("_first"),
        F.struct("x1", "y1", "x2", "y2").alias("edge"), (above[0] != above[1]).alias("_flips"),
    ).select(*place, "cx", "edge", F.lit(None).cast("double").alias("end"),
             (F.col("_flips") & (F.col("cx") == F.col("_first"))).cast("int").alias("flip"))
    corners = walked.select(*place, "ring", "_low", "_high", "_first", F.explode(F.array(
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")),
        F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("_v"))
    corners = corners.filter(F.col("_v.y").between(F.col("_low"), F.col("_high")))
    starts = corners.groupBy(*place, "ring", F.col("_v.x").alias("x"), F.col("_v.y").alias("y")).agg(
        F.array_sort(F.collect_list("_first")).alias("_at"))
    between = F.flatten(F.transform(F.sequence(F.lit(1), F.floor(F.size("_at") / 2).cast("int")), lambda k: F.when(
        F.get("_at", 2 * k - 2) < F.get("_at", 2 * k - 1),
        F.sequence(F.get("_at", 2 * k - 2), F.get("_at", 2 * k - 1) - 1)).otherwise(F.array().cast("array<bigint>"))))
    ends = starts.filter(F.size("_at") > 1).select(
        *place, F.explode(between).alias("cx"), F.lit(None).cast(edge_type).alias("edge"), F.col("y").alias("end"), F.lit(0).alias("flip"))
    # Placed by grid row, so that cells and their running count need no exchange of their own.
    cells = met.unionByName(ends).repartition(*place).groupBy(*place, "cx").agg(
        F.collect_list("edge").alias("edges"), F.collect_list("end").alias("ends"), F.sum("flip").alias("flips"))
    leftwards = Window.partitionBy(*place).orderBy(F.col("cx").desc())
    counted = cells.withColumns({
        "_right": F.coalesce(F.sum("flips").over(leftwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_next": F.lead("cx").over(leftwards),
    })
    border = counted.select(key, "cy", "cx", (F.col("_right") % 2).cast("int").alias("base"), "edges", "ends")
    runs = counted.filter((F.col("_next") < F.col("cx") - 1) & ((F.col("_right") + F.col("flips")) % 2 == 1)).select(
        key, "cy", (F.col("_next") + 1).alias("first"), (F.col("cx") - 1).alias("last"))
    return border, runs


def shape_index(df: DataFrame, key: str, wkt: str, res: int) -> DataFrame:
    """One row per cell (a bigint) with what decides which shapes hold a point of that cell.

    ``shapes`` lists each shape near the cell with ``base`` (modulo 2, how often a ray to the right
    leaves or enters the shape beyond the cell), ``edges`` to test and ``ends``, heights above which one
    such crossing is gone.  A cell's list grows with the shapes that meet it: choose a
    resolution whose cells are smaller than the shapes.
    """
    border, runs = shape_cells_inside(df, key, wkt, res)
    kinds = {c: border.schema[c].dataType for c in ("edges", "ends")}
    inner = runs.select(key, "cy", _span(F.col("first"), F.col("last")).alias("cx"), F.lit(1).alias("base"),
                        *[F.array().cast(k).alias(c) for c, k in kinds.items()])
    decisive = border.filter((F.col("base") == 1) | (F.size("edges") > 0) | (F.size("ends") > 0))
    return decisive.unionByName(inner).groupBy(_cell_number(F.col("cx"), F.col("cy")).alias("cell")).agg(
        F.collect_list(F.struct(key, "base", "edges", "ends")).alias("shapes"))


def point_zone_join(points: DataFrame, lat: str, lon: str, cells: DataFrame, res: int,
                    key: str = "zone", out: str = "zone", cell: str = "cell") -> DataFrame:
    """Left-join points to the shapes that cover their cell.

    Approximate at borders; a cell of two shapes doubles its points, an uncovered point keeps
    a NULL.  ``cells`` comes from ``shape_cells``, staged through ``size_checked`` when derived
    in the same job.
    """
    covers = cells.select(F.col("cell").alias("_cell"), F.col(key).alias(out))
    encoded = point_cell(points, lat, lon, res, cell)
    return encoded.join(covers, encoded[cell] == covers["_cell"], "left").drop("_cell")


def point_in_polygon(points: DataFrame, lat: str, lon: str, index: DataFrame, res: int,
                     key: str = "zone", out: str = "zone") -> DataFrame:
    """Left-join points to the shapes that really contain them.

    A point meets at most one row of the index, its test runs inside that row, and nothing is
    grouped afterwards: the only exchange is the join's, or none when the index is broadcast.
    A point in several overlapping shapes yields several rows, a point in none a NULL.
    """
    px, py = F.col(lon), F.col(lat)

    def holds(shape: Column) -> Column:
        def crosses(e: Column) -> Column:
            return ((e["y1"] > py) != (e["y2"] > py)) & (px < _crossing(e, py))

        hits = F.size(F.filter(shape["edges"], crosses)) + F.size(F.filter(shape["ends"], lambda y: y > py))
        return (shape["base"] + hits) % 2 == 1

    named = index.select(F.col("cell").alias("_cell"), F.col("shapes").alias("_shapes"))
    encoded = points.withColumn("_point_cell", _cell_number(_column_of(px, res), _row_of(py, res)))
    joined = encoded.join(named, F.col("_point_cell") == F.col("_cell"), "left")
    matching = F.transform(F.filter("_shapes", holds), lambda s: s[key])
    return joined.select(*points.columns, F.explode_outer(matching).alias(out))


def ride_zones(rides: DataFrame, cells: DataFrame, res: int, key: str = "zone",
               exact: bool = False) -> DataFrame:
    """Zones of both ends of a ride.  ``cells`` is a cover, or an index when ``exact``."""
    for end in ("pickup", "dropoff"):
        place = f"{end}_latitude", f"{end}_longitude"
        rides = rides.drop(f"{end}_zone")
        if exact:
            rides = point_in_polygon(rides, *place, cells, res, key, f"{end}_zone")
        else:
            rides = point_zone_join(rides, *place, cells, res, key, f"{end}_zone", f"{end}_cell")
    return rides


def cells_by_resolution(df: DataFrame, key: str, wkt: str, resolutions: Sequence[int],
                        mode: str = "center") -> DataFrame:
    """Number of cells per shape at several resolutions."""
    counted = [
        shape_cells(df, key, wkt, res, mode).groupBy(key)
        .agg(F.count(F.lit(1)).alias("cells")).withColumn("res", F.lit(res))
        for res in resolutions
    ]
    return reduce(DataFrame.unionByName, counted)


def shape_bounds(edges: DataFrame, key: str | None = None, pad: float = 0.05) -> DataFrame:
    """Padded extent of each shape, or of all shapes together."""
    return edges.groupBy(*([] if key is None else [key])).agg(
        (F.min(F.least("x1", "x2")) - pad).alias("min_x"),
        (F.min(F.least("y1", "y2")) - pad).alias("min_y"),
        (F.max(F.greatest("x1", "x2")) + pad).alias("max_x"),
        (F.max(F.greatest("y1", "y2")) + pad).alias("max_y"),
    )
