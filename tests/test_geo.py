"""Cells and shapes against brute force in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from fairflow.operators import geo

SHAPES = {
    "square": "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))",
    "ring": "POLYGON ((20 0, 40 0, 40 20, 20 20, 20 0), (25 5, 35 5, 35 15, 25 15, 25 5))",
    "pair": "MULTIPOLYGON (((50 0, 60 1, 55 9, 50 0)), ((-30.5 -20.25, -10 -22, -12 -5, -28 -3, -30.5 -20.25)))",
    "dart": "POLYGON ((0 30, 20 50, 40 30, 20 36, 0 30))",
    "comb": "POLYGON ((-40 -60, 60 -60, 60 -30, 55 -58, 50 -31, 45 -57.5, 40 -30, 35 -59, 30 -30, 0 -30, 0 -45, 20 -45,"
            " 20 -40, 5 -40, 5 -35, 25 -35, 25 -50, -20 -50, -20 -30, -40 -30, -40 -60))",
    "tall": "POLYGON ((64 -80, 65 -80, 65.5 3.1, 64.25 3.1, 64.25 3.2, 66 3.2, 66 80, 64.5 80, 64 -80))",
    "antimeridian": "POLYGON ((170 60, 180 60, 180 90, 170 90, 170 60))",
}


def edges_of(wkt):
    import re

    for ring in re.findall(r"\(([^()]+)\)", wkt):
        points = [tuple(map(float, p.split())) for p in ring.split(",")]
        yield from zip(points, points[1:])


def inside(wkt, x, y):
    hits = 0
    for (x1, y1), (x2, y2) in edges_of(wkt):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hits += 1
    return hits % 2 == 1


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(list(SHAPES.items()), "zone string, wkt string")


def centre(cell):
    res, cx, cy = map(int, cell.split(":"))
    return (cx + 0.5) * 360 / 2**res - 180, (cy + 0.5) * 180 / 2**res - 90


def test_edges(shapes):
    got = geo.shape_edges(shapes, "zone", "wkt").groupBy("zone").count().collect()
    assert {r["zone"]: r["count"] for r in got} == {k: len(list(edges_of(v))) for k, v in SHAPES.items()}


@pytest.mark.parametrize("res", [5, 8])
def test_center_cover_equals_brute_force(shapes, res):
    got = {(r["zone"], r["cell"]) for r in geo.shape_cells(shapes, "zone", "wkt", res).collect()}
    want = {
        (zone, f"{res}:{cx}:{cy}") for zone, wkt in SHAPES.items()
        for cx in range(2**res) for cy in range(2**res) if inside(wkt, *centre(f"{res}:{cx}:{cy}"))
    }
    assert got == want


def test_bbox_cover_contains_the_center_cover(shapes):
    center = geo.shape_cells(shapes, "zone", "wkt", 7)
    bbox = geo.shape_cells(shapes, "zone", "wkt", 7, "bbox")
    assert center.join(bbox, ["zone", "cell"], "left_anti").count() == 0
    assert bbox.count() > center.count()


def test_disjoint_shapes_share_no_cell(shapes):
    cells = geo.shape_cells(shapes, "zone", "wkt", 8)
    assert cells.count() == cells.select("cell").distinct().count()


def test_unknown_cover(shapes):
    with pytest.raises(ValueError):
        geo.shape_cells(shapes, "zone", "wkt", 5, "hexagon")


@pytest.mark.parametrize("res", [0, 4, 9])
def test_point_in_polygon_equals_brute_force(spark, shapes, res):
    """Random points, and points on borders and corners, at any cell size."""
    rng = random.Random(res)
    points = [(rng.uniform(-40, 70), rng.uniform(-30, 60)) for _ in range(1500)]
    points += [(x, y) for x in (0, 5, 10, 20, 25, 30, 35, 40) for y in (0, 5, 10, 15, 20, 30, 36)]
    points += [(rng.uniform(-45, 70), rng.uniform(-62, -28)) for _ in range(800)]
    points += [(rng.uniform(63, 67), rng.uniform(-5, 8)) for _ in range(500)]
    points += [(float(x), float(y)) for x in (-40, -20, 0, 5, 20, 25, 55, 60) for y in (-60, -50, -45, -40, -35, -30)]
    points += [(180.0, 90.0), (175.0, 75.0), (-180.0, -90.0)]
    df = spark.createDataFrame([(i, x, float(y)) if isinstance(x, float) else (i, float(x), float(y))
                                for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    index = geo.shape_index(shapes, "zone", "wkt", res)
    got = {(r["id"], r["zone"]) for r in geo.point_in_polygon(df, "lat", "lon", index, res).collect()}
    want = set()
    for i, (x, y) in enumerate(points):
        zones = [z for z, wkt in SHAPES.items() if inside(wkt, x, y)]
        want |= {(i, z) for z in zones} or {(i, None)}
    assert got == want


def test_points_without_coordinates_or_shape_are_kept(spark, shapes):
    df = spark.createDataFrame([(1, None, None), (2, -100.0, 0.0), (3, 5.0, 5.0)], "id int, lon double, lat double")
    index = geo.shape_index(shapes, "zone", "wkt", 6)
    exact = geo.point_in_polygon(df, "lat", "lon", index, 6)
    by_cell = geo.point_zone_join(df, "lat", "lon", geo.shape_cells(shapes, "zone", "wkt", 6), 6)
    for got in (exact, by_cell):
        assert {(r["id"], r["zone"]) for r in got.collect()} == {(1, None), (2, None), (3, "square")}


def test_existing_cell_column_is_kept(spark):
    df = spark.createDataFrame([("mine", 1.0, 2.0)], "cell string, lat double, lon double")
    assert geo.point_cell(df, "lat", "lon", 5).first()["cell"] == "mine"


def test_a_cell_of_two_shapes_doubles_its_points(spark):
    cells = spark.createDataFrame([("a", "3:4:4"), ("b", "3:4:4")], "zone string, cell string")
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id int, lat double, lon double")
    assert geo.point_zone_join(df, "lat", "lon", cells, 3).count() == 2


def test_hot_cell_without_broadcast(spark, shapes):
    """All points in one cell, joined by shuffle: the same result as with a broadcast."""
    points = spark.range(5000).select("id", F.lit(5.0).alias("lon"), (F.col("id") % 12).cast("double").alias("lat"))
    index = geo.shape_index(shapes, "zone", "wkt", 2)
    joined = geo.point_in_polygon(points, "lat", "lon", index.hint("merge"), 2)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.groupBy("zone").count().collect() and joined.count() == 5000
    assert joined.filter("zone = 'square'").count() == points.filter("lat < 10").count()


def spiky(n, seed=0):
    """A closed ring of n edges around the origin, its radius jumping."""
    import math

    rng = random.Random(seed)
    ring = [(math.cos(2 * math.pi * k / n) * (r := rng.uniform(5, 40)), math.sin(2 * math.pi * k / n) * r) for k in range(n)]
    return "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring + ring[:1]) + "))"


@pytest.mark.parametrize("res", [3, 6, 8])
def test_a_jagged_shape_equals_brute_force(spark, res):
    wkt = spiky(301)
    ring = [p for p in wkt[10:-2].split(", ")]
    rng = random.Random(res)
    points = [(rng.uniform(-41, 41), rng.uniform(-41, 41)) for _ in range(1500)]
    points += [tuple(map(float, p.split())) for p in ring[:100]]
    points += [(x + 3.0, y) for x, y in points[-100:]]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lon double, lat double")
    shape = spark.createDataFrame([("a", wkt), ("a", wkt)], "zone string, wkt string")  # a repeated row is one shape
    got = geo.point_in_polygon(df, "lat", "lon", geo.shape_index(shape, "zone", "wkt", res), res).collect()
    assert {r["id"] for r in got if r["zone"]} == {i for i, p in enumerate(points) if inside(wkt, *p)}


def test_index_of_a_hundred_thousand_edges_grows_with_edges_and_cells(spark):
    """Each cell lists the edges that meet it, not all of its row."""
    n, res = 100_000, 9
    shape = spark.createDataFrame([("a", spiky(n))], "zone string, wkt string")
    border, runs = geo.shape_cells_inside(shape, "zone", "wkt", res)
    listed, cells, heights = border.select(F.sum(F.size("edges")), F.count("*"), F.sum(F.size("ends"))).first()
    row = 360 / 2 ** res
    # An edge of mean length below 18 degrees meets at most its columns and rows, and one more of each.
    assert listed < n * (2 * 18 / row + 3) and heights < listed
    assert cells < (90 / row) * (180 / row) and runs.count() < cells


def test_interior_is_kept_as_runs(spark, shapes):
    border, runs = geo.shape_cells_inside(shapes.filter("zone = 'square'"), "zone", "wkt", 10)
    one = runs.filter("last - first > 20")
    assert one.count() >= 50 and runs.count() <= 60
    assert border.filter("cy = 540").count() <= 4


def test_bounds(shapes):
    edges = geo.shape_edges(shapes.filter("zone = 'dart'"), "zone", "wkt")
    row = geo.shape_bounds(edges).first()
    assert tuple(row) == pytest.approx((-0.05, 29.95, 40.05, 50.05))
