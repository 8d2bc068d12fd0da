"""Points, cells and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import demographics, geo
from ..session import size_checked
from ..sources.fixtures import source
from .disparity import FACTORS
from .registry import query, r, rounded, step, using

RES = 7

step("rings", r"""
SELECT zone, generate_subscripts(rings, 1) AS ring, unnest(rings) AS points
FROM (SELECT zone, regexp_extract_all(the_geom, '\(([^()]+)\)', 1) AS rings FROM zones)""", "zones")
step("edge", """
SELECT zone, ring - 1 AS ring, i - 1 AS i,
 split_part(trim(pts[i]), ' ', 1)::DOUBLE AS x1, split_part(trim(pts[i]), ' ', 2)::DOUBLE AS y1,
 split_part(trim(pts[i + 1]), ' ', 1)::DOUBLE AS x2, split_part(trim(pts[i + 1]), ' ', 2)::DOUBLE AS y2
FROM (SELECT zone, ring, pts, unnest(range(1, len(pts))) AS i
 FROM (SELECT zone, ring, string_split(points, ',') AS pts FROM rings))""", "rings")


def cell_sql(lon: str, lat: str, res: int = RES) -> str:
    return (f"'{res}:' || floor(({lon} + 180e0) * {2 ** res}e0 / 360e0)::BIGINT || ':'"
            f" || floor(({lat} + 90e0) * {2 ** res}e0 / 180e0)::BIGINT")


def grid_sql(res: int) -> str:
    """Every cell of the world with its centre."""
    n = 2 ** res
    return f"""
SELECT '{res}:' || cx || ':' || cy AS cell, (cx + 0.5e0) * (360e0 / {n}) - 180e0 AS x, (cy + 0.5e0) * (180e0 / {n}) - 90e0 AS y
FROM (SELECT unnest(range({n})) AS cx) a CROSS JOIN (SELECT unnest(range({n})) AS cy) b"""


INSIDE = "count(*) FILTER ((y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1"


def center_sql(res: int) -> str:
    """Brute force: every cell centre near a shape against every edge."""
    return f"""
SELECT e.zone, cell FROM grid{res} g JOIN edge e ON g.x BETWEEN 0 AND 100 AND g.y BETWEEN 0 AND 80
GROUP BY e.zone, cell, x, y HAVING {INSIDE}"""


for _res in (6, RES, 8):
    step(f"grid{_res}", grid_sql(_res))
    step(f"center{_res}", center_sql(_res), f"grid{_res}", "edge")


def cover(spark, sf_dir, res=RES, mode="center"):
    return geo.shape_cells(source(spark, sf_dir, "zones"), "zone", "the_geom", res, mode)


def index(spark, sf_dir, res=RES):
    return geo.shape_index(source(spark, sf_dir, "zones"), "zone", "the_geom", res)


@query("point_cell", using("rides") + f"""
SELECT ride_id, {cell_sql('pickup_longitude', 'pickup_latitude')} AS pickup_cell FROM rides""")
def _point_cell(spark, sf_dir):
    rides = source(spark, sf_dir, "rides")
    return geo.point_cell(rides, "pickup_latitude", "pickup_longitude", RES, "pickup_cell").select(
        "ride_id", "pickup_cell"
    )


@query("shape_edges", using("edge") + "SELECT zone, ring::INT AS ring, i::INT AS i, x1, y1, x2, y2 FROM edge")
def _shape_edges(spark, sf_dir):
    return geo.shape_edges(source(spark, sf_dir, "zones"), "zone", "the_geom")


query("shape_cells", using(f"center{RES}") + f"SELECT zone, cell FROM center{RES}")(cover)


@query("shape_cells_bbox", using(f"grid{RES}", "edge") + f"""
SELECT zone, cell FROM grid{RES} g JOIN (SELECT zone, min(x1) AS a, max(x1) AS b, min(y1) AS c, max(y1) AS d FROM edge GROUP BY 1)
 ON x BETWEEN a - {180 / 2 ** RES}e0 AND b + {180 / 2 ** RES}e0 AND y BETWEEN c - {90 / 2 ** RES}e0 AND d + {90 / 2 ** RES}e0""")
def _shape_cells_bbox(spark, sf_dir):
    return cover(spark, sf_dir, mode="bbox")


POINTS = ["ride_id", "pickup_latitude", "pickup_longitude"]


@query("point_zone_join", using("rides", f"center{RES}") + f"""
SELECT ride_id, r.cell, zone FROM (SELECT *, {cell_sql('pickup_longitude', 'pickup_latitude')} AS cell FROM rides) r
LEFT JOIN center{RES} c ON r.cell = c.cell""")
def _point_zone_join(spark, sf_dir):
    rides = source(spark, sf_dir, "rides").select(*POINTS)
    cells = size_checked(cover(spark, sf_dir))
    joined = geo.point_zone_join(rides, "pickup_latitude", "pickup_longitude", cells, RES)
    return joined.select("ride_id", "cell", "zone")


step("inside", f"""
SELECT ride_id, e.zone FROM (SELECT ride_id, pickup_longitude AS x, pickup_latitude AS y FROM rides) JOIN edge e ON true
GROUP BY ride_id, e.zone, x, y HAVING {INSIDE}""", "rides", "edge")


@query("point_in_polygon", using("inside") + """
SELECT r.ride_id, zone FROM rides r LEFT JOIN inside i ON r.ride_id = i.ride_id""")
def _point_in_polygon(spark, sf_dir):
    rides = source(spark, sf_dir, "rides").select(*POINTS)
    shapes = size_checked(index(spark, sf_dir))
    joined = geo.point_in_polygon(rides, "pickup_latitude", "pickup_longitude", shapes, RES)
    return joined.select("ride_id", "zone")


def _ends(spark, sf_dir):
    return source(spark, sf_dir, "rides").select(
        "ride_id", *[f"{end}_{axis}" for end in ("pickup", "dropoff") for axis in ("latitude", "longitude")]
    )


@query("ride_zones", using("rides", f"center{RES}") + f"""
SELECT ride_id, r.pickup_cell, p.zone AS pickup_zone, r.dropoff_cell, d.zone AS dropoff_zone
FROM (SELECT ride_id, {cell_sql('pickup_longitude', 'pickup_latitude')} AS pickup_cell,
 {cell_sql('dropoff_longitude', 'dropoff_latitude')} AS dropoff_cell FROM rides) r
LEFT JOIN center{RES} p ON r.pickup_cell = p.cell LEFT JOIN center{RES} d ON r.dropoff_cell = d.cell""")
def _ride_zones(spark, sf_dir):
    zoned = geo.ride_zones(_ends(spark, sf_dir), size_checked(cover(spark, sf_dir)), RES)
    return zoned.select("ride_id", "pickup_cell", "pickup_zone", "dropoff_cell", "dropoff_zone")


step("inside_dropoff", f"""
SELECT ride_id, e.zone FROM (SELECT ride_id, dropoff_longitude AS x, dropoff_latitude AS y FROM rides) JOIN edge e ON true
GROUP BY ride_id, e.zone, x, y HAVING {INSIDE}""", "rides", "edge")


@query("ride_zones_exact", using("inside", "inside_dropoff") + """
SELECT r.ride_id, p.zone AS pickup_zone, d.zone AS dropoff_zone FROM rides r
LEFT JOIN inside p ON r.ride_id = p.ride_id LEFT JOIN inside_dropoff d ON r.ride_id = d.ride_id""")
def _ride_zones_exact(spark, sf_dir):
    zoned = geo.ride_zones(_ends(spark, sf_dir), size_checked(index(spark, sf_dir)), RES, exact=True)
    return zoned.select("ride_id", "pickup_zone", "dropoff_zone")


@query("cells_by_resolution", using("center6", f"center{RES}", "center8") + " UNION ALL ".join(
    f"SELECT zone, count(*) AS cells, {n} AS res FROM center{n} GROUP BY zone" for n in (6, RES, 8)))
def _cells_by_resolution(spark, sf_dir):
    return geo.cells_by_resolution(source(spark, sf_dir, "zones"), "zone", "the_geom", [6, RES, 8])


@query("shape_bounds", using("edge") + f"""
SELECT zone, {r('min(x1) - 0.05', 6, 'min_x')}, {r('min(y1) - 0.05', 6, 'min_y')},
 {r('max(x1) + 0.05', 6, 'max_x')}, {r('max(y1) + 0.05', 6, 'max_y')} FROM edge GROUP BY zone""")
def _shape_bounds(spark, sf_dir):
    edges = geo.shape_edges(source(spark, sf_dir, "zones"), "zone", "the_geom")
    return rounded(geo.shape_bounds(edges, "zone"), min_x=6, min_y=6, max_x=6, max_y=6)


@query("zone_ride_counts", using("inside") + f"""
SELECT z.zone, count, {r('log10(count)', 8, 'count_log10')}, the_geom AS geometry
FROM (SELECT zone, count(*) AS count FROM inside GROUP BY 1) c JOIN zones z ON c.zone = z.zone""")
def _zone_ride_counts(spark, sf_dir):
    """Rides per containing zone with the zone's shape; rides outside drop out."""
    rides = source(spark, sf_dir, "rides").select(*POINTS)
    zones = source(spark, sf_dir, "zones")
    shapes = size_checked(index(spark, sf_dir))
    zoned = geo.point_in_polygon(rides, "pickup_latitude", "pickup_longitude", shapes, RES)
    counted = zoned.groupBy("zone").agg(F.count("zone").alias("count"))
    joined = counted.join(zones.select("zone", F.col("the_geom").alias("geometry")), "zone")
    return rounded(joined.withColumn("count_log10", F.log10("count")), count_log10=8)


step("home", f"""
SELECT person_id, e.zone FROM (SELECT person_id, longitude AS x, latitude AS y FROM persons) JOIN edge e ON true
GROUP BY person_id, e.zone, x, y HAVING {INSIDE}""", "persons", "edge")


def located_persons(spark, sf_dir):
    """Persons with the zone they live in and its borough; those outside all zones and the
    coordinates themselves are dropped."""
    persons = source(spark, sf_dir, "persons").drop("zone", "borough")
    shapes = size_checked(index(spark, sf_dir))
    located = geo.point_in_polygon(persons, "latitude", "longitude", shapes, RES)
    return demographics.person_zone_borough(located, source(spark, sf_dir, "zones"), ["longitude", "latitude"])


query("located_persons", using("home", "zones") + """
SELECT p.* EXCLUDE (zone, borough, longitude, latitude), z.zone, z.borough FROM persons p
JOIN home h ON p.person_id = h.person_id JOIN zones z ON h.zone = z.zone""")(located_persons)


@query("located_factor_counts", using("home") + " UNION ALL ".join(
    f"SELECT h.zone, {f} AS value, count({f}) AS count, '{f}' AS factor FROM persons p JOIN home h"
    f" ON p.person_id = h.person_id GROUP BY h.zone, {f}" for f in FACTORS))
def _located_factor_counts(spark, sf_dir):
    return demographics.factor_counts(located_persons(spark, sf_dir), ["zone"], FACTORS)
