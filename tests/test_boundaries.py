"""Polygons with holes on grids, against point and box tests of every cell in plain Python and numpy."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.operators import boundaries
from isohyet.operators.boundaries import Grid


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def crosses(rings, west, south, east, north):
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            t0, t1 = 0.0, 1.0
            for p, d, lo, hi in ((x1, x2 - x1, west, east), (y1, y2 - y1, south, north)):
                if d == 0:
                    t0 = 2.0 if not lo <= p <= hi else t0
                else:
                    t0, t1 = max(t0, min((lo - p) / d, (hi - p) / d)), min(t1, max((lo - p) / d, (hi - p) / d))
            if t0 <= t1:
                return True
    return False


def star(draw, x, y, size, n):
    """A ring with eighths as coordinates, so that sides meet cells' sides and centres exactly, too."""
    turn = sorted(draw.random() * 2 * math.pi for _ in range(n))
    return [(round((x + draw.uniform(0.3, 1) * size * math.cos(t)) * 8) / 8, round((y + draw.uniform(0.3, 1) * size * math.sin(t)) * 8) / 8) for t in turn]


@pytest.mark.parametrize("seed", range(3))
def test_cells_equal_a_test_of_each(spark, seed):
    draw = random.Random(seed)
    polygons = [(f"p{k}", [star(draw, *(c := (draw.uniform(3, 9), draw.uniform(-9, -3))), draw.uniform(0.2, 4), draw.randint(3, 9)), star(draw, *c, 0.7, 4)]) for k in range(5)]
    polygons.append(("box", [[(4, -6), (5, -6), (5, -5), (4, -5)]]))
    grid = Grid(0.25, south=-10.0, west=2.0)
    found = {tuple(r) for r in boundaries.touched_cells(boundaries.edges(spark, polygons), grid).collect()}
    want = set()
    for k, (name, rings) in enumerate(polygons):
        for r in range(-30, 80):
            for c in range(-30, 80):
                y, x = -10 + r * 0.25, 2 + c * 0.25
                if inside(rings, x, y) or crosses(rings, x - 0.125, y - 0.125, x + 0.125, y + 0.125):
                    want.add((f"{k}:{name}", r, c))
    assert found == want


def test_a_hole_is_out_and_overlaps_join(spark):
    big, hole = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)]
    text = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "ring"}, "geometry": {"type": "Polygon", "coordinates": [big, hole]}},
        {"type": "Feature", "id": 7, "properties": None, "geometry": {"type": "MultiPolygon", "coordinates": [[[(4.6, 4.6), (5.4, 4.6), (5.4, 5.4), (4.6, 5.4)]], [[(8.7, 8.7), (9.3, 8.7), (9.3, 9.3)]]]}},
    ]})
    polygons = boundaries.read_polygons(text)
    assert [(n, len(r)) for n, r in polygons] == [("ring", 2), ("7", 1), ("7", 1)]
    cells = spark.range(12 * 12).select("id", (F.floor(F.col("id") / 12) - 0.0).alias("lat"), (F.col("id") % 12 - 0.0).alias("lon"), F.lit("x").alias("polygon_name"))
    own = boundaries.members(cells, boundaries.edges(spark, polygons), Grid(1.0, 0.0, 0.0))
    by = {}
    for r in own.collect():
        by.setdefault((r.lat, r.lon), set()).add(r.polygon)
    assert by[(1, 1)] == {"0:ring"} and (4, 4) not in by and by[(5, 5)] == {"1:7"} and by[(9, 9)] == {"0:ring", "2:7"} and (11, 11) not in by
    marked = {(r.lat, r.lon): r.in_region for r in boundaries.mark_region(cells, boundaries.edges(spark, polygons), Grid(1.0, 0.0, 0.0)).collect()}
    assert len(marked) == 144 and {k for k, v in marked.items() if v} == set(by)


def test_kml_has_names_and_holes():
    text = """<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>lake</name><MultiGeometry><Polygon>
    <outerBoundaryIs><LinearRing><coordinates>0,0,5 4,0 4,4 0,4 0,0</coordinates></LinearRing></outerBoundaryIs>
    <innerBoundaryIs><LinearRing><coordinates>1,1 2,1 2,2 1,1</coordinates></LinearRing></innerBoundaryIs></Polygon></MultiGeometry></Placemark>
    <Placemark><Polygon><outerBoundaryIs><LinearRing><coordinates>9,9 8,9 8,8</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>"""
    (one, rings), (two, open_ring) = boundaries.read_polygons(text)
    assert (one, len(rings), rings[1][1], two) == ("lake", 2, (2.0, 1.0), "")
    assert len(list(boundaries.edge_rows([(two, open_ring)]))) == 3  # closed
    with pytest.raises(ValueError):
        boundaries.read_polygons("<kml/>")


def test_a_million_cells(spark):
    n = 1000
    polygons = [("disc", [[(500 + 400 * math.cos(t), 500 + 400 * math.sin(t)) for t in np.linspace(0, 2 * math.pi, 400, endpoint=False)], [(450, 450), (550, 450), (550, 550), (450, 550)]])]
    cells = spark.range(n * n).select("id", (F.floor(F.col("id") / n) * 1.0).alias("lat"), (F.col("id") % n * 1.0).alias("lon"))
    found = np.array([r.id for r in boundaries.mark_region(cells, boundaries.edges(spark, polygons), Grid(1.0, 0.0, 0.0)).where("in_region").select("id").collect()])
    y, x = np.divmod(np.arange(n * n), n)
    away = np.hypot(x - 500, y - 500)
    sure = (away < 398) & ~((abs(x - 500) <= 49) & (abs(y - 500) <= 49))
    assert np.isin(np.flatnonzero(sure), found).all() and (away[found] < 402).all() and not ((abs(x[found] - 500) < 49) & (abs(y[found] - 500) < 49)).any()


def test_no_polygon_and_no_cell(spark):
    none = spark.createDataFrame([], boundaries.EDGES)
    cells = spark.range(3).select("id", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    assert not any(r.in_region for r in boundaries.mark_region(cells, none, Grid(1.0)).collect())
    assert boundaries.members(cells.where("false"), boundaries.edges(spark, [("a", [[(0, 0), (1, 1), (1, 0)]])]), Grid(1.0)).count() == 0
