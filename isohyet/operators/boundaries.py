"""Boundaries of many polygons with holes, against grids of any size.

A boundary is a table of edges. A grid is an index: the edges that reach a row of cells are joined to that row, where
they cross its middle line (even-odd: what lies between a crossing and the next is inside) and where they run through
its boxes. Both give ranges of columns, so the work grows with the cells near or inside the polygons and no cell is
tested against all edges. All of it is Column expressions.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Ring = Sequence[tuple[float, float]]
EDGES = "polygon string, x1 double, y1 double, x2 double, y2 double"


@dataclass(frozen=True)
class Grid:
    """Cells are squares of ``step`` degrees around (south + row * step, west + col * step)."""

    step: float
    south: float = -90.0
    west: float = -180.0

    def lat(self, row) -> Column:
        return F.lit(self.south) + row * F.lit(self.step)

    def lon(self, col) -> Column:
        return F.lit(self.west) + col * F.lit(self.step)

    def row(self, lat) -> Column:
        return F.round((lat - self.south) / self.step).cast("long")

    def col(self, lon) -> Column:
        return F.round((lon - self.west) / self.step).cast("long")


# --- reading ------------------------------------------------------------------------------------------


def _points(text: str | None) -> list[tuple[float, float]]:
    return [(float(p.split(",")[0]), float(p.split(",")[1])) for p in (text or "").split()]


def _kml_polygons(text: str) -> list[tuple[str, list[Ring]]]:
    local = lambda node: node.tag.rpartition("}")[2]
    found = []

    def walk(node, name):
        if local(node) == "Placemark":
            name = next((n.text or "" for n in node if local(n) == "name"), "")
        if local(node) == "Polygon":
            lines = [_points(c.text) for side in node if local(side) in ("outerBoundaryIs", "innerBoundaryIs") for c in side.iter() if local(c) == "coordinates"]
            found.append((name, lines))
        else:
            for child in node:
                walk(child, name)

    walk(ET.fromstring(text), "")
    return found


def _geojson_polygons(value: dict, name: str = "") -> list[tuple[str, list[Ring]]]:
    kind = value.get("type")
    if kind == "FeatureCollection":
        return [p for f in value["features"] for p in _geojson_polygons(f)]
    if kind == "Feature":
        own = (value.get("properties") or {}).get("name") or value.get("id") or ""
        return _geojson_polygons(value.get("geometry") or {}, str(own))
    if kind == "GeometryCollection":
        return [p for g in value["geometries"] for p in _geojson_polygons(g, name)]
    shapes = {"Polygon": [value.get("coordinates")], "MultiPolygon": value.get("coordinates")}.get(kind, [])
    return [(name, [[(float(p[0]), float(p[1])) for p in ring] for ring in shape]) for shape in shapes]


def read_polygons(text: str) -> list[tuple[str, list[Ring]]]:
    """(name, rings) of each polygon of a KML or GeoJSON document, holes included; ValueError if there is none.

    Parts of one name, as of a multi-polygon, stay apart here. Names come from a placemark's or feature's name, else
    its id, else ''.
    """
    found = _geojson_polygons(json.loads(text)) if text.lstrip().startswith("{") else _kml_polygons(text)
    if not any(rings for _, rings in found):
        raise ValueError("the boundary has no polygon")
    return found


def edge_rows(polygons: Iterable[tuple[str, Sequence[Ring]]]) -> Iterable[tuple[str, float, float, float, float]]:
    """Edges of all rings; an open ring is closed. Parts are numbered, so that holes count in their own polygon alone."""
    for k, (name, rings) in enumerate(polygons):
        for ring in rings:
            points = [*ring, ring[0]] if ring and tuple(ring[0]) != tuple(ring[-1]) else list(ring)
            for (x1, y1), (x2, y2) in zip(points, points[1:], strict=False):
                yield f"{k}:{name}", float(x1), float(y1), float(x2), float(y2)


def edges(spark: SparkSession, polygons: Iterable[tuple[str, Sequence[Ring]]]) -> DataFrame:
    """EDGES of polygons; ``polygon`` is 'number:name'."""
    return spark.createDataFrame(list(edge_rows(polygons)), EDGES)


# --- grid index ---------------------------------------------------------------------------------------


def crossing(y: Column) -> Column:
    """Longitude at which the edge (x1, y1, x2, y2) crosses the latitude ``y``."""
    return (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")


def spans(y: Column) -> Column:
    """Does the edge cross the latitude? An end on it counts as below, so a corner counts once."""
    return (F.col("y1") > y) != (F.col("y2") > y)


def meets(south: Column, north: Column, west: Column, east: Column) -> Column:
    """Does the edge have a point in the box, its sides included? Clips the edge's parameter by the four sides."""

    def limits(a: str, b: str, lo: Column, hi: Column) -> tuple[Column, Column, Column]:
        d = F.col(b) - F.col(a)
        t1, t2 = (lo - F.col(a)) / d, (hi - F.col(a)) / d
        flat = d == 0
        return F.when(flat, 0.0).otherwise(F.least(t1, t2)), F.when(flat, 1.0).otherwise(F.greatest(t1, t2)), ~flat | F.col(a).between(lo, hi)

    x_in, x_out, x_ok = limits("x1", "x2", west, east)
    y_in, y_out, y_ok = limits("y1", "y2", south, north)
    return x_ok & y_ok & (F.greatest(F.lit(0.0), x_in, y_in) <= F.least(F.lit(1.0), x_out, y_out))


def filled(edges_: DataFrame, grid: Grid) -> DataFrame:
    """(polygon, row, col) of the cells whose centre is inside, by scan lines: each row's crossings in order, paired."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges_.where("y1 <> y2").withColumn("row", F.explode(F.sequence(grid.row(low) - 1, grid.row(high) + 1)))
    rows = rows.where(spans(grid.lat(F.col("row"))))
    lines = rows.select("polygon", "row", crossing(grid.lat(F.col("row"))).alias("x")).groupBy("polygon", "row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("xs"), F.lit(2)), lambda k: F.struct(F.element_at("xs", k).alias("a"), F.element_at("xs", k + 1).alias("b")))
    runs = lines.select("polygon", "row", F.explode(pairs).alias("run")).select("polygon", "row", "run.*")
    cells = runs.withColumn("col", F.explode(F.sequence(grid.col(F.col("a")) - 1, grid.col(F.col("b")) + 1)))
    x = grid.lon(F.col("col"))
    return cells.where((x >= F.col("a")) & (x < F.col("b"))).select("polygon", "row", "col")


def covered(edges_: DataFrame, grid: Grid) -> DataFrame:
    """(polygon, row, col) of the cells that an edge touches; a cell may come more than once."""
    half = grid.step / 2
    rows = edges_.withColumn("row", F.explode(F.sequence(grid.row(F.least("y1", "y2")) - 1, grid.row(F.greatest("y1", "y2")) + 1)))
    y = grid.lat(F.col("row"))
    # the part of the edge within the row, a little widened; the exact test follows
    low, high = F.greatest(F.least("y1", "y2"), y - 2 * half), F.least(F.greatest("y1", "y2"), y + 2 * half)
    left = F.when(F.col("y1") == F.col("y2"), F.least("x1", "x2")).otherwise(F.least(crossing(low), crossing(high)))
    right = F.when(F.col("y1") == F.col("y2"), F.greatest("x1", "x2")).otherwise(F.greatest(crossing(low), crossing(high)))
    cells = rows.where(low <= high).withColumn("col", F.explode(F.sequence(grid.col(left) - 1, grid.col(right) + 1)))
    x = grid.lon(F.col("col"))
    return cells.where(meets(y - half, y + half, x - half, x + half)).select("polygon", "row", "col")


def touched_cells(edges_: DataFrame, grid: Grid) -> DataFrame:
    """(polygon, row, col), once each: cells whose centre is inside a polygon or whose box its outline touches.

    Rings of a polygon are combined by even-odd, so holes are out, but for cells that the hole's outline touches.
    Polygons may overlap: a cell has a row for each. An edge of no length touches one cell. A row of cells with many
    crossings is one group of (polygon, row): as many numbers as the outline crosses that row.
    """
    return filled(edges_, grid).unionAll(covered(edges_, grid)).distinct()


def members(cells: DataFrame, edges_: DataFrame, grid: Grid) -> DataFrame:
    """``cells`` (with lat and lon) joined with each polygon they touch: all their columns and ``polygon``; cells outside have no row."""
    keyed = cells.withColumns({"row": grid.row(F.col("lat")), "col": grid.col(F.col("lon"))})
    return keyed.join(touched_cells(edges_, grid), ["row", "col"]).drop("row", "col")


def mark_region(cells: DataFrame, edges_: DataFrame, grid: Grid, column: str = "in_region") -> DataFrame:
    """``cells`` with a boolean: does the cell touch any of the polygons?"""
    keyed = cells.withColumns({"row": grid.row(F.col("lat")), "col": grid.col(F.col("lon"))})
    inside = touched_cells(edges_, grid).select("row", "col").distinct().withColumn(column, F.lit(True))
    return keyed.join(inside, ["row", "col"], "left").withColumn(column, F.coalesce(column, F.lit(False))).drop("row", "col")


def polygon_means(days: DataFrame, cells: DataFrame, edges_: DataFrame, grid: Grid, columns: Sequence[str]) -> DataFrame:
    """(polygon, day, n_cells, columns...): unweighted means over the cells of each polygon that have a value that day.

    ``days``: (cell, day, columns...). A cell in several polygons counts in each.
    """
    own = members(cells, edges_, grid).select("cell", "polygon")
    means = [F.avg(c).alias(c) for c in columns]
    return days.join(own, "cell").groupBy("polygon", "day").agg(F.count(F.lit(1)).alias("n_cells"), *means)
