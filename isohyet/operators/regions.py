"""Regions: bounding boxes, boundary polygons and the cells that they touch. All of it is driver-side and small."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Ring = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Region:
    """north, west, south, east in degrees; rings are closed (lon, lat) outlines of the boundary, if there is one."""

    name: str
    north: float
    west: float
    south: float
    east: float
    rings: tuple[Ring, ...] = ()


def _kml_rings(text: str) -> list[Ring]:
    rings = []
    for node in ET.fromstring(text).iter():
        if node.tag.rpartition("}")[2] == "outerBoundaryIs":
            for line in node.iter():
                if line.tag.rpartition("}")[2] == "coordinates":
                    rings.append(tuple((float(p.split(",")[0]), float(p.split(",")[1])) for p in (line.text or "").split()))
    return rings


def _geojson_rings(value) -> list[Ring]:
    kind = value.get("type")
    if kind == "FeatureCollection":
        return [r for f in value["features"] for r in _geojson_rings(f)]
    if kind == "Feature":
        return _geojson_rings(value["geometry"])
    if kind == "GeometryCollection":
        return [r for g in value["geometries"] for r in _geojson_rings(g)]
    polygons = {"Polygon": [value.get("coordinates")], "MultiPolygon": value.get("coordinates")}.get(kind, [])
    return [tuple((float(p[0]), float(p[1])) for p in polygon[0]) for polygon in polygons]


def read_boundary(text: str) -> list[Ring]:
    """Outer rings of a KML or GeoJSON document; holes are not read, so a cell in a hole counts as inside."""
    rings = _geojson_rings(json.loads(text)) if text.lstrip().startswith("{") else _kml_rings(text)
    if not rings:
        raise ValueError("the boundary has no polygon")
    return rings


def resolve_region(name: str, *, bbox: Sequence[float] | None = None, boundary: str | None = None, buffer: float = 0.15) -> Region:
    """From exactly one of ``bbox`` (north, west, south, east) and ``boundary`` (text of a file; its bounds grow by ``buffer``)."""
    if (bbox is None) == (boundary is None):
        raise ValueError("give either a bounding box or a boundary")
    if bbox is not None:
        return Region(name, *map(float, bbox))
    rings = read_boundary(boundary)
    lon, lat = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    return Region(name, max(lat) + buffer, min(lon) - buffer, min(lat) - buffer, max(lon) + buffer, tuple(rings))


def _inside(x: float, y: float, ring: np.ndarray) -> bool:
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    spans = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return bool((spans & cross).sum() % 2)


def _crosses(ring: np.ndarray, box: tuple[float, float, float, float]) -> bool:
    """Does an edge of the ring meet the box? (clipping of all edges at once)"""
    west, south, east, north = box
    a, step = ring[:-1], np.diff(ring, axis=0)
    low, high = np.zeros(len(a)), np.ones(len(a))
    for axis, (lo, hi) in enumerate(((west, east), (south, north))):
        d, p = step[:, axis], a[:, axis]
        with np.errstate(divide="ignore", invalid="ignore"):
            t1, t2 = (lo - p) / d, (hi - p) / d
        flat = d == 0
        out = flat & ((p < lo) | (p > hi))
        low = np.where(out, 2.0, np.where(flat, low, np.maximum(low, np.minimum(t1, t2))))
        high = np.where(flat, high, np.minimum(high, np.maximum(t1, t2)))
    return bool((low <= high).any())


def touched(rings: Sequence[Ring], lat: float, lon: float, size: float) -> bool:
    """Does the cell of width ``size`` around (lat, lon) touch the polygon?"""
    box = (lon - size / 2, lat - size / 2, lon + size / 2, lat + size / 2)
    for ring in rings:
        points = np.array(ring, float)
        if not np.array_equal(points[0], points[-1]):
            points = np.vstack([points, points[:1]])
        if _crosses(points, box) or _inside(lon, lat, points):
            return True
    return False


def cell_table(spark: SparkSession, cells: Sequence[tuple[int, float, float]], region: Region, size: float = 0.1) -> DataFrame:
    """(cell, lat, lon, in_region) for the given cells; without a boundary all are in the region."""
    rows = [(int(c), float(la), float(lo), not region.rings or touched(region.rings, la, lo, size)) for c, la, lo in cells]
    return spark.createDataFrame(rows, "cell int, lat double, lon double, in_region boolean")


def if_small(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """``table`` (a few numbers a row) marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def clip(df: DataFrame, cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of cells outside the region become NULL; rows stay. ``cells`` is a table of ``cell_table``, one row per cell."""
    inside = if_small(cells.select("cell", "in_region"))
    return df.join(inside, "cell", "left").withColumns({c: F.when(F.coalesce("in_region", F.lit(False)), F.col(c)) for c in columns}).drop("in_region")
