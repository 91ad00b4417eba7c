"""Shapefiles made by hand against their GeoJSON twins."""

import json
import struct

import pytest
from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

from isohyet.operators import boundaries
from isohyet.sources import shapefile

POLYGONS = [(f"p{k} é", [[(k, k), (k + 5.5, k), (k + 5, k + 4.25), (k, k)], [(k + 1, k + 1), (k + 2, k + 1), (k + 2, k + 2), (k + 1, k + 1)]][: 1 + k % 2]) for k in range(40)]


def twin():
    features = [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": "Polygon", "coordinates": rings}} for n, rings in POLYGONS]
    return boundaries.read_polygons(json.dumps({"type": "FeatureCollection", "features": features}))


def test_edges_equal_those_of_the_geojson_twin(spark, tmp_path):
    shapefile.write(POLYGONS, f"{tmp_path}/a/shapes.shp")
    found = shapefile.read(spark, f"file://{tmp_path}/a/shapes.shp")
    assert sorted((r.polygon, r.x1, r.y1, r.x2, r.y2) for r in found.collect()) == sorted(boundaries.edge_rows(twin()))
    cut = spark.read.format("shapefile").option("partitionbytes", 400).load(f"{tmp_path}/a/shapes.shp")
    assert cut.rdd.getNumPartitions() > 10 and sorted(map(tuple, cut.collect())) == sorted(map(tuple, found.collect()))
    some = found.where("west >= 10 and north < 20")
    assert {r.polygon for r in some.collect()} == {f"{k}:p{k} é" for k in range(40) if k >= 10 and k + 4.25 < 20}


def test_a_box_is_tested_before_rings_are_decoded(monkeypatch):
    data, index, table = shapefile.encoded(POLYGONS)
    decoded, real = [], shapefile.rings_of
    monkeypatch.setattr(shapefile, "rings_of", lambda record: decoded.append(1) or real(record))
    tests = shapefile.Tests()
    tests.take(GreaterThanOrEqual(("east",), 20.0))
    tests.take(LessThan(("south",), 18.0))
    found = [shapefile.edges_of(k, "", data[a : a + n], tests) for k, (a, n) in enumerate(shapefile.record_table(index).tolist())]
    assert sum(f is not None for f in found) == len(decoded) == sum(k + 5.5 >= 20 and k < 18 for k in range(40))
    assert shapefile.field_names(table)[3] == "p3 é"


def test_null_shapes_and_damage(spark, tmp_path):
    null = struct.pack(">2i", 1, 2) + struct.pack("<i", 0)
    assert shapefile.edges_of(0, "", null, shapefile.Tests()) is None
    with pytest.raises(ValueError):
        shapefile.box_of(struct.pack(">2i", 1, 2) + struct.pack("<i", 1) + bytes(40))  # a point
    for bad in (b"", b"x" * 200):
        with pytest.raises(ValueError):
            shapefile.record_table(bad)
    shapefile.write([], f"{tmp_path}/none.shp")
    assert shapefile.read(spark, f"{tmp_path}/none.shp").count() == 0
