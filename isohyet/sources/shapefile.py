"""Polygons of shapefiles as a data source of edges.

    shapefile.register(spark)
    spark.read.format("shapefile").load("districts.shp").where("east >= 78 and west <= 80")

A row is an edge (x1, y1, x2, y2) of ring ``ring`` of polygon ``polygon`` ('number:name'), with the polygon's box. The
index file says where records lie, so partitions are ranges of records; a task reads its range and tests the box of a
record against the predicates before it decodes any ring. Names come from the first text field of the table beside it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from isohyet.sources import packages
from isohyet.sources.netcdf import _store

SCHEMA = "polygon string, ring int, x1 double, y1 double, x2 double, y2 double, west double, south double, east double, north double"
#: File code, version and the kinds of polygons (plain, with heights, with measures).
_CODE, _VERSION, _POLYGONS = 9994, 1000, (5, 15, 25)
_BOX = ("west", "south", "east", "north")


def _checked(data: bytes) -> bytes:
    if len(data) < 100 or struct.unpack(">i", data[:4])[0] != _CODE:
        raise ValueError("not a shapefile")
    return data


def record_table(index: bytes) -> np.ndarray:
    """(n, 2): offset and length in bytes of each record's content with its head, from an index file."""
    _checked(index)
    found = np.frombuffer(index, ">i4", offset=100, count=(len(index) - 100) // 8 * 2).reshape(-1, 2).astype(np.int64)
    return found * 2 + np.array([0, 8])


def field_names(table: bytes) -> list[str]:
    """The first text field of each row of a dBASE table, trimmed; an empty list if there is none."""
    n, first, width = struct.unpack("<IHH", table[4:12])
    at, offset = 32, 1
    while at + 32 <= first and table[at] != 0x0D:
        kind, size = chr(table[at + 11]), table[at + 16]
        if kind == "C":
            return [table[first + k * width + offset : first + k * width + offset + size].decode("utf-8", "replace").rstrip(" \0") for k in range(n)]
        offset += size
        at += 32
    return []


def box_of(record: bytes) -> tuple[float, ...] | None:
    """Of a record with its head; None for a null shape. Other shapes than polygons are an error."""
    kind = struct.unpack("<i", record[8:12])[0]
    if kind == 0:
        return None
    if kind not in _POLYGONS:
        raise ValueError(f"a shape of kind {kind} is no polygon")
    return struct.unpack("<4d", record[12:44])


def rings_of(record: bytes) -> list[np.ndarray]:
    """(n, 2) points of each ring."""
    n_parts, n_points = struct.unpack("<2i", record[44:52])
    starts = np.frombuffer(record, "<i4", n_parts, 52)
    points = np.frombuffer(record, "<f8", 2 * n_points, 52 + 4 * n_parts).reshape(-1, 2)
    return np.split(points, starts[1:])


class Tests:
    """Predicates on the columns of the box."""

    def __init__(self):
        self.tests: list[tuple[int, type, float]] = []

    def take(self, f) -> None:
        column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
        if column in _BOX and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            self.tests.append((_BOX.index(column), type(f), float(f.value)))

    def pass_(self, box: Sequence[float]) -> bool:
        hold = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}
        return all(hold[kind](box[k], value) for k, kind, value in self.tests)


def edges_of(number: int, name: str, record: bytes, tests: Tests):
    """An Arrow batch of SCHEMA, or None where the box fails a test."""
    import pyarrow as pa

    box = box_of(record)
    if box is None or not tests.pass_(box):
        return None
    ends = []
    for k, ring in enumerate(rings_of(record)):
        if len(ring) and (ring[0] != ring[-1]).any():
            ring = np.vstack([ring, ring[:1]])
        ends.append(np.column_stack([np.full(max(len(ring) - 1, 0), k), ring[:-1], ring[1:]]))
    rows = np.vstack(ends) if ends else np.zeros((0, 5))
    fill = lambda x, kind: pa.array([x], kind).take(pa.array(np.zeros(len(rows), np.int64)))
    columns = [fill(f"{number}:{name}", pa.string()), pa.array(rows[:, 0].astype(np.int32)), *(pa.array(np.ascontiguousarray(rows[:, c])) for c in range(1, 5)), *(fill(b, pa.float64()) for b in box)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])


@dataclass
class Records(InputPartition):
    """Records from ``first`` to before ``end``."""

    first: int = 0
    end: int = 0

    def __post_init__(self):
        super().__init__((self.first, self.end))


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.target, self.tests = options["path"].removesuffix(".shp"), int(options.get("partitionbytes", 16 << 20)), Tests()

    def pushFilters(self, filters):
        for f in filters:
            self.tests.take(f)
            yield f

    def _bytes(self, suffix: str) -> bytes:
        store, root = _store(self.path)
        with store.open_input_file(root + suffix) as file:
            return file.read()

    def partitions(self):
        sizes = record_table(self._bytes(".shx"))[:, 1]
        if not len(sizes):
            return [Records()]
        share = np.cumsum(sizes) // self.target
        first = np.flatnonzero(np.diff(share, prepend=-1))
        return [Records(int(a), int(b)) for a, b in zip(first, [*first[1:], len(sizes)], strict=True)]

    def read(self, partition):
        from pyarrow import fs

        if partition.first == partition.end:
            return
        where = record_table(self._bytes(".shx"))[partition.first : partition.end]
        store, root = _store(self.path)
        named = store.get_file_info(root + ".dbf").type == fs.FileType.File
        names = field_names(self._bytes(".dbf")) if named else []
        with store.open_input_file(root + ".shp") as file:
            _checked(file.read_at(100, 0))
            for number, (offset, length) in enumerate(where.tolist(), partition.first):
                head = file.read_at(52, offset)  # up to the counts: the box decides about the rest
                box = box_of(head)
                if box is None or not self.tests.pass_(box):
                    continue
                batch = edges_of(number, names[number] if number < len(names) else "", head + file.read_at(length - 52, offset + 52), self.tests)
                if batch is not None:
                    yield batch


class Source(DataSource):
    @classmethod
    def name(cls):
        return "shapefile"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)


def register(spark: SparkSession) -> None:
    packages.ship(spark)
    spark.dataSource.register(Source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str) -> DataFrame:
    """SCHEMA of the polygons of ``path``; its first six columns are what ``boundaries`` takes."""
    register(spark)
    return spark.read.format("shapefile").load(path)


def encoded(polygons: Iterable[tuple[str, Sequence]]) -> tuple[bytes, bytes, bytes]:
    """The three files (.shp, .shx, .dbf) of (name, rings); rings are closed."""
    body, index, names = b"", b"", []
    boxes = []
    for number, (name, rings) in enumerate(polygons, 1):
        rings = [np.asarray(r, "<f8").reshape(-1, 2) for r in rings]
        rings = [r if not len(r) or (r[0] == r[-1]).all() else np.vstack([r, r[:1]]) for r in rings]
        points = np.vstack(rings)
        boxes.append((*points.min(0), *points.max(0)))
        starts = np.cumsum([0, *(len(r) for r in rings[:-1])]).astype("<i4")
        content = struct.pack("<i4d2i", 5, *boxes[-1], len(rings), len(points)) + starts.tobytes() + points.astype("<f8").tobytes()
        index += struct.pack(">2i", (100 + len(body)) // 2, len(content) // 2)
        body += struct.pack(">2i", number, len(content) // 2) + content
        names.append(name.encode()[:64].ljust(64))
    edge = (*np.min(boxes, axis=0)[:2], *np.max(boxes, axis=0)[2:]) if boxes else (0.0,) * 4
    head = lambda n: struct.pack(">7i", _CODE, 0, 0, 0, 0, 0, (100 + n) // 2) + struct.pack("<2i8d", _VERSION, 5, *edge, 0, 0, 0, 0)
    field = b"NAME".ljust(11, b"\0") + b"C" + bytes(4) + bytes([64, 0]) + bytes(14)
    table = struct.pack("<4BIHH", 3, 124, 1, 1, len(names), 65, 65) + bytes(20) + field + b"\x0d" + b"".join(b" " + n for n in names) + b"\x1a"
    return head(len(body)) + body, head(len(index)) + index, table


def write(polygons: Iterable[tuple[str, Sequence]], path: str) -> None:
    """``path``.shp, .shx and .dbf of a few polygons that the driver has."""
    store, root = _store(path.removesuffix(".shp"))
    store.create_dir(root.rpartition("/")[0], recursive=True)
    for suffix, data in zip((".shp", ".shx", ".dbf"), encoded(polygons), strict=True):
        with store.open_output_stream(root + suffix) as out:
            out.write(data)
