"""Gridded files in the classic NetCDF formats (CDF-1 and CDF-2), as a data source that reads hyperslabs.

    netcdf.register(spark)
    spark.read.format("netcdf").load(folder).where("variable = 't2m' and lat between 20 and 22")

A row is (variable, ts, lat, lon, value). Partitions are planned from the files' sizes alone: small files go together,
a large one is cut along time. A task reads a file's header and coordinates, takes the predicates on variable, time and
place down to ranges of indices, and seeks past everything else. Packed numbers are unpacked; missing ones are NULL.

The writer makes a file for each variable, month and tile of the grid, so that neither a file nor a task grows with the
area. Files get their names when the job commits.
"""

from __future__ import annotations

import datetime as dt
import struct
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from isohyet.sources import packages

SCHEMA = "variable string, ts timestamp_ntz, lat double, lon double, value double"
#: The number types of the format, and its tags of lists.
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
_DIMENSIONS, _VARIABLES, _ATTRIBUTES = 10, 11, 12
_PLACES = {"ts": ("time", "valid_time"), "lat": ("latitude", "lat"), "lon": ("longitude", "lon")}
_UNITS = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}
_EPOCH = dt.datetime(1970, 1, 1)


@dataclass
class Variable:
    name: str
    dimensions: list[str]
    shape: list[int]
    dtype: np.dtype
    attributes: dict
    begin: int
    #: Bytes from one step of the first dimension to the next.
    stride: int


class Header:
    """Dimensions and variables of a file. ``read(offset, length)`` gives its bytes."""

    def __init__(self, read):
        self._read, self._data, self._at = read, b"", 0
        magic = self._take(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2):
            raise ValueError("not a classic NetCDF file")
        records = self._int()
        dimensions = [(self._name(), self._int()) for _ in range(self._list(_DIMENSIONS))]
        self.attributes = self._pairs()
        found = []
        for _ in range(self._list(_VARIABLES)):
            name = self._name()
            ids = [self._int() for _ in range(self._int())]
            attributes, kind, size = self._pairs(), self._int(), self._int()
            found.append((name, ids, attributes, np.dtype(_TYPES[kind]), size, struct.unpack(">q", self._take(8))[0] if magic[3] == 2 else self._int()))
        by_record = [v for v in found if v[1] and dimensions[v[1][0]][1] == 0]
        step = sum(v[4] for v in by_record)
        if len(by_record) == 1:  # a single one isn't padded
            name, ids, _, dtype, _, _ = by_record[0]
            step = dtype.itemsize * int(np.prod([dimensions[i][1] for i in ids[1:]], dtype=np.int64))
        self.variables = {}
        for name, ids, attributes, dtype, _, begin in found:
            shape = [dimensions[i][1] or records for i in ids]
            own = dtype.itemsize * int(np.prod(shape[1:], dtype=np.int64))
            recorded = bool(ids) and dimensions[ids[0]][1] == 0
            self.variables[name] = Variable(name, [dimensions[i][0] for i in ids], shape, dtype, attributes, begin, step if recorded else own)

    def _take(self, n: int) -> bytes:
        while len(self._data) < self._at + n:
            more = self._read(len(self._data), max(8192, n))
            if not more:
                raise ValueError("the header breaks off")
            self._data += more
        self._at += n
        return self._data[self._at - n : self._at]

    def _int(self) -> int:
        return struct.unpack(">i", self._take(4))[0]

    def _padded(self, n: int) -> bytes:
        data = self._take(n)
        self._take(-n % 4)
        return data

    def _name(self) -> str:
        return self._padded(self._int()).decode()

    def _list(self, tag: int) -> int:
        found, n = self._int(), self._int()
        if found not in (0, tag) or (found == 0 and n):
            raise ValueError("the header is damaged")
        return n

    def _pairs(self) -> dict:
        out = {}
        for _ in range(self._list(_ATTRIBUTES)):
            name, kind, n = self._name(), self._int(), self._int()
            dtype = np.dtype(_TYPES[kind])
            data = self._padded(n * dtype.itemsize)
            out[name] = data.decode(errors="replace").rstrip("\0") if kind == 2 else np.frombuffer(data, dtype).astype(dtype.newbyteorder("=")).tolist()
        return out

    def coordinate(self, column: str) -> Variable:
        for name in _PLACES[column]:
            if name in self.variables:
                return self.variables[name]
        raise ValueError(f"no {_PLACES[column][0]} in the file")


def seconds_of(values: np.ndarray, units: str, calendar: str = "standard") -> np.ndarray:
    """Whole seconds since 1970 of a time axis such as 'hours since 1900-01-01 00:00:00.0'."""
    if calendar not in ("standard", "gregorian", "proleptic_gregorian"):
        raise ValueError(f"the calendar {calendar} is not known")
    unit, _, origin = units.partition(" since ")
    unit = unit.strip().rstrip("s") + "s"
    if unit not in _UNITS or not origin:
        raise ValueError(f"no time in '{units}'")
    date, _, clock = origin.strip().replace("T", " ").removesuffix("Z").partition(" ")
    hms = [float(x) for x in (clock.split(":") if clock.strip() else [])] + [0.0] * 3
    start = dt.datetime(*(int(x) for x in date.split("-"))) - _EPOCH
    return np.rint(start.total_seconds() + hms[0] * 3600 + hms[1] * 60 + hms[2] + values.astype(np.float64) * _UNITS[unit]).astype(np.int64)


class Ranges:
    """Predicates on a column as the lowest and highest value; ``names`` are the variables asked for, None for all."""

    def __init__(self):
        self.names: set[str] | None = None
        self.low: dict[str, float] = {}
        self.high: dict[str, float] = {}

    @staticmethod
    def _number(value):
        return (value.replace(tzinfo=None) - _EPOCH).total_seconds() if isinstance(value, dt.datetime) else float(value)

    def take(self, f) -> None:
        """Narrow by a filter, if it is of a kind that is known. Spark tests the rows again, so bounds may stay inclusive."""
        column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
        if column == "variable" and isinstance(f, (EqualTo, In)):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.names = values if self.names is None else self.names & values
        elif column in _PLACES and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            value = self._number(f.value)
            if not isinstance(f, (LessThan, LessThanOrEqual)):
                self.low[column] = max(value, self.low.get(column, value))
            if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.high[column] = min(value, self.high.get(column, value))

    def span(self, column: str, values: np.ndarray) -> tuple[int, int]:
        """First index and end of the smallest run of ``values`` that holds all within the bounds."""
        ok = np.flatnonzero((values >= self.low.get(column, -np.inf)) & (values <= self.high.get(column, np.inf)))
        return (int(ok[0]), int(ok[-1]) + 1) if len(ok) else (0, 0)


def slabs(read, ranges: Ranges, share: tuple[int, int] = (0, 1), rows: int = 500_000):
    """Arrow batches of SCHEMA of one file; of its time steps the ``share`` (k of n)."""
    import pyarrow as pa

    header = Header(read)

    def whole(v: Variable) -> np.ndarray:
        n = v.shape[0]
        if v.stride == v.dtype.itemsize:
            return np.frombuffer(read(v.begin, n * v.stride), v.dtype)
        return np.array([np.frombuffer(read(v.begin + k * v.stride, v.dtype.itemsize), v.dtype)[0] for k in range(n)])

    axes = {c: header.coordinate(c) for c in _PLACES}
    order = [axes[c].name for c in ("ts", "lat", "lon")]
    fields = [v for v in header.variables.values() if v.dimensions == order and (ranges.names is None or v.name in ranges.names)]
    if not fields:
        return
    time = axes["ts"]
    seconds = seconds_of(whole(time), time.attributes.get("units", ""), time.attributes.get("calendar", "standard"))
    lat, lon = (whole(axes[c]).astype(np.float64) for c in ("lat", "lon"))
    (t0, t1), (y0, y1), (x0, x1) = (ranges.span(c, v) for c, v in (("ts", seconds), ("lat", lat), ("lon", lon)))
    t0, t1 = max(t0, len(seconds) * share[0] // share[1]), min(t1, len(seconds) * (share[0] + 1) // share[1])
    cells = (y1 - y0) * (x1 - x0)
    if not cells:
        return
    at_once = max(1, rows // cells)
    places = np.repeat(lat[y0:y1], x1 - x0), np.tile(lon[x0:x1], y1 - y0)
    for v in fields:
        size = v.dtype.itemsize
        length = ((y1 - 1 - y0) * len(lon) + x1 - x0) * size  # one run of bytes from the slab's first value to its last
        for a in range(t0, t1, at_once):
            b = min(a + at_once, t1)
            steps = np.empty((b - a, y1 - y0, x1 - x0), v.dtype)
            for k in range(a, b):
                flat = np.zeros((y1 - y0) * len(lon), v.dtype)
                flat[: length // size] = np.frombuffer(read(v.begin + k * v.stride + (y0 * len(lon) + x0) * size, length), v.dtype)
                steps[k - a] = flat.reshape(y1 - y0, len(lon))[:, : x1 - x0]
            raw = steps.ravel()
            values = raw.astype(np.float64) * v.attributes.get("scale_factor", [1.0])[0] + v.attributes.get("add_offset", [0.0])[0]
            missing = np.isnan(values)
            for name in ("_FillValue", "missing_value"):
                if name in v.attributes:
                    missing |= raw == np.array(v.attributes[name][0]).astype(v.dtype)
            stamps = pa.array(np.repeat(seconds[a:b] * 1_000_000, cells), pa.timestamp("us"))
            names = pa.array([v.name], pa.string()).take(pa.array(np.zeros(len(raw), np.int64)))
            columns = [names, stamps, *(pa.array(np.tile(p, b - a)) for p in places), pa.array(values, mask=missing)]
            yield pa.RecordBatch.from_arrays(columns, ["variable", "ts", "lat", "lon", "value"])


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Share(InputPartition):
    """Files, and which part of their time steps (the whole, where there are several)."""

    paths: list[str] = field(default_factory=list)
    k: int = 0
    n: int = 1

    def __post_init__(self):
        super().__init__(self.paths)


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.target, self.ranges = options["path"], int(options.get("partitionbytes", 64 << 20)), Ranges()

    def pushFilters(self, filters):
        for f in filters:
            self.ranges.take(f)
            yield f

    def partitions(self):
        from pyarrow import fs

        store, root = _store(self.path)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        parts, together, size = [], [], 0
        for path, n in sorted((i.path, i.size) for i in found if i.is_file and i.base_name.endswith(".nc") and not i.base_name.startswith((".", "_"))):
            if n > self.target:
                pieces = -(-n // self.target)
                parts += [Share([path], k, pieces) for k in range(pieces)]
                continue
            if together and size + n > self.target:
                parts.append(Share(together))
                together, size = [], 0
            together.append(path)
            size += n
        return parts + [Share(together)] if together or not parts else parts

    def read(self, partition):
        store, _ = _store(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as file:
                yield from slabs(lambda offset, length, file=file: file.read_at(length, offset), self.ranges, (partition.k, partition.n))


# --- writing ------------------------------------------------------------------------------------------


def encoded(name: str, ts: np.ndarray, lat: np.ndarray, lon: np.ndarray, value: np.ndarray, attributes: dict[str, str]) -> bytes:
    """A CDF-2 file of one variable over the grid of the given rows; NaN where there is no row, or a NaN. ``ts``: seconds since 1970."""
    axes = [np.unique(x, return_inverse=True) for x in (ts, lat, lon)]
    grid = np.full([len(a) for a, _ in axes], np.nan)
    grid[tuple(k for _, k in axes)] = value
    hours = not (axes[0][0] % 3600).any()
    times = axes[0][0] // 3600 if hours else axes[0][0]
    padded = lambda b: b + b"\0" * (-len(b) % 4)
    word = lambda *n: struct.pack(f">{len(n)}i", *n)
    text = lambda s: word(len(s.encode())) + padded(s.encode())

    def listed(pairs: dict) -> bytes:
        out = word(_ATTRIBUTES if pairs else 0, len(pairs))
        for key, x in pairs.items():
            out += text(key) + (word(2) + text(x) if isinstance(x, str) else word(6, 1) + struct.pack(">d", x))
        return out

    data = [
        ("time", [0], {"units": f"{'hours' if hours else 'seconds'} since 1970-01-01 00:00:00", "calendar": "standard"}, times.astype(">f8")),
        ("latitude", [1], {"units": "degrees_north"}, axes[1][0].astype(">f8")),
        ("longitude", [2], {"units": "degrees_east"}, axes[2][0].astype(">f8")),
        (name, [0, 1, 2], {**attributes, "_FillValue": np.nan}, grid.astype(">f8")),
    ]

    def head(begins: list[int]) -> bytes:
        out = b"CDF\x02" + word(0, _DIMENSIONS, 3) + b"".join(text(n) + word(len(a)) for n, (a, _) in zip(("time", "latitude", "longitude"), axes, strict=True))
        out += listed({"Conventions": "CF-1.8"}) + word(_VARIABLES, len(data))
        for (own, ids, pairs, x), begin in zip(data, begins, strict=True):
            out += text(own) + word(len(ids), *ids) + listed(pairs) + word(6, min(x.nbytes, 2**31 - 4)) + struct.pack(">q", begin)
        return out

    sizes = [x.nbytes for *_, x in data]
    first = len(head([0] * len(data)))
    return head([first + sum(sizes[:k]) for k in range(len(data))]) + b"".join(x.tobytes() for *_, x in data)


@dataclass
class Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class Writer(DataSourceArrowWriter):
    """Takes (file, variable, ts, lat, lon, value), rows of one file in a row. A task writes under names of its own; the
    commit gives the final ones. A file of the same name is replaced."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        import pyarrow as pa

        from isohyet.sources.tables import ATTRIBUTES

        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        names, held = [], None

        def flush(table):
            name = table.column("variable")[0].as_py()
            seconds = table.column("ts").cast(pa.int64()).to_numpy() // 1_000_000
            columns = [table.column(c).to_numpy() for c in ("lat", "lon", "value")]
            final, own = table.column("file")[0].as_py(), f"_{uuid.uuid4().hex}.nc"
            with store.open_output_stream(f"{root}/{own}") as out:
                out.write(encoded(name, seconds, *columns, ATTRIBUTES.get(name.split("_")[0], {})))
            names.append((own, final))

        for batch in iterator:
            if not batch.num_rows:
                continue
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
            files = np.array(held.column("file").to_pylist(), object)
            edge = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist()]
            for a, b in zip(edge, edge[1:], strict=False):
                flush(held.slice(a, b - a))
            held = held.slice(edge[-1])
        if held:
            flush(held)
        return Written(names)

    def commit(self, messages):
        store, root = _store(self.path)
        for message in messages:
            for own, final in message.names if message else []:
                store.move(f"{root}/{own}", f"{root}/{final}")

    def abort(self, messages):
        store, root = _store(self.path)
        for message in messages:
            for own, _ in message.names if message else []:
                store.delete_file(f"{root}/{own}")


class Source(DataSource):
    @classmethod
    def name(cls):
        return "netcdf"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options)


def register(spark: SparkSession) -> None:
    packages.ship(spark)
    spark.dataSource.register(Source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str) -> DataFrame:
    """SCHEMA of the files below ``path``; filters on variable, ts, lat and lon are taken down to the files' indices."""
    register(spark)
    return spark.read.format("netcdf").load(path)


def write(df: DataFrame, path: str, *, tile: float = 5.0) -> None:
    """Rows of SCHEMA as one file for each variable, month and tile of ``tile`` degrees, named variable_year_month_row_col.nc.

    A grid's missing rows read back as NULL values. Of rows with equal variable, time and place one stays. A null key
    is an error. Files are replaced one by one; others in the folder stay.
    """
    register(df.sparkSession)
    index = lambda c: F.floor(F.col(c) / tile).cast("int")
    file = F.format_string("%s_%04d_%02d_%d_%d.nc", F.col("variable"), F.year("ts"), F.month("ts"), index("lat"), index("lon"))
    null = F.col("variable").isNull() | F.col("ts").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    file = F.when(null, F.raise_error(F.lit("a row without variable, time or place")).cast("string")).otherwise(file)
    value = F.coalesce(F.col("value").cast("double"), F.lit(float("nan")))
    keyed = df.select(file.alias("file"), F.col("variable"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), value.alias("value"))
    keyed.repartition("file").sortWithinPartitions("file").write.format("netcdf").mode("append").save(path)
