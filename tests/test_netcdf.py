"""Gridded files: written and read back, hyperslabs, packed and recorded variables made by hand, damaged files."""

import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThanOrEqual

from isohyet.sources import netcdf

RNG = np.random.default_rng(5)


def rows_of(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


def counted(data):
    got = []

    def read(offset, length):
        got.append(length)
        return data[offset : offset + length]

    return read, got


def grid(n_t=48, n_y=20, n_x=30, name="t2m"):
    t, y, x = np.meshgrid(np.arange(n_t) * 3600, 10 + 0.25 * np.arange(n_y), 70 + 0.25 * np.arange(n_x), indexing="ij")
    return name, t.ravel(), y.ravel(), x.ravel(), RNG.normal(size=t.size)


def test_bytes_read_fall_with_the_slab():
    name, t, y, x, v = grid()
    data = netcdf.encoded(name, t, y, x, v, {"units": "degC"})
    read, got = counted(data)
    whole = rows_of(netcdf.slabs(read, netcdf.Ranges()))
    assert len(whole) == len(v) and [r[4] for r in whole] == v.tolist() and sum(got) >= 8 * len(v)
    ranges = netcdf.Ranges()
    for f in (EqualTo(("variable",), "t2m"), GreaterThanOrEqual(("ts",), dt.datetime(1970, 1, 1, 10)), LessThanOrEqual(("ts",), dt.datetime(1970, 1, 1, 12)), GreaterThanOrEqual(("lat",), 11.0), LessThanOrEqual(("lat",), 11.3), GreaterThanOrEqual(("lon",), 72.0)):
        ranges.take(f)
    read, got = counted(data)
    part = rows_of(netcdf.slabs(read, ranges))
    want = [r for r in whole if dt.datetime(1970, 1, 1, 10) <= r[1] <= dt.datetime(1970, 1, 1, 12) and 11 <= r[2] <= 11.3 and r[3] >= 72]
    assert part == want and len(part) == 3 * 2 * 22
    assert sum(got) < 8192 + 8 * (48 + 20 + 30) + 3 * 2 * 30 * 8 + 1  # a block of header, the coordinates, the slab
    ranges = netcdf.Ranges()
    ranges.take(In(("variable",), ("tp", "sp")))
    read, got = counted(data)
    assert rows_of(netcdf.slabs(read, ranges)) == [] and sum(got) <= 8192


@pytest.mark.parametrize("n", [1, 3, 48, 100])
def test_shares_of_a_file_add_up(n):
    name, t, y, x, v = grid(n_y=3, n_x=4)
    data = netcdf.encoded(name, t, y, x, v, {})
    read, _ = counted(data)
    found = [r for k in range(n) for r in rows_of(netcdf.slabs(read, netcdf.Ranges(), (k, n), rows=25))]
    assert found == rows_of(netcdf.slabs(read, netcdf.Ranges()))


def by_hand(version=1, single=False):
    """Packed short integers along a record dimension, two variables interleaved unless ``single``."""
    text = lambda s: struct.pack(">i", len(s)) + s + b"\0" * (-len(s) % 4)
    number = lambda name, kind, x: text(name) + struct.pack(">ii", kind, 1) + (struct.pack(">d", x) if kind == 6 else struct.pack(">hxx", x))
    chars = lambda name, x: text(name) + struct.pack(">i", 2) + text(x)
    begin = (lambda n: struct.pack(">i", n)) if version == 1 else (lambda n: struct.pack(">q", n))
    dims = struct.pack(">iii", 0, 10, 3) + b""  # placeholder for numrecs is written below
    dims = struct.pack(">ii", 10, 3) + text(b"valid_time") + struct.pack(">i", 0) + text(b"latitude") + struct.pack(">i", 1) + text(b"longitude") + struct.pack(">i", 3)
    packed = struct.pack(">ii", 12, 3) + number(b"scale_factor", 6, 0.5) + number(b"add_offset", 6, 100.0) + number(b"_FillValue", 3, -32767)
    units = struct.pack(">ii", 12, 1) + chars(b"units", b"hours since 1900-01-01 00:00:0.0")
    none = struct.pack(">ii", 0, 0)
    names = [b"sp"] if single else [b"sp", b"t2m"]

    def head(at):
        out = b"CDF" + bytes([version]) + struct.pack(">i", 2) + dims + none + struct.pack(">ii", 11, 3 + len(names))
        out += text(b"latitude") + struct.pack(">ii", 1, 1) + none + struct.pack(">ii", 5, 4) + begin(at[0])
        out += text(b"longitude") + struct.pack(">ii", 1, 2) + none + struct.pack(">ii", 5, 12) + begin(at[1])
        out += text(b"valid_time") + struct.pack(">ii", 1, 0) + units + struct.pack(">ii", 4, 4) + begin(at[2])
        for k, name in enumerate(names):
            out += text(name) + struct.pack(">iiii", 3, 0, 1, 2) + packed + struct.pack(">ii", 3, 8) + begin(at[3 + k])
        return out

    n = len(head([0] * 5))
    body = struct.pack(">f", 20.5) + struct.pack(">3f", 70, 71, 72)
    for hour, sp, t in ((806_520, (1, 2, -32767), (5, 6, 7)), (806_521, (3, 4, 5), (8, 9, 10))):
        body += struct.pack(">i", hour) + struct.pack(">3hxx", *sp) + (b"" if single else struct.pack(">3hxx", *t))
    return head([n, n + 4, n + 16, n + 20, n + 28]) + body


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("single", [True, False])
def test_packed_records(version, single):
    read, _ = counted(by_hand(version, single))
    found = rows_of(netcdf.slabs(read, netcdf.Ranges()))
    start = dt.datetime(1900, 1, 1) + dt.timedelta(hours=806_520)
    want = [("sp", start + dt.timedelta(hours=h), 20.5, 70.0 + k, v) for h, vs in enumerate(((100.5, 101.0, None), (101.5, 102.0, 102.5))) for k, v in enumerate(vs)]
    if not single:
        want += [("t2m", start + dt.timedelta(hours=h), 20.5, 70.0 + k, v) for h, vs in enumerate(((102.5, 103.0, 103.5), (104.0, 104.5, 105.0))) for k, v in enumerate(vs)]
    assert found == want


def test_damaged_files_raise():
    data = by_hand()
    for bad in (b"", b"HDF5....", data[:60], data[:8] + struct.pack(">i", 99) + data[12:]):
        with pytest.raises(ValueError):
            netcdf.Header(counted(bad)[0])
    with pytest.raises(ValueError):
        netcdf.seconds_of(np.arange(3), "parsecs since 1900-01-01")
    with pytest.raises(ValueError):
        netcdf.seconds_of(np.arange(3), "days since 1900-01-01", "360_day")
    assert netcdf.seconds_of(np.array([1.5]), "days since 1970-01-02T06:30:15Z").tolist() == [86400 + 6.5 * 3600 + 15 + 129600]


def test_spark_round_trip(spark, tmp_path):
    rows = [(v, dt.datetime(2001, 1, 31, 20) + dt.timedelta(hours=h, minutes=30 * (v == "sp")), 19.5 + y, 70.0 + x, None if (h, y) == (1, 1) else float(RNG.normal())) for v in ("tp", "sp") for h in range(9) for y in range(3) for x in range(4)]
    df = spark.createDataFrame(rows, netcdf.SCHEMA)
    netcdf.write(df, str(tmp_path / "nc"), tile=2.0)
    assert len(list((tmp_path / "nc").iterdir())) == 2 * 2 * 2 * 2
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, netcdf.read(spark, str(tmp_path / "nc")).collect()), key=key) == sorted(rows, key=key)
    small = spark.read.format("netcdf").option("partitionbytes", 300).load(f"file://{tmp_path}/nc")
    assert sorted(map(tuple, small.collect()), key=key) == sorted(rows, key=key) and small.rdd.getNumPartitions() > 16
    some = netcdf.read(spark, str(tmp_path / "nc")).where("variable = 'tp' and ts > timestamp_ntz'2001-02-01 01:00:00' and lat < 21 and lon = 71")
    assert sorted(map(tuple, some.collect()), key=key) == sorted((r for r in rows if r[0] == "tp" and r[1] > dt.datetime(2001, 2, 1, 1) and r[2] < 21 and r[3] == 71), key=key)
    netcdf.write(df.where("variable = 'tp'").selectExpr("variable", "ts", "lat", "lon", "7D as value"), str(tmp_path / "nc"), tile=2.0)  # replaces its own files
    assert {(r.variable, r.value == 7) for r in netcdf.read(spark, str(tmp_path / "nc")).where("value is not null").collect()} == {("tp", True), ("sp", False)}
    with pytest.raises(Exception, match="without variable"):
        netcdf.write(spark.createDataFrame([("tp", None, 1.0, 1.0, 1.0)], netcdf.SCHEMA), str(tmp_path / "bad"))
    assert netcdf.read(spark, str(tmp_path / "nothing")).count() == 0
