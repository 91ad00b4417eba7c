"""Hand-checked values and properties of the operators."""

import datetime as dt
import random
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from isohyet.functions import bands, special
from isohyet.functions.calendar import fortnight, iso_year, local_day
from isohyet.operators import annual, daily, indices, normals, periods, regions
from isohyet.plans.config import Settings
from isohyet.plans.run import Run, wanted_indices
from isohyet.sources import inventory, tables

T0 = dt.datetime(2024, 1, 1)


def column(df, name, order="ts"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_deaccumulate_reset_by_hand(spark):
    df = spark.createDataFrame([(0, T0 + dt.timedelta(hours=i), float(x)) for i, x in enumerate([5, 7, 9, 2, 3])], "cell int, ts timestamp_ntz, x double")
    assert column(daily.deaccumulate_reset(df, "x", "d"), "d") == [5, 2, 2, 2, 1]


def test_deaccumulate_cycle_ignores_dips(spark):
    hours = [(23, 8.0), (24, 9.0), (25, 1.0), (26, 3.0), (27, 2.9), (28, 4.0)]
    df = spark.createDataFrame([(0, T0 + dt.timedelta(hours=h), x) for h, x in hours], "cell int, ts timestamp_ntz, x double")
    assert column(daily.deaccumulate_cycle(df, "x", "d"), "d") == [1.0, 1.0, 2.0, 0.0, 1.0]


def test_calendar_keys(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2023, 12, 31),)], "d date")
    got = df.select(iso_year(F.col("d")), F.weekofyear("d"), fortnight(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(2020, 53, 0), (2023, 52, 26)]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 18, 30),)], "ts timestamp_ntz")
    assert ts.select(local_day(F.col("ts"))).first()[0] == dt.date(2024, 1, 2)


def test_smoothing_wraps_and_keeps_constants(spark):
    rows = [(0, d, 2.0, float(d == 1)) for d in range(1, 11)] + [(1, d, None if d == 5 else 1.0, 0.0) for d in range(1, 11)]
    out = normals.smooth_circular(spark.createDataFrame(rows, "cell int, doy int, a double, b double"), ["a", "b"]).orderBy("cell", "doy").collect()
    assert [r.a for r in out[:10]] == [2.0] * 10
    assert [r.b for r in out[:10]] == pytest.approx([0.2, 0.2, 0.2, 0, 0, 0, 0, 0, 0.2, 0.2])
    assert [r.a is None for r in out[10:]] == [d in (3, 4, 5, 6, 7) for d in range(1, 11)]


def test_longest_run_and_null_is_false(spark):
    truth = [True, True, False, True, True, True, None, True]
    df = spark.createDataFrame([(0, 2024, dt.date(2024, 1, i + 1), t) for i, t in enumerate(truth)], "cell int, year int, day date, t boolean")
    assert annual.longest_run(df, F.col("t"), by=["cell"]).first()["run"] == 3
    assert annual.longest_run(df, F.lit(False), by=["cell"]).first()["run"] == 0


def test_pci_of_even_and_single_month(spark):
    rows = [(c, dt.date(2020, m, 1), 10.0 if c == 0 else float(m == 7)) for c in (0, 1) for m in range(1, 13)]
    out = indices.pci(spark.createDataFrame(rows, "cell int, month date, p double"), "p").orderBy("cell").collect()
    assert [r.pci for r in out] == pytest.approx([100 / 12, 100.0])


def test_decile_shares_ranks_of_equals(spark):
    rows = [(0, dt.date(2000 + i, 1, 1), x) for i, x in enumerate([1.0, 2.0, 2.0, 4.0, None])]
    out = indices.decile(spark.createDataFrame(rows, "cell int, month date, p double"), "p", "d", [F.month("month")]).orderBy("month")
    assert [r.d for r in out.collect()] == [2.5, 6.25, 6.25, 10.0, None]


def test_empty_month_sums_to_zero_and_has_no_mean(spark):
    df = spark.createDataFrame([(0, dt.date(2020, 1, 5), 3.0), (0, dt.date(2020, 3, 5), 4.0)], "cell int, day date, x double").withColumn("y", F.col("x"))
    out = periods.monthly(df, sums=["x"], means=["y"]).orderBy("month").collect()
    assert [(r.x, r.y, r.n_days) for r in out] == [(3.0, 3.0, 1), (0.0, None, 0), (4.0, 4.0, 1)]


def test_special_functions(spark):
    df = spark.createDataFrame([(x,) for x in (0.01, 0.3, 1.0, 2.5, 9.0)], "x double")
    one = df.select(special.gamma_cdf(F.lit(1.0), F.col("x")).alias("a"), special.gamma_cdf(F.lit(0.5), F.col("x")).alias("b"), special.log_gamma(F.col("x")).alias("c"), "x").collect()
    for r in one:
        assert r.a == pytest.approx(1 - math.exp(-r.x), abs=1e-13)
        assert r.b == pytest.approx(math.erf(math.sqrt(r.x)), abs=1e-13)
        assert r.c == pytest.approx(math.lgamma(r.x), abs=1e-11)
    ps = spark.createDataFrame([(p,) for p in (1e-12, 1e-6, 0.02, 0.3, 0.5, 0.8, 1 - 1e-6)], "p double")
    for r in ps.select("p", special.normal_quantile(F.col("p")).alias("z")).collect():
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), abs=1e-9)


def test_spi_is_monotone_and_standard(spark):
    rows = [(0, dt.date(1980 + i, 1, 1), float(x)) for i, x in enumerate([0, 0, 3, 8, 12, 12, 20, 35, 50, 90])]
    out = indices.spi(spark.createDataFrame(rows, "cell int, month date, p double"), "p", "z", [F.month("month")]).orderBy("p").collect()
    z = [r.z for r in out]
    assert z == sorted(z) and z[0] == pytest.approx(NormalDist().inv_cdf(0.2), abs=1e-9)
    same = indices.spi(spark.createDataFrame([(0, dt.date(1980 + i, 1, 1), 5.0) for i in range(6)], "cell int, month date, p double"), "p", "z", [F.month("month")])
    assert {round(r.z, 9) for r in same.collect()} == {0.0}
    few = indices.spi(spark.createDataFrame(rows[:4], "cell int, month date, p double"), "p", "z", [F.month("month")])
    assert {r.z for r in few.collect()} == {None}


def test_bands_agree_with_the_range_join(spark):
    df = spark.createDataFrame([(x,) for x in (-3.0, -2.0, -1.0, 0.0, 1.0, 2.0, float("nan"), float("inf"), None)], "x double")
    case = df.select(bands.categorize(F.col("x"), bands.DROUGHT)).collect()
    assert [r[0] for r in case] == ["Extremely dry", "Severely dry", "Near normal", "Near normal", "Moderately wet", "Extremely wet", "", "", ""]


def test_regions():
    square = '{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}}'
    region = regions.resolve_region("r", boundary=square, buffer=0.5)
    assert (region.north, region.west, region.south, region.east) == (1.5, -0.5, -0.5, 1.5)
    assert regions.touched(region.rings, 0.5, 0.5, 0.1)  # inside
    assert regions.touched(region.rings, 1.04, 0.5, 0.1)  # over the edge
    assert regions.touched(region.rings, 0.5, 0.5, 9.0)  # around it all
    assert not regions.touched(region.rings, 1.2, 0.5, 0.1)
    kml = '<kml xmlns="http://www.opengis.net/kml/2.2"><Placemark><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0,0 2,0,0 2,2,0 0,0,0</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></kml>'
    assert regions.resolve_region("k", boundary=kml).rings == (((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)),)
    for bad in ({}, {"bbox": (1, 2, 3, 4), "boundary": square}):
        with pytest.raises(ValueError):
            regions.resolve_region("x", **bad)


def test_inventory(spark):
    assert inventory.months_between(spark, "2020-11-30", "2021-02-01").count() == 4
    gaps = spark.createDataFrame([("tp", 2020, m) for m in (1, 2, 3, 4, 7)] + [("t2m", 2020, 7)], "variable string, year int, month int")
    got = {tuple(r) for r in inventory.batches(gaps).collect()}
    assert got == {(2020, 1, 3, "tp"), (2020, 4, 4, "tp"), (2020, 7, 7, "t2m,tp")}
    with pytest.raises(KeyError):
        inventory.long_name("snow")


def test_wanted_indices():
    assert wanted_indices(["spi", "spei"], ["tp"]) == (["spi"], {"spei": {"t2m"}})
    with pytest.raises(ValueError):
        wanted_indices(["spy"], ["tp"])
    with pytest.raises(ValueError):
        Settings.from_mapping({"nonsense": 1})
    assert Settings.from_yaml("variables: [tp]\nperiod: ['1990-01-01', '1999-12-31']").baseline_years == (1990, 1999)


def test_indicators_are_isolated(spark):
    found = annual.compute(["frost_days", "nothing", "rain_days"], annual.Context(daily=spark.createDataFrame([(0, dt.date(2020, 1, 1), 1.0, 1.0, 1.0)], "cell int, day date, tmax double, tmin double, pr double")))
    assert list(found) == ["frost_days"]
    assert found["frost_days"].first()["value"] is None  # not a whole year


def test_whole_run_and_tables(spark, tmp_path):
    hours = spark.range(0, 24 * 366 * 6, 6).selectExpr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as ts", "id")
    raw = hours.selectExpr("explode(array(1, 2)) as cell", "ts", "280 + 10 * sin(id / 1000) + pmod(id, 7) as t2m", "cast(pmod(id * 37, 100) as double) / 1e5 * (hour(ts) + 1) as tp")
    cells = spark.createDataFrame([(1, 21.0, 79.0, True), (2, 21.1, 79.0, False)], "cell int, lat double, lon double, in_region boolean")
    run = Run(raw, cells, Settings(period=("2018-01-01", "2023-12-31"), indices=["all"], scales=(1, 3)))
    assert {r.cell for r in run.daily.select("cell").distinct().collect()} == {1}
    made = run.tables()
    assert {"spi", "spei", "eddi", "extremes", "temperature", "ai"} <= set(made)
    for name in ("spi", "spei", "weekly", "ai", "temperature", "extremes"):
        assert made[name].count() > 0
    tables.write_workbook({"pni": made["pni"]}, str(tmp_path / "book"), {"pni": "percent of normal"})
    assert tables.read_workbook(spark, str(tmp_path / "book"), ["pni"])["pni"].count() == made["pni"].count()
    stamped, meta = tables.stamp(run.anomalies, source="x", region="r", step="anomalies")
    assert stamped.schema["t2m_mean_anomaly"].metadata["long_name"].endswith("anomaly") and meta.count() == 1


def test_command_line(spark, tmp_path):
    from isohyet.cli import main

    hours = spark.range(0, 24 * 800, 6).selectExpr("timestamp_ntz'2019-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as valid_time", "id")
    long = hours.selectExpr("valid_time", "21.0D as latitude", "79.0D as longitude", "explode(map('t2m', 290D + pmod(id, 9), 'tp', pmod(id, 24) / 1e4)) as (variable, value)", "year(valid_time) as year", "month(valid_time) as month")
    tables.write_fields(long, str(tmp_path / "in"), partitions=["variable", "year", "month"])
    args = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--bbox", "22", "78", "20", "80", "--start", "2019-01-01", "--end", "2021-12-31"]
    assert main([*args, "--indices", "pni,pci"], spark) == 0
    assert tables.read_workbook(spark, str(tmp_path / "out/indices"), ["pni"])["pni"].count() > 20
    assert tables.read_workbook(spark, str(tmp_path / "out/indices_annual"), ["rx1day"])["rx1day"].count() >= 2
    summary = {r.Index: r for r in spark.read.option("header", True).csv(str(tmp_path / "out/indices_annual/summary")).collect()}
    assert summary["rx1day"].Units == "mm" and "rain_days" not in summary
    assert main(["plots", *args], spark) == 0  # again, from the saved tables
    drawn = tables.read_workbook(spark, str(tmp_path / "out/plots"), ["status", "pni_bars", "pci_bars"])
    assert {r["name"]: r.status for r in drawn["status"].collect()} == {"pni_bars": "written", "pci_bars": "written"}
    pni = drawn["pni_bars"].toPandas()
    assert pni.is_worst.sum() == pni.is_best.sum() == 1 and not pni.annual.any() and drawn["pci_bars"].first().annual
    assert pni.value[pni.is_worst].iloc[0] == pni.value.min() and (pni.display_value == pni.value).all()
    with pytest.raises(ValueError):
        main(["agromet", *args], spark)  # no dew point and no wind
    with pytest.raises(SystemExit):
        main([*args, "--indices", "nope"], spark)


def test_stream_equals_batch(spark, tmp_path):
    from isohyet.streaming.daily import daily_stream

    rows = spark.range(96).selectExpr("cast(id % 2 as int) as cell", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as ts", "cast(id as double) as x")
    rows.write.parquet(str(tmp_path / "in"))
    stream = daily_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), {"x": ["mean", "sum"]}, late="1 hour")
    query = stream.writeStream.format("memory").queryName("daily_out").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    want = {tuple(r) for r in daily_stream(rows, {"x": ["mean", "sum"]}).select("cell", "day", "x_mean", "x_sum").collect()}
    assert {tuple(r) for r in spark.sql("select cell, day, x_mean, x_sum from daily_out").collect()} == want


def test_one_decimal_is_that_of_the_binary_value(spark):
    draw = random.Random(4)
    xs = [0.0, 0.05, 0.15, 0.25, 0.35, 23.15, 2.5, 1e13 + 0.25, -0.04, -7.25, -7.35, 99.95] + [draw.choice([-1, 1]) * draw.randrange(10**6) / 20 for _ in range(3000)] + [draw.uniform(-1e4, 1e4) for _ in range(1000)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", tables.one_decimal(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [f"{r.x:.1f}" for r in rows]
