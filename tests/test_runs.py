"""What runs write: isolation, versions, incremental sinks, split requests, percentiles by day of the year."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from isohyet.operators import annual
from isohyet.sources import incremental, inventory, workbook


def numbers(spark, n, **more):
    return spark.range(n).select("id", *[F.lit(v).alias(k) for k, v in more.items()])


def failing(spark):
    return spark.range(3).select(F.raise_error(F.concat(F.lit("bad row "), F.col("id").cast("string"))).alias("id"))


def test_a_table_that_fails_in_a_task_stops_no_other(spark, tmp_path):
    def unplanned():
        raise KeyError("no field")

    makers = {"broken": lambda: failing(spark), "unplanned": unplanned} | {f"t{k}": (lambda k=k: numbers(spark, k)) for k in range(15)}
    status = {r.name: r for r in workbook.write_isolated(spark, str(tmp_path), makers).collect()}
    assert {n for n, r in status.items() if r.status == "failed"} == {"broken", "unplanned"}
    assert "bad row" in status["broken"].error and "no field" in status["unplanned"].error
    found = workbook.read(spark, str(tmp_path))
    assert set(found) == {"status", *(f"t{k}" for k in range(15))}
    assert all(found[f"t{k}"].count() == k == status[f"t{k}"].rows for k in range(15))


def test_a_failed_version_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        workbook.read(spark, path)
    workbook.write(spark, path, {n: lambda: numbers(spark, 5) for n in "abc"}, {"a": "first"})
    with pytest.raises(Exception, match="bad row"):
        workbook.write(spark, path, {"a": lambda: numbers(spark, 9), "b": lambda: numbers(spark, 9), "c": lambda: failing(spark)})
    assert {n: t.count() for n, t in workbook.read(spark, path).items()} == dict.fromkeys("abc", 5)
    assert workbook.manifest(spark, path)["a"][1] == "first"
    assert len(list((tmp_path / "tables").iterdir())) == 1
    for n in (6, 7, 8):
        workbook.write(spark, path, {"a": lambda n=n: numbers(spark, n)})
    assert workbook.read(spark, path)["a"].count() == 8 and workbook.versions(spark, path) == [3, 4]
    assert len(list((tmp_path / "tables").iterdir())) == 2  # the version before stays for its readers


def test_two_writers_publish_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    workbook.write(spark, path, {"a": lambda: numbers(spark, 1)})
    monkeypatch.setattr(workbook, "versions", lambda *_: [])  # this writer has not seen the other's version
    with pytest.raises(Exception, match="exist"):
        workbook.write(spark, path, {"a": lambda: numbers(spark, 2)})
    monkeypatch.undo()
    assert workbook.read(spark, path)["a"].count() == 1


def fields(spark, rows):
    return spark.createDataFrame(rows, "variable string, year int, day int, value double")


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (path / "fields").rglob("*.parquet")}


def test_one_changed_month_rewrites_one_year(spark, tmp_path):
    rows = [(v, y, d, float(d)) for v in ("t", "p/q") for y in (2000, 2001, 2002) for d in range(50)]
    state = lambda df: {(r.variable, r.year): r.state for r in df.collect()}
    assert set(state(incremental.write_changed(fields(spark, rows), str(tmp_path))).values()) == {"new"}
    before = files(tmp_path)
    random.Random(1).shuffle(rows)
    assert set(state(incremental.write_changed(fields(spark, rows).repartition(7), str(tmp_path))).values()) == {"kept"}
    assert files(tmp_path) == before
    changed = [(v, y, d, x + (v == "t" and y == 2001 and d < 31)) for v, y, d, x in rows if (v, y) != ("p/q", 2002)] + [("t", 2003, 1, None), ("t", None, 1, 2.0)]
    found = state(incremental.write_changed(fields(spark, changed), str(tmp_path)))
    assert {k: v for k, v in found.items() if v != "kept"} == {("t", 2001): "changed", ("p/q", 2002): "gone", ("t", 2003): "new", ("t", None): "new"}
    after = files(tmp_path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "variable=t/year=2001" in f or "q/year=2002" in f}
    back = spark.read.parquet(f"{tmp_path}/fields").select("variable", "year", "day", "value")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(changed, key=repr)


def test_digests_tell_rows_apart(spark):
    digest = lambda rows: [r.digest for r in incremental.digests(fields(spark, rows), ["variable", "year"]).collect()][0]
    one = ("t", 1, 1, 1.0)
    assert len({digest(x) for x in ([one], [one, one], [one] * 3, [("t", 1, 1, None)], [("t", 1, None, 1.0)], [("t", 1, 2, 1.0)])}) == 6
    assert digest([one, ("t", 1, 2, 3.0)]) == digest([("t", 1, 2, 3.0), one])


def split(months, variables, most):
    """Leaves of one request, by the rule in words."""
    if most is None or len(months) * len(variables) <= most:
        return [(months, variables, False)]
    if len(months) > 1:
        return [x for m in months for x in split([m], variables, most)]
    if len(variables) == 1:
        return [(months, variables, True)]
    half = len(variables) // 2
    return split(months, variables[:half], most) + split(months, variables[half:], most)


def test_refused_requests_are_split(spark):
    names = ["a", "b", "c", "d", "e", "f", "g"]
    asked = [(2000 + k, 2, 2 + k % 3, ",".join(names[: 1 + k % 7])) for k in range(30)]
    limits = [(2000 + k, k % 8 - 1) for k in range(29)]
    frame = spark.createDataFrame(asked, "year int, first_month int, last_month int, variables string")
    found = inventory.split_refused(frame, spark.createDataFrame(limits, "year int, most int"))
    want = [(y, m[0], m[-1], ",".join(v), bad) for y, a, b, names_ in asked for m, v, bad in split(list(range(a, b + 1)), names_.split(","), dict(limits).get(y))]
    assert sorted((r.year, r.first_month, r.last_month, r.variables, r.refused) for r in found.collect()) == sorted(want)
    assert inventory.split_refused(frame.where("false"), spark.createDataFrame(limits, "year int, most int")).collect() == []


def test_percentiles_around_a_day(spark):
    draw = random.Random(3)
    days = [dt.date(2001, 1, 1) + dt.timedelta(d) for d in range(3 * 365)]  # no leap year: day 366 has neighbours alone
    rows = [(c, d, draw.choice([None, 1.5, 2.0, -3.25, draw.random()])) for c in (1, 2) for d in days if c == 1 or d.month in (1, 6)]
    base = spark.createDataFrame(rows, "cell int, day date, x double")
    pools = {}
    for c, d, x in rows:
        for s in range(-2, 3):
            if x is not None:
                pools.setdefault((c, (d.timetuple().tm_yday - 1 + s) % 366 + 1), []).append(x)
    for p in (0.0, 0.1, 0.9, 1.0):
        found = {(r.cell, r.doy): r.threshold for r in annual.percentile_by_doy(base, "x", p, by=["cell"]).collect()}
        assert set(found) == set(pools)
        for k, xs in pools.items():
            xs, h = sorted(xs), min(max((len(xs) + 1 / 3) * p + 1 / 3, 1), len(xs))
            low = int(h)
            assert found[k] == pytest.approx(xs[low - 1] + (h - low) * (xs[min(low, len(xs) - 1)] - xs[low - 1]))


def test_no_indicator_has_no_summary():
    with pytest.raises(ValueError):
        annual.summary({})


def raw_hours(spark, days=40):
    """Two cells, all variables in raw units; running totals restart at 01:00; some values are missing."""
    hours = spark.range(0, 24 * days).selectExpr("timestamp_ntz'2020-12-10 00:00:00' + make_dt_interval(0, cast(id as int)) as ts", "id").withColumn("cell", F.explode(F.array(F.lit(1), F.lit(2))))
    total = "cast(pmod(id - 1, 24) + 1 as double) * pmod(cell * 7 + floor((id - 1) / 24) * 13, 11)"
    return hours.selectExpr(
        "cell", "ts", "if(pmod(id, 97) = 5, null, 285 + 8 * sin(id / 3.8) + cell) as t2m", "283 + 5 * sin(id / 5.1) as d2m", f"{total} / 1e5 as tp",
        "3 * cos(id / 7.0) as u10", "9 * sin(id / 11.0) as v10", f"{total} * 1e4 as ssrd", "97000 + 10 * pmod(id, 5) as sp",
    )


@pytest.mark.parametrize("variables", [("t2m", "tp"), ("t2m", "d2m", "u10", "v10"), ("t2m", "d2m", "u10", "v10", "tp", "ssrd", "sp")])
def test_one_pass_gives_the_same_fields(spark, tmp_path, variables):
    from isohyet.plans.config import Settings
    from isohyet.plans.run import Run

    hourly = raw_hours(spark).select("cell", "ts", *variables)
    cells = spark.createDataFrame([(1, 21.0, 79.0, True), (2, 21.5, 79.0, True)], "cell int, lat double, lon double, in_region boolean")
    settings = Settings(variables=variables, period=("2020-01-01", "2021-12-31"))
    apart, kept = Run(hourly, cells, settings), Run(hourly, cells, settings, store=str(tmp_path))
    names = ["daily", "demand", *(["agromet"] if apart.has_agromet else [])]
    for name in names:
        one, two = ({(r.day, r.cell): r.asDict() for r in getattr(run, name).collect()} for run in (apart, kept))
        assert set(one) == set(two) and len(one) > 20
        for key, row in one.items():
            assert {k: v if v is None or k == "day" else pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in row.items()} == two[key]


def test_one_pass_scans_and_shuffles_once(spark, tmp_path):
    from isohyet.plans.config import Settings
    from isohyet.plans.run import Run

    raw_hours(spark, 3).write.parquet(f"{tmp_path}/hours")
    cells = spark.createDataFrame([(1, 21.0, 79.0, True)], "cell int, lat double, lon double, in_region boolean")
    run = Run(spark.read.parquet(f"{tmp_path}/hours"), cells, Settings(variables=("t2m", "d2m", "u10", "v10", "tp", "ssrd", "sp")))
    plan = run._fields._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
