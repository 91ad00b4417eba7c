"""Registered queries of what runs write (isolated indicators, incremental sinks, workbooks, refused requests) and of boundaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.functions import bands, physics
from isohyet.functions.calendar import local_day
from isohyet.operators import annual, boundaries, daily, indices, normals, periods, regions
from isohyet.plans import catalogue, figures, plots, run
from isohyet.plans import fixtures as fx
from isohyet.plans.registry import ORACLE_SQL, query
from isohyet.sources import incremental, inventory, netcdf, shapefile, spreadsheet, tables, workbook


def _broken(ctx):
    """An indicator that can be planned and fails in its tasks."""
    return annual.REGISTRY["rx1day"](ctx).withColumn("value", F.when(F.col("year") > 0, F.raise_error(F.lit("no such field"))).cast("double"))


@query("isolated_indicators", " UNION ALL ".join(f"SELECT '{n}' AS name, 'written' AS status, COUNT(*) AS rows, ROUND(SUM(value), 4) AS total FROM ({ORACLE_SQL[n]})" for n in annual.REGISTRY) + " UNION ALL SELECT 'broken', 'failed', 0, NULL")
def isolated_indicators(spark, sf_dir):
    """All indicators, each a job of its own, beside one that fails in a task: the others are written and read back."""
    book = tables.new_folder(spark, "isolated")
    makers = annual.makers(["broken", *annual.REGISTRY], catalogue.indicator_context(spark, sf_dir), {"broken": _broken} | annual.REGISTRY)
    status = workbook.write_isolated(spark, book, makers)
    sums = None
    for name, df in workbook.read(spark, book).items():
        if name != "status":
            own = df.select(F.lit(name).alias("name"), "value")
            sums = own if sums is None else sums.unionAll(own)
    totals = sums.groupBy("name").agg(F.round(F.sum("value"), 4).alias("total"))
    return status.join(totals, "name", "left").select("name", "status", "rows", "total")


@query("incremental_rewrite", f"""WITH {fx.DAILY}, long AS (SELECT 'tp' AS variable, cell, day, tp + CASE WHEN year(day) = 1996 AND month(day) = 5 THEN 1 ELSE 0 END AS value FROM daily UNION ALL SELECT 'tmax', cell, day, tmax FROM daily)
SELECT variable, CAST(year(day) AS INTEGER) AS year, COUNT(*) AS rows, ROUND(SUM(value), 4) AS total, CASE WHEN variable = 'tp' AND year(day) = 1996 THEN 'changed' ELSE 'kept' END AS state FROM long GROUP BY variable, year(day)""")
def incremental_rewrite(spark, sf_dir):
    """Daily fields by variable and year, written twice; the second time one month has changed, and one partition is rewritten."""
    path = tables.new_folder(spark, "incremental")
    days = fx.daily_grid(spark, sf_dir)
    for more in (0.0, 1.0):
        tp = F.col("tp") + F.when((F.year("day") == 1996) & (F.month("day") == 5), more).otherwise(0.0)
        long = days.select("cell", "day", F.year("day").alias("year"), F.explode(F.map_from_arrays(F.array(F.lit("tp"), F.lit("tmax")), F.array(tp, "tmax"))).alias("variable", "value"))
        done = incremental.write_changed(long, path)
    sums = spark.read.parquet(f"{path}/fields").groupBy("variable", "year").agg(F.round(F.sum("value"), 4).alias("total"))
    return done.join(sums, ["variable", "year"]).select("variable", "year", "rows", "total", "state")


@query("workbook_kept_whole", ORACLE_SQL["workbook_round_trip"])
def workbook_kept_whole(spark, sf_dir):
    """A second version of a workbook fails in its last table; readers still see the whole first version."""
    path, months = tables.new_folder(spark, "workbook"), catalogue.monthly(spark, sf_dir)
    made = {"pni": indices.percent_of_normal(months, "tp", "value", [F.month("month")]), "departure": indices.departure(months, "tp", "value", [F.month("month")])}
    made = {n: t.select(F.lit(n).alias("name"), "cell", "month", F.round("value", 9).alias("value")) for n, t in made.items()}
    tables.write_workbook(made, path)
    worse = {n: t.withColumn("value", F.lit(-1.0)) for n, t in made.items()} | {"late": months.select(F.raise_error(F.concat(F.lit("no month "), F.col("month").cast("string"))).alias("x"))}
    try:
        tables.write_workbook(worse, path)
    except Exception as e:
        if "no month" not in str(e):
            raise
    one, two = workbook.read(spark, path).values()
    return one.unionByName(two)


_LIMITS = "limits AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(COUNT(*) % 3 AS INTEGER) AS most FROM orders GROUP BY 1)"


@query("split_requests", ORACLE_SQL["download_batches"].replace("WITH ", f"WITH RECURSIVE {_LIMITS}, ", 1).replace("SELECT year, MIN(month) AS first_month", ", asked AS (SELECT year, MIN(month) AS first_month").replace("isl, b", "isl, b)") + """,
request(year, first_month, last_month, v, most, depth) AS (
 SELECT year, CAST(first_month AS INTEGER), CAST(last_month AS INTEGER), string_split(variables, ','), most, 0 FROM asked LEFT JOIN limits USING (year) UNION ALL
 SELECT year, part.a, part.b, part.v, most, depth + 1 FROM (SELECT year, most, depth, UNNEST(CASE WHEN last_month > first_month THEN list_transform(range(first_month, last_month + 1), lambda m: {'a': CAST(m AS INTEGER), 'b': CAST(m AS INTEGER), 'v': v})
  ELSE [{'a': first_month, 'b': last_month, 'v': v[1:len(v) // 2]}, {'a': first_month, 'b': last_month, 'v': v[len(v) // 2 + 1:]}] END) AS part FROM request WHERE (last_month - first_month + 1) * len(v) > most AND (last_month > first_month OR len(v) > 1)))
SELECT year, first_month, last_month, array_to_string(v, ',') AS variables, depth, COALESCE(len(v) > most, FALSE) AS refused FROM request
WHERE most IS NULL OR (last_month - first_month + 1) * len(v) <= most OR (last_month = first_month AND len(v) = 1)""")
def split_requests(spark, sf_dir):
    """Batches of missing months against limits by year: orders modulo three stand for the most files of a request."""
    limits = fx.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg((F.count("*") % 3).alias("most"))
    return inventory.split_refused(catalogue.download_batches(spark, sf_dir), limits)


# --- boundaries: a diamond with a square hole for each nation, over cells of customers ------------------

_STEP = 0.125
_CORNERS = {"outer": [(1, 0), (0, 1), (-1, 0), (0, -1)], "hole": [(0.25, 0.25), (-0.25, 0.25), (-0.25, -0.25), (0.25, -0.25)]}
_SIDES = [(a, b) for ring in _CORNERS.values() for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]


def _centres(spark, sf_dir):
    k = F.col("s_nationkey")
    shape = fx.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(((F.count("*") % 4 + 3) / 8).alias("r"))
    return shape.select(k.cast("string").alias("polygon"), (77.5 + (k % 5) * 0.25).alias("x"), (19.5 + F.floor(k / 5) * 0.25).alias("y"), "r")


def _shapes(spark, sf_dir):
    """EDGES: centres a quarter of a degree apart, half as wide as 3 to 6 cells by the number of suppliers; they overlap."""
    side = lambda a, b: F.struct(*((F.col(c) + F.lit(float(v)) * F.col("r")).alias(n) for c, v, n in (("x", a[0], "x1"), ("y", a[1], "y1"), ("x", b[0], "x2"), ("y", b[1], "y2"))))
    return _centres(spark, sf_dir).select("polygon", F.inline(F.array(*(side(a, b) for a, b in _SIDES))))


def _customer_cells(spark, sf_dir):
    """(cell, lat, lon, balance): 40 by 40 cells by customer key."""
    cell = F.pmod(F.col("c_custkey"), F.lit(1600)).cast("int").alias("cell")
    sums = fx.table(spark, sf_dir, "customer").groupBy(cell).agg(F.sum("c_acctbal").alias("balance"))
    return sums.select("cell", (18.0 + F.floor(F.col("cell") / 40) * _STEP).alias("lat"), (76.0 + F.col("cell") % 40 * _STEP).alias("lon"), "balance")


def _clip_sql(a: str, b: str, lo: str, hi: str) -> tuple[str, str, str]:
    t = [f"({side} - {a}) / NULLIF({b} - {a}, 0)" for side in (lo, hi)]
    return f"COALESCE(least({t[0]}, {t[1]}), 0)", f"COALESCE(greatest({t[0]}, {t[1]}), 1)", f"({a} <> {b} OR {a} BETWEEN {lo} AND {hi})"


_XS, _YS = _clip_sql("x1", "x2", "(lon - 0.0625::DOUBLE)", "(lon + 0.0625::DOUBLE)"), _clip_sql("y1", "y2", "(lat - 0.0625::DOUBLE)", "(lat + 0.0625::DOUBLE)")
_BOUNDARY_SQL = f"""shape AS (SELECT CAST(s_nationkey AS VARCHAR) AS polygon, 77.5::DOUBLE + s_nationkey % 5 * 0.25::DOUBLE AS x, 19.5::DOUBLE + s_nationkey // 5 * 0.25::DOUBLE AS y, (COUNT(*) % 4 + 3) / 8 AS r FROM supplier GROUP BY s_nationkey),
edge AS (SELECT polygon, UNNEST([{", ".join(f"{{'x1': x + {a[0]}::DOUBLE * r, 'y1': y + {a[1]}::DOUBLE * r, 'x2': x + {b[0]}::DOUBLE * r, 'y2': y + {b[1]}::DOUBLE * r}}" for a, b in _SIDES)}], recursive := true) FROM shape),
grid AS (SELECT CAST(c_custkey % 1600 AS INTEGER) AS cell, 18.0::DOUBLE + cell // 40 * 0.125::DOUBLE AS lat, 76.0::DOUBLE + cell % 40 * 0.125::DOUBLE AS lon, SUM(c_acctbal) AS balance FROM customer GROUP BY 1),
tested AS (SELECT polygon, cell, lat, lon, balance, COUNT(*) FILTER ((y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / NULLIF(y2 - y1, 0) + x1) % 2 = 1 AS inside,
 BOOL_OR({_XS[2]} AND {_YS[2]} AND greatest(0, {_XS[0]}, {_YS[0]}) <= least(1, {_XS[1]}, {_YS[1]})) AS touched FROM grid, edge GROUP BY ALL)"""


@query("boundary_members", f"WITH {_BOUNDARY_SQL} SELECT polygon, cell FROM tested WHERE inside OR touched")
def boundary_members(spark, sf_dir):
    """Cells of each of many overlapping polygons with holes."""
    return boundaries.members(_customer_cells(spark, sf_dir), _shapes(spark, sf_dir), boundaries.Grid(_STEP)).select("polygon", "cell")


@query("boundary_union", f"WITH {_BOUNDARY_SQL} SELECT cell, lat, lon, ROUND(balance, 4) AS balance, BOOL_OR(inside OR touched) AS in_region FROM tested GROUP BY ALL")
def boundary_union(spark, sf_dir):
    """All cells, and whether they touch any polygon."""
    marked = boundaries.mark_region(_customer_cells(spark, sf_dir), _shapes(spark, sf_dir), boundaries.Grid(_STEP))
    return marked.select("cell", "lat", "lon", F.round("balance", 4).alias("balance"), "in_region")


_NATION_GRID = "grid AS (SELECT DISTINCT CAST(s_nationkey AS INTEGER) AS cell, 19.5::DOUBLE + s_nationkey // 5 * 0.125::DOUBLE AS lat, 77.5::DOUBLE + s_nationkey % 5 * 0.125::DOUBLE AS lon, 0 AS balance FROM supplier)"


@query("boundary_means", f"WITH {fx.DAILY}, {_BOUNDARY_SQL.split('grid AS')[0]}{_NATION_GRID},\ntested AS{_BOUNDARY_SQL.split('tested AS')[1]} SELECT polygon, day, COUNT(*) AS n_cells, ROUND(AVG(tp), 9) AS tp FROM daily JOIN tested USING (cell) WHERE inside OR touched GROUP BY polygon, day")
def boundary_means(spark, sf_dir):
    """Daily means of each polygon over a grid of one cell for each nation."""
    days = fx.daily_grid(spark, sf_dir)
    k = F.col("s_nationkey")
    cells = fx.table(spark, sf_dir, "supplier").select(k.cast("int").alias("cell"), (19.5 + F.floor(k / 5) * _STEP).alias("lat"), (77.5 + k % 5 * _STEP).alias("lon")).distinct()
    out = boundaries.polygon_means(days, cells, _shapes(spark, sf_dir), boundaries.Grid(_STEP), ["tp"])
    return out.select("polygon", "day", "n_cells", F.round("tp", 9).alias("tp"))


_BOTH = "COUNT(t) AS n_t, ROUND(AVG(t), 9) AS t_mean, ROUND(MAX(t), 9) AS t_max, ROUND(SUM(tp), 9) AS tp_sum, ROUND(MAX(sqrt(u * u + v * v)), 9) AS wind_max"


@query("days_in_one_pass", f"WITH {fx.MET} SELECT 'utc' AS kind, cell, CAST(ts AS DATE) AS day, {_BOTH} FROM met GROUP BY cell, CAST(ts AS DATE) UNION ALL SELECT 'local', cell, CAST(ts + INTERVAL 330 MINUTE AS DATE), {_BOTH} FROM met GROUP BY cell, CAST(ts + INTERVAL 330 MINUTE AS DATE)")
def days_in_one_pass(spark, sf_dir):
    """Fields of UTC days and of local days from one grouping of the hourly rows."""
    outputs = [F.count("t").alias("n_t"), *daily.daily_outputs({"t": ["mean", "max"], "tp": ["sum"]}), F.max(physics.wind_speed(F.col("u"), F.col("v"))).alias("wind_max")]
    out = daily.by_kinds_of_day(fx.met_hourly(spark, sf_dir), {"utc": F.col("ts").cast("date"), "local": local_day(F.col("ts"))}, outputs)
    return out.select("kind", "cell", "day", "n_t", *[F.round(c, 9).alias(c) for c in ("t_mean", "t_max", "tp_sum", "wind_max")])


@query("netcdf_round_trip", f"WITH {fx.HOURLY} SELECT variable, ts, lat, lon, value FROM (SELECT UNNEST(['tp', 'accum']) AS variable, ts, CAST(20 + cell AS DOUBLE) AS lat, CAST(78 AS DOUBLE) AS lon, CAST(UNNEST([v, accum]) AS DOUBLE) AS value FROM hourly)")
def netcdf_round_trip(spark, sf_dir):
    """Hourly fields of two variables as gridded files, and back."""
    path = tables.new_folder(spark, "netcdf")
    long = fx.hourly_grid(spark, sf_dir).select(F.explode(F.map_from_arrays(F.array(F.lit("tp"), F.lit("accum")), F.array("v", "accum"))).alias("variable", "value"), "ts", (20.0 + F.col("cell")).alias("lat"), F.lit(78.0).alias("lon"))
    netcdf.write(long, path)
    return netcdf.read(spark, path).where("value is not null")


@query("netcdf_slab", f"WITH {fx.HOURLY} SELECT ts, lat, value FROM (SELECT ts, CAST(20 + cell AS DOUBLE) AS lat, CAST(v AS DOUBLE) AS value FROM hourly) WHERE lat BETWEEN 22 AND 24 AND hour(ts) = 6")
def netcdf_slab(spark, sf_dir):
    """One variable of some rows of the grid: the reader takes both down to the files' indices."""
    path = tables.new_folder(spark, "netcdf")
    long = fx.hourly_grid(spark, sf_dir).select(F.explode(F.map_from_arrays(F.array(F.lit("tp"), F.lit("accum")), F.array("v", "accum"))).alias("variable", "value"), "ts", (20.0 + F.col("cell")).alias("lat"), F.lit(78.0).alias("lon"))
    netcdf.write(long, path, tile=2.0)
    return netcdf.read(spark, path).where("variable = 'tp' and lat >= 22 and lat <= 24 and value is not null and hour(ts) = 6").select("ts", "lat", "value")


# --- figures' tables from saved tables, scans, sinks and requests ---------------------------------------------


def _saved_departure(spark, sf_dir) -> dict:
    """A workbook of departures from normal over all cells, written and read back."""
    path = tables.new_folder(spark, "saved")
    area = daily.area_mean(fx.daily_grid(spark, sf_dir), ["tp"]).withColumn("cell", F.lit(0))
    made = indices.departure(periods.monthly(area, sums=["tp"]), "tp", "x", [F.month("month")]).select("month", F.round("x", 7).alias("departure_pct"))
    tables.write_workbook({"imd-departure": made.withColumn("departure_pct_category", bands.categorize(F.col("departure_pct"), bands.DEPARTURE))}, path)
    return workbook.read(spark, path)


_AREA_DEPARTURE = f"{fx.DAILY}, a AS (SELECT day, AVG(tp) AS tp FROM daily GROUP BY day), am AS (SELECT CAST(date_trunc('month', day) AS DATE) AS date, SUM(tp) AS tp FROM a GROUP BY 1), p AS (SELECT date, ROUND((tp - AVG(tp) OVER w) / NULLIF(AVG(tp) OVER w, 0) * 100, 7) AS v FROM am WINDOW w AS (PARTITION BY month(date)))"


@query("plots_from_saved_tables", f"WITH {_AREA_DEPARTURE}, k AS (SELECT min_by(date, (v, date)) AS lo, max_by(date, (v, -epoch(date))) AS hi FROM p WHERE v IS NOT NULL) SELECT date, v AS value, least(greatest(v, -100), 150) AS display_value, {bands.sql_case('v', bands.DEPARTURE)} AS category, date = lo AS is_worst, date = hi AS is_best, FALSE AS annual FROM p, k WHERE v IS NOT NULL")
def plots_from_saved_tables(spark, sf_dir):
    """Bars of an index as a figure shows them, from the saved table alone."""
    return plots.makers(_saved_departure(spark, sf_dir))["imd-departure_bars"]()


@query("plot_month_map", f"""WITH {fx.DAILY}, nm AS (SELECT cell, dayofyear(day) AS doy, AVG(tp) AS n FROM daily GROUP BY 1, 2), an AS (SELECT daily.cell, day, CASE WHEN n > 0 THEN tp / n * 100 END AS pct FROM daily JOIN nm ON nm.cell = daily.cell AND nm.doy = dayofyear(day)),
am AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, SUM(tp) AS tp FROM daily GROUP BY 1), k AS (SELECT min_by(month, (tp, month)) AS month FROM am), f AS (SELECT month, cell, AVG(pct) - 100 AS value FROM an JOIN k ON date_trunc('month', day) = month GROUP BY 1, 2)
SELECT month, cell, 20 + cell // 5 * 0.1::DOUBLE AS lat, 78 + cell % 5 * 0.1::DOUBLE AS lon, ROUND(value, 7) AS value, ROUND(MAX(abs(value)) OVER (), 7) AS scale FROM f""")
def plot_month_map(spark, sf_dir):
    """Departures of the driest month on a map, with the bound of its colours."""
    days = fx.daily_grid(spark, sf_dir)
    pct = normals.anomalies(days, normals.doy_normals(days, ["tp"], (1900, 2100)), ["tp"], percent_of="tp").withColumnRenamed("tp_pct_of_normal", "pct")
    sums = days.groupBy(F.trunc("day", "month").alias("month")).agg(F.sum("tp").alias("tp")).withColumn("all", F.lit(1))
    month = figures.extremes(sums, "tp", by=["all"]).select(F.col("at_min").alias("month"))
    k = F.col("s_nationkey")
    cells = fx.table(spark, sf_dir, "supplier").select(k.cast("int").alias("cell"), (20 + F.floor(k / 5) * 0.1).alias("lat"), (78 + k % 5 * 0.1).alias("lon")).distinct()
    return plots.month_map(pct, cells, "pct", month, F.col("mean") - 100.0).withColumns({c: F.round(c, 7) for c in ("value", "scale")})


@query("area_series_scan", f"WITH {fx.DAILY} SELECT day, ROUND(AVG(tp), 9) AS tp, ROUND(AVG(tmean), 9) AS tmean FROM daily WHERE year(day) BETWEEN 1995 AND 1998 GROUP BY day")
def area_series_scan(spark, sf_dir):
    """Daily fields in a sink by year; a scan of some years gives the series of area means."""
    path = tables.new_folder(spark, "series")
    tables.write_fields(fx.daily_grid(spark, sf_dir).withColumn("year", F.year("day")), path, partitions=["year"])
    return daily.area_mean(tables.read_years(spark, path, (1995, 1998)), ["tp", "tmean"]).select("day", F.round("tp", 9).alias("tp"), F.round("tmean", 9).alias("tmean"))


@query("boundary_file_scan", f"WITH {_BOUNDARY_SQL} SELECT polygon, cell FROM tested WHERE inside OR touched")
def boundary_file_scan(spark, sf_dir):
    """A boundary file in KML with names and holes, written, scanned and joined with cells."""
    path = tables.new_folder(spark, "boundary")
    text = lambda ring: F.concat_ws(" ", *(F.concat_ws(",", *(F.expr(f"cast({c} + {float(v)!r} * r as string)") for c, v in zip("xy", p, strict=True))) for p in _CORNERS[ring]))
    wrap = lambda ring, tag: F.concat(F.lit(f"<{tag}><LinearRing><coordinates>"), text(ring), F.lit(f"</coordinates></LinearRing></{tag}>"))
    marks = _centres(spark, sf_dir).select(F.concat(F.lit("<Placemark><name>"), "polygon", F.lit("</name><Polygon>"), wrap("outer", "outerBoundaryIs"), wrap("hole", "innerBoundaryIs"), F.lit("</Polygon></Placemark>")).alias("mark"))
    whole = marks.agg(F.concat(F.lit("<kml>"), F.array_join(F.collect_list("mark"), ""), F.lit("</kml>")).alias("value"))  # a mark for each nation
    whole.write.text(path)
    polygons = boundaries.read_polygons(spark.read.text(path, wholetext=True).first()["value"])
    found = boundaries.members(_customer_cells(spark, sf_dir), boundaries.edges(spark, polygons), boundaries.Grid(_STEP))
    return found.select(F.split_part("polygon", F.lit(":"), F.lit(2)).alias("polygon"), "cell")


@query("bbox_cells", f"WITH {_BOUNDARY_SQL} SELECT cell, lat, lon FROM grid WHERE lat BETWEEN 19 AND 21 AND lon BETWEEN 77 AND 79.5")
def bbox_cells(spark, sf_dir):
    """Cells of a bounding box."""
    box = regions.resolve_region("box", bbox=(21, 77, 19, 79.5))
    cells = _customer_cells(spark, sf_dir).where(F.col("lat").between(box.south, box.north) & F.col("lon").between(box.west, box.east))
    return cells.select("cell", "lat", "lon")


@query("summary_csv_round_trip", ORACLE_SQL["index_summary"].replace("SELECT index, ROUND(AVG(value), 5) AS mean, ROUND(MIN(value), 5) AS min, ROUND(MAX(value), 5) AS max,", "SELECT index AS \"Index\", printf('%.1f', AVG(value)) AS \"Mean\", printf('%.1f', MIN(value)) AS \"Min\", printf('%.1f', MAX(value)) AS \"Max\",").replace("END AS units", "END AS \"Units\""))
def summary_csv_round_trip(spark, sf_dir):
    """The summary of indicators as a CSV file with one decimal, and back."""
    path = tables.new_folder(spark, "summary")
    tables.write_summary_csv(annual.summary(annual.compute(["frost_days", "rx1day", "r95p", "summer_days"], catalogue.indicator_context(spark, sf_dir))), path)
    return spark.read.option("header", True).csv(path)


@query("stamped_columns", f"WITH {fx.DAILY}, n AS (SELECT COUNT(tp) AS tp, COUNT(tmean) AS t FROM daily) SELECT 'tp_sum' AS name, 'mm' AS units, 'total precipitation' AS long_name, tp AS n FROM n UNION ALL SELECT 't2m_mean_anomaly', 'degC', '2 metre temperature anomaly', t FROM n")
def stamped_columns(spark, sf_dir):
    """Units and names that fields keep in the Parquet schema, with the values of each field."""
    path = tables.new_folder(spark, "stamped")
    fields = fx.daily_grid(spark, sf_dir).select("cell", "day", F.col("tp").alias("tp_sum"), F.col("tmean").alias("t2m_mean_anomaly"))
    stamped, _ = tables.stamp(fields, source="lineitem", region="all", step="daily")
    stamped.write.parquet(path)
    back = spark.read.parquet(path)
    told = [f for f in back.schema if f.metadata]
    rows = F.array(*(F.struct(F.lit(f.name).alias("name"), F.lit(f.metadata["units"]).alias("units"), F.lit(f.metadata["long_name"]).alias("long_name"), F.col(f"n_{f.name}").alias("n")) for f in told))
    return back.agg(*(F.count(f.name).alias(f"n_{f.name}") for f in told)).select(F.inline(rows))


_WANTS = {"spi": ["tp"], "spei": ["t2m", "tp"], "eddi": ["t2m"], "temperature": ["t2m"], "pni": ["tp"]}


@query("gated_indices", f"WITH {fx.INVENTORY}, y AS (SELECT year, list_sort(list(DISTINCT variable)) AS v FROM (SELECT year, variable FROM have GROUP BY 1, 2 HAVING COUNT(*) >= 6) GROUP BY 1), i AS (SELECT UNNEST([" + ", ".join(f"{{'index': '{n}', 'needs': {v}}}" for n, v in _WANTS.items()) + "], recursive := true)) SELECT year, index, list_has_all(v, needs) AS planned, array_to_string(list_filter(needs, lambda x: NOT list_contains(v, x)), ',') AS lacks FROM y, i")
def gated_indices(spark, sf_dir):
    """Which indices each year's variables allow: those with files of six months at least; what the others lack."""
    found = fx.file_inventory(spark, sf_dir).groupBy("year", "variable").count().where("count >= 6").groupBy("year").agg(F.collect_set("variable").alias("v"))
    per_year = {}
    for have in {tuple(sorted(r.v)) for r in found.select("v").distinct().collect()}:  # of three variables
        planned, lacks = run.wanted_indices(list(_WANTS), have)
        per_year[have] = [(n, n in planned, ",".join(sorted(lacks.get(n, ())))) for n in _WANTS]
    rows = spark.createDataFrame([(",".join(v), *r) for v, rs in per_year.items() for r in rs], "v string, index string, planned boolean, lacks string")
    return found.withColumn("v", F.array_join(F.array_sort("v"), ",")).join(F.broadcast(rows), "v").select("year", "index", "planned", "lacks")


@query("shapefile_scan", f"WITH {_BOUNDARY_SQL}, box AS (SELECT polygon, MAX(x1) AS east, MIN(y1) AS south FROM edge GROUP BY 1) SELECT polygon, cell FROM tested JOIN box USING (polygon) WHERE (inside OR touched) AND east >= 78 AND south < 20")
def shapefile_scan(spark, sf_dir):
    """Polygons of a shapefile whose boxes reach a corner of the map, joined with cells."""
    path = f"{tables.new_folder(spark, 'shapes')}/nations.shp"
    at = lambda c, p: (c.x + p[0] * c.r, c.y + p[1] * c.r)
    shapefile.write([(c.polygon, [[at(c, p) for p in ring] for ring in _CORNERS.values()]) for c in _centres(spark, sf_dir).collect()], path)  # a shape for each nation
    edges = shapefile.read(spark, path).where("east >= 78 and south < 20")
    found = boundaries.members(_customer_cells(spark, sf_dir), edges, boundaries.Grid(_STEP))
    return found.select(F.split_part("polygon", F.lit(":"), F.lit(2)).alias("polygon"), "cell")


@query("spreadsheet_round_trip", ORACLE_SQL["workbook_round_trip"])
def spreadsheet_round_trip(spark, sf_dir):
    """Two result tables as sheets of one spreadsheet file, and back; of the sheets' columns three are read."""
    path, months = f"{tables.new_folder(spark, 'spreadsheet')}/indices.xlsx", catalogue.monthly(spark, sf_dir)
    made = {"pni": indices.percent_of_normal(months, "tp", "value", [F.month("month")]), "departure": indices.departure(months, "tp", "value", [F.month("month")])}
    spreadsheet.write({n: t.select(F.lit(f"{n} & more").alias("note"), "month", "cell", F.round("value", 9).alias("value")) for n, t in made.items()}, path)
    one, two = (spreadsheet.read(spark, path, n, "cell int, month date, value double").select(F.lit(n).alias("name"), "cell", "month", "value") for n in made)
    return one.unionAll(two)
