"""The registered queries over the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions import bands, physics, special
from isohyet.operators import annual, daily, indices, normals, periods, regions
from isohyet.plans import figures
from isohyet.plans import fixtures as fx
from isohyet.plans.registry import ORACLE_SQL, QUERIES, query
from isohyet.sources import inventory, tables, workbook

BASELINE = (1995, 1999)


def rounded(column, name: str | None = None):
    c = F.round(F.col(column) if isinstance(column, str) else column, 9)
    return c.alias(name or column)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.monthly(fx.daily_grid(spark, sf_dir), sums=["tp"], means=["tmean"])



def month_of():
    return F.month("month")

# --- monthly rainfall indices -----------------------------------------------------------------------


@query("pni_monthly_category", f"""WITH {fx.MONTHLY}, i AS (SELECT *, tp / NULLIF(AVG(tp) OVER (PARTITION BY cell, month(month)), 0) * 100 AS pni FROM monthly)
SELECT cell, month, tp, n_days, ROUND(pni, 9) AS pni, {bands.sql_case('pni', bands.PNI)} AS category FROM i""")
def pni_monthly_category(spark, sf_dir):
    out = indices.percent_of_normal(monthly(spark, sf_dir), "tp", "pni", [month_of()])
    return out.select("cell", "month", "tp", F.col("n_days").cast("long").alias("n_days"), rounded("pni"), bands.categorize(F.col("pni"), bands.PNI).alias("category"))


_DEPARTURE = "(tp - AVG(tp) OVER w) / NULLIF(AVG(tp) OVER w, 0) * 100"


@query("imd_departure_monthly", f"""WITH {fx.MONTHLY}, i AS (SELECT *, {_DEPARTURE} AS departure FROM monthly WINDOW w AS (PARTITION BY cell, month(month)))
SELECT cell, month, tp, ROUND(departure, 9) AS departure, {bands.sql_case('departure', bands.DEPARTURE)} AS category FROM i""")
def imd_departure_monthly(spark, sf_dir):
    out = indices.departure(monthly(spark, sf_dir), "tp", "departure", [month_of()])
    return out.select("cell", "month", "tp", rounded("departure"), bands.categorize(F.col("departure"), bands.DEPARTURE).alias("category"))


@query("category_range_join", f"""WITH {fx.MONTHLY}, i AS (SELECT *, {_DEPARTURE} AS departure FROM monthly WINDOW w AS (PARTITION BY cell, month(month))),
b(low, high, label) AS (VALUES {", ".join(f"('{a}'::DOUBLE, '{b}'::DOUBLE, '{c}')" for a, b, c in bands.DEPARTURE)})
SELECT cell, month, ROUND(departure, 9) AS departure, COALESCE(label, '') AS category FROM i LEFT JOIN b ON departure >= low AND departure < high""")
def category_range_join(spark, sf_dir):
    out = indices.departure(monthly(spark, sf_dir), "tp", "departure", [month_of()])
    return bands.categorize_by_join(out, "departure", bands.DEPARTURE, "category").select("cell", "month", rounded("departure"), "category")


_WEEKLY = "weekly AS (SELECT cell, CAST(isoyear(day) AS INTEGER) AS iso_year, CAST(weekofyear(day) AS INTEGER) AS week, MIN(day) AS date, SUM(tp) AS tp FROM daily WHERE tp IS NOT NULL GROUP BY 1, 2, 3)"
_FORTNIGHTLY = "fort AS (SELECT cell, CAST(year(day) AS INTEGER) AS year, CAST((dayofyear(day) - 1) // 14 AS INTEGER) AS fortnight, MIN(day) AS date, SUM(tp) AS tp FROM daily WHERE tp IS NOT NULL GROUP BY 1, 2, 3)"


@query("weekly_departure", f"""WITH {fx.DAILY}, {_WEEKLY}, i AS (SELECT *, {_DEPARTURE} AS departure FROM weekly WINDOW w AS (PARTITION BY cell, week))
SELECT cell, iso_year, week, date, tp, ROUND(departure, 9) AS departure, {bands.sql_case('departure', bands.DEPARTURE)} AS category FROM i""")
def weekly_departure(spark, sf_dir):
    out = indices.departure(periods.weekly(fx.daily_grid(spark, sf_dir), "tp"), "tp", "departure", ["week"])
    return out.select("cell", F.col("iso_year").cast("int").alias("iso_year"), "week", "date", "tp", rounded("departure"), bands.categorize(F.col("departure"), bands.DEPARTURE).alias("category"))


@query("fortnightly_departure", f"""WITH {fx.DAILY}, {_FORTNIGHTLY}, i AS (SELECT *, {_DEPARTURE} AS departure FROM fort WINDOW w AS (PARTITION BY cell, fortnight))
SELECT cell, year, fortnight, date, tp, ROUND(departure, 9) AS departure, {bands.sql_case('departure', bands.DEPARTURE)} AS category FROM i""")
def fortnightly_departure(spark, sf_dir):
    out = indices.departure(periods.fortnightly(fx.daily_grid(spark, sf_dir), "tp"), "tp", "departure", ["fortnight"])
    return out.select("cell", "year", "fortnight", "date", "tp", rounded("departure"), bands.categorize(F.col("departure"), bands.DEPARTURE).alias("category"))


def _rolled(k: int, source: str = "monthly", order: str = "month", value: str = "tp") -> str:
    w = f"(PARTITION BY cell ORDER BY {order} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN COUNT({value}) OVER {w} = {k} THEN SUM({value}) OVER {w} END"


def _horner(cs, x):
    out = repr(cs[-1])
    for c in reversed(cs[:-1]):
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def _quantile_sql(p: str) -> str:
    """Inverse normal distribution of a column ``p``, as SQL text."""
    q, t = f"({p} - 0.5::DOUBLE)", f"sqrt(-ln(least({p}, 1 - {p})))"
    centre = f"(0.180625::DOUBLE - {q} * {q})"
    body = f"{q} * {_horner(special._A, centre)} / {_horner(special._B, centre)}"
    near = f"{_horner(special._C, f'({t} - 1.6::DOUBLE)')} / {_horner(special._D, f'({t} - 1.6::DOUBLE)')}"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {body} ELSE sign({q}) * {near} END"


def _spi_sql(source: str, keys: str, period: str, value: str = "x", decimals: int = 4, extra: str = "") -> str:
    """SQL of the standardised index of ``value`` in ``source``, as CTEs that end in ``spi_out``.

    Written apart from the engine's expressions: Newton steps on digamma and trigamma sums over lists and
    the incomplete gamma series through lgamma.
    """
    psi = "(ln({k} + 30) - 1 / (2 * ({k} + 30)) - 1 / (12 * ({k} + 30) ** 2) + 1 / (120 * ({k} + 30) ** 4) - list_sum(list_transform(range(0, 30), lambda i: 1 / ({k} + i))))"
    tri = "(1 / ({k} + 30) + 1 / (2 * ({k} + 30) ** 2) + 1 / (6 * ({k} + 30) ** 3) - 1 / (30 * ({k} + 30) ** 5) + list_sum(list_transform(range(0, 30), lambda i: 1 / ({k} + i) ** 2)))"
    steps = ["f0 AS (SELECT *, CASE WHEN wet >= 3 AND sl > 1e-12 THEN (3 - sl + sqrt((sl - 3) * (sl - 3) + 24 * sl)) / (12 * sl) END AS k FROM st)"]
    for i in range(8):
        steps.append(f"f{i + 1} AS (SELECT * REPLACE (k - (ln(k) - {psi.format(k='k')} - sl) / (1 / k - {tri.format(k='k')}) AS k) FROM f{i})")
    y = f"({value} * k / mu)"
    cdf = f"list_sum(list_transform(range(0, CAST(60 + ceil(20 * sqrt(k)) + greatest(0, ceil({y} - k)) AS BIGINT)), lambda n: exp((k + n) * ln({y}) - {y} - lgamma(k + n + 1))))"
    return f"""src AS (SELECT *, {period} AS pk FROM {source}),
st AS (SELECT *, ln(mu) - ml AS sl FROM (SELECT cell, pk, COUNT({value}) AS n, AVG(CASE WHEN {value} <= 0 THEN 1.0::DOUBLE WHEN {value} > 0 THEN 0.0::DOUBLE END) AS q0, COUNT(CASE WHEN {value} > 0 THEN 1 END) AS wet, AVG(CASE WHEN {value} > 0 THEN {value} END) AS mu, AVG(CASE WHEN {value} > 0 THEN ln({value}) END) AS ml FROM src GROUP BY 1, 2)),
{", ".join(steps)},
hh AS (SELECT src.*, CASE WHEN n >= 5 AND {value} IS NOT NULL THEN greatest(1e-6::DOUBLE, least(1 - 1e-6::DOUBLE, CASE WHEN {value} > 0 THEN q0 + (1 - q0) * COALESCE(CASE WHEN k IS NOT NULL THEN {cdf} END, 0.5::DOUBLE) ELSE q0 END)) END AS hp FROM src JOIN f8 USING (cell, pk)),
spi_out AS (SELECT {keys}, {value}, {extra} CASE WHEN hp IS NOT NULL THEN {_quantile_sql('hp')} END AS z FROM hh)"""


def _spi(k: int):
    sql = f"""WITH {fx.MONTHLY}, rolled AS (SELECT cell, month, {_rolled(k)} AS x FROM monthly), {_spi_sql('rolled', 'cell, month', 'month(month)')}
SELECT cell, month, x AS tp_sum, ROUND(z, 4) AS spi, {bands.sql_case('z', bands.DROUGHT)} AS category FROM spi_out"""

    @query(f"spi_{k}", sql)
    def run(spark, sf_dir):
        rolled = indices.rolling_sum(monthly(spark, sf_dir), "tp", "tp_sum", k)
        out = indices.spi(rolled, "tp_sum", "z", [month_of()])
        return out.select("cell", "month", "tp_sum", F.round("z", 4).alias("spi"), bands.categorize(F.col("z"), bands.DROUGHT).alias("category"))


def _spei(k: int):
    w = "(PARTITION BY cell, month(month))"
    sql = f"""WITH {fx.DAILY}, {PET}, bal AS (SELECT cell, month, tp - pet AS wb FROM pm), rolled AS (SELECT cell, month, {_rolled(k, value='wb')} AS x FROM bal),
z AS (SELECT *, CASE WHEN COUNT(x) OVER {w} >= 5 AND STDDEV_SAMP(x) OVER {w} <> 0 THEN (x - AVG(x) OVER {w}) / STDDEV_SAMP(x) OVER {w} END AS z FROM rolled)
SELECT cell, month, ROUND(x, 4) AS balance, ROUND(z, 5) AS spei, {bands.sql_case('ROUND(z, 5)', bands.DROUGHT)} AS category FROM z"""

    @query(f"spei_{k}", sql)
    def run(spark, sf_dir):
        rolled = indices.rolling_sum(balance(spark, sf_dir), "wb", "x", k)
        out = indices.spei(rolled, "x", "z", [month_of()])
        return out.select("cell", "month", F.round("x", 4).alias("balance"), F.round("z", 5).alias("spei"), bands.categorize(F.round("z", 5), bands.DROUGHT).alias("category"))


# --- evaporative demand -----------------------------------------------------------------------------

_LAT = "(20 + cell)"


def _ra_sql(lat: str, doy: str, clip: bool) -> str:
    phi, b = f"radians({lat})", f"({doy} * (2 * pi() / 365))"
    dec = f"(0.409::DOUBLE * sin({b} - 1.39::DOUBLE))"
    cosine = f"(-tan({phi}) * tan({dec}))"
    if clip:
        cosine = f"greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {cosine}))"
    ws = f"acos({cosine})"
    return f"(24 * 60 / pi() * 0.0820::DOUBLE * (1 + 0.033::DOUBLE * cos({b})) * ({ws} * sin({phi}) * sin({dec}) + cos({phi}) * cos({dec}) * sin({ws})))"


_HARGREAVES = f"0.0023::DOUBLE * (tmean + 17.8::DOUBLE) * sqrt(CASE WHEN tmax IS NOT NULL AND tmin IS NOT NULL THEN greatest(tmax - tmin, 0) END) * 0.408::DOUBLE * {_ra_sql(_LAT, 'dayofyear(day)', True)}"
PET = f"""pd AS (SELECT cell, day, tp, {_HARGREAVES} AS pet FROM daily),
pm AS (SELECT cell, CAST(date_trunc('month', day) AS DATE) AS month, SUM(tp) AS tp, COALESCE(SUM(pet), 0) AS pet FROM pd GROUP BY 1, 2)"""


def with_pet(spark, sf_dir) -> DataFrame:
    days = fx.daily_grid(spark, sf_dir)
    return days.withColumn("pet", physics.hargreaves(F.col("tmean"), F.col("tmax"), F.col("tmin"), F.col("cell") + 20.0, F.dayofyear("day")))


def balance(spark, sf_dir) -> DataFrame:
    both = periods.monthly(with_pet(spark, sf_dir), sums=["tp", "pet"])
    return both.withColumn("wb", F.col("tp") - F.col("pet"))


@query("hargreaves_pet", f"WITH {fx.DAILY}, {PET} SELECT cell, day, ROUND(pet, 9) AS pet FROM pd")
def hargreaves_pet(spark, sf_dir):
    return with_pet(spark, sf_dir).select("cell", "day", rounded("pet"))


for _k in (1, 3, 6, 12):
    _spi(_k)
    _spei(_k)


@query("spi_weekly", f"""WITH {fx.DAILY}, {_WEEKLY}, rolled AS (SELECT cell, iso_year, week, date, tp AS x FROM weekly), {_spi_sql('rolled', 'cell, iso_year, week, date', 'week')}
SELECT cell, iso_year, week, date, x AS tp, ROUND(z, 4) AS spi, {bands.sql_case('z', bands.DROUGHT)} AS category FROM spi_out""")
def spi_weekly(spark, sf_dir):
    out = indices.spi(periods.weekly(fx.daily_grid(spark, sf_dir), "tp"), "tp", "z", ["week"])
    return out.select("cell", F.col("iso_year").cast("int").alias("iso_year"), "week", "date", "tp", F.round("z", 4).alias("spi"), bands.categorize(F.col("z"), bands.DROUGHT).alias("category"))


@query("spi_fortnightly", f"""WITH {fx.DAILY}, {_FORTNIGHTLY}, rolled AS (SELECT cell, year, fortnight, date, tp AS x FROM fort), {_spi_sql('rolled', 'cell, year, fortnight, date', 'fortnight')}
SELECT cell, year, fortnight, date, x AS tp, ROUND(z, 4) AS spi, {bands.sql_case('z', bands.DROUGHT)} AS category FROM spi_out""")
def spi_fortnightly(spark, sf_dir):
    out = indices.spi(periods.fortnightly(fx.daily_grid(spark, sf_dir), "tp"), "tp", "z", ["fortnight"])
    return out.select("cell", "year", "fortnight", "date", "tp", F.round("z", 4).alias("spi"), bands.categorize(F.col("z"), bands.DROUGHT).alias("category"))


@query("eddi_3", f"""WITH {fx.DAILY}, {PET}, rolled AS (SELECT cell, month, {_rolled(3, value='pet')} AS x FROM pm), {_spi_sql('rolled', 'cell, month', 'month(month)')}
SELECT cell, month, ROUND(x, 4) AS pet_sum, ROUND(z, 4) AS eddi, {bands.sql_case('(-z)', bands.DROUGHT)} AS category FROM spi_out""")
def eddi_3(spark, sf_dir):
    rolled = indices.rolling_sum(balance(spark, sf_dir), "pet", "pet_sum", 3)
    out = indices.eddi(rolled, "pet_sum", "z", [month_of()])
    return out.select("cell", "month", F.round("pet_sum", 4).alias("pet_sum"), F.round("z", 4).alias("eddi"), bands.categorize(-F.col("z"), bands.DROUGHT).alias("category"))


_CW = "(PARTITION BY cell, month(month))"


@query("czi_3", f"""WITH {fx.MONTHLY}, rolled AS (SELECT cell, month, {_rolled(3)} AS x FROM monthly),
m AS (SELECT cell, month(month) AS mm, COUNT(x) AS n, AVG(x) AS mu, STDDEV_SAMP(x) AS sd FROM rolled GROUP BY 1, 2),
c AS (SELECT cell, mm, AVG((x - mu) ** 3) / NULLIF(AVG((x - mu) ** 2), 0) ** 1.5::DOUBLE AS cs FROM rolled JOIN m USING (cell) WHERE mm = month(month) GROUP BY 1, 2),
v AS (SELECT cell, month, x, CASE WHEN n >= 5 AND sd <> 0 THEN (x - mu) / sd END AS z, CASE WHEN cs <> 0 THEN cs END AS cs FROM rolled JOIN m USING (cell) JOIN c USING (cell, mm) WHERE mm = month(month)),
i AS (SELECT *, ROUND(6 / cs * greatest(cs * z / 2 + 1, 1e-6::DOUBLE) ** (1.0::DOUBLE / 3) - 6 / cs + cs / 6, 5) AS czi FROM v)
SELECT cell, month, x AS tp_sum, CASE WHEN z IS NOT NULL THEN czi END AS czi, {bands.sql_case('(CASE WHEN z IS NOT NULL THEN czi END)', bands.DROUGHT)} AS category FROM i""")
def czi_3(spark, sf_dir):
    out = indices.czi(indices.rolling_sum(monthly(spark, sf_dir), "tp", "tp_sum", 3), "tp_sum", "z", [month_of()])
    return out.select("cell", "month", "tp_sum", F.round("z", 5).alias("czi"), bands.categorize(F.round("z", 5), bands.DROUGHT).alias("category"))


def _rai_sql(period: str) -> str:
    w = f"(PARTITION BY cell, {period})"
    return f"""WITH {fx.MONTHLY}, r AS (SELECT *, COUNT(tp) OVER {w} AS n, AVG(tp) OVER {w} AS mu, row_number() OVER (PARTITION BY cell, {period} ORDER BY tp DESC, month) AS up, row_number() OVER (PARTITION BY cell, {period} ORDER BY tp, month) AS down FROM monthly),
t AS (SELECT *, AVG(CASE WHEN up <= greatest(1, n // 10) THEN tp END) OVER {w} AS top, AVG(CASE WHEN down <= greatest(1, n // 10) THEN tp END) OVER {w} AS bottom FROM r),
i AS (SELECT *, CASE WHEN n >= 10 THEN CASE WHEN tp >= mu THEN 3 * (tp - mu) / NULLIF(top - mu, 0) ELSE -3 * (mu - tp) / NULLIF(mu - bottom, 0) END END AS rai FROM t)
SELECT cell, month, tp, ROUND(rai, 5) AS rai, {bands.sql_case('ROUND(rai, 5)', bands.DROUGHT)} AS category FROM i"""


def _rai(name: str, period: Callable, sql_period: str):
    @query(name, _rai_sql(sql_period))
    def run(spark, sf_dir):
        out = indices.rai(monthly(spark, sf_dir), "tp", "rai", [period("month")])
        return out.select("cell", "month", "tp", F.round("rai", 5).alias("rai"), bands.categorize(F.round("rai", 5), bands.DROUGHT).alias("category"))


_rai("rai_quarter", F.quarter, "quarter(month)")
_rai("rai_month", F.month, "month(month)")


@query("decile_month", f"""WITH {fx.MONTHLY}, i AS (SELECT *, (rank() OVER (PARTITION BY cell, month(month) ORDER BY tp) + (COUNT(*) OVER (PARTITION BY cell, month(month), tp) - 1) / 2.0::DOUBLE) / COUNT(tp) OVER {_CW} * 10 AS d FROM monthly)
SELECT cell, month, tp, ROUND(d, 9) AS decile, {bands.sql_case('d', bands.DECILE)} AS category FROM i""")
def decile_month(spark, sf_dir):
    out = indices.decile(monthly(spark, sf_dir), "tp", "d", [month_of()])
    return out.select("cell", "month", "tp", rounded("d", "decile"), bands.categorize(F.col("d"), bands.DECILE).alias("category"))


@query("pci_annual", f"""WITH {fx.MONTHLY}, i AS (SELECT cell, CAST(year(month) AS INTEGER) AS year, SUM(tp * tp) / NULLIF(SUM(tp) * SUM(tp), 0) * 100 AS pci FROM monthly GROUP BY 1, 2 HAVING COUNT(tp) >= 12)
SELECT cell, year, ROUND(pci, 9) AS pci, {bands.sql_case('pci', bands.PCI)} AS category FROM i""")
def pci_annual(spark, sf_dir):
    out = indices.pci(monthly(spark, sf_dir), "tp")
    return out.select("cell", "year", rounded("pci"), bands.categorize(F.col("pci"), bands.PCI).alias("category"))


@query("aridity_annual", f"""WITH {fx.DAILY}, {PET}, y AS (SELECT cell, CAST(year(month) AS INTEGER) AS year, SUM(tp) AS p, SUM(pet) AS pet FROM pm GROUP BY 1, 2), i AS (SELECT *, CASE WHEN pet > 0 THEN p / pet END AS ai FROM y)
SELECT cell, year, p, ROUND(pet, 4) AS pet, ROUND(ai, 5) AS ai, {bands.sql_case('ROUND(ai, 5)', bands.ARIDITY)} AS category FROM i""")
def aridity_annual(spark, sf_dir):
    yearly = periods.annual(with_pet(spark, sf_dir), sums=["tp", "pet"]).select("cell", F.year("year").alias("year"), "tp", "pet")
    out = indices.aridity(yearly.select("cell", "year", F.col("tp").alias("p")), yearly.select("cell", "year", "pet"), "ai")
    return out.select("cell", "year", "p", F.round("pet", 4).alias("pet"), F.round("ai", 5).alias("ai"), bands.categorize(F.round("ai", 5), bands.ARIDITY).alias("category"))


@query("water_balance_anomaly", f"""WITH {fx.DAILY}, {PET}, bal AS (SELECT cell, month, tp - pet AS wb FROM pm), i AS (SELECT *, wb - AVG(wb) OVER {_CW} AS a FROM bal)
SELECT cell, month, ROUND(wb, 4) AS balance, ROUND(a, 4) AS anomaly, {bands.sql_case('(ROUND(a, 4) / 50)', bands.DROUGHT)} AS category FROM i""")
def water_balance_anomaly(spark, sf_dir):
    out = indices.water_balance_anomaly(balance(spark, sf_dir), "wb", "a", [month_of()])
    return out.select("cell", "month", F.round("wb", 4).alias("balance"), F.round("a", 4).alias("anomaly"), bands.categorize(F.round("a", 4) / 50, bands.DROUGHT).alias("category"))


@query("temperature_anomaly_category", f"""WITH {fx.MONTHLY}, i AS (SELECT *, tmean - AVG(tmean) OVER {_CW} AS a FROM monthly)
SELECT cell, month, ROUND(a, 9) AS anomaly, {bands.sql_case('a', bands.TEMPERATURE)} AS category FROM i""")
def temperature_anomaly_category(spark, sf_dir):
    out = indices.water_balance_anomaly(monthly(spark, sf_dir), "tmean", "a", [month_of()])
    return out.select("cell", "month", rounded("a", "anomaly"), bands.categorize(F.col("a"), bands.TEMPERATURE).alias("category"))


# --- daily stage ------------------------------------------------------------------------------------


@query("deaccumulate_reset", f"""WITH {fx.HOURLY}, l AS (SELECT *, accum - lag(accum) OVER (PARTITION BY cell, year(ts) ORDER BY ts) AS d FROM hourly)
SELECT cell, ts, accum, CASE WHEN d < 0 THEN accum ELSE COALESCE(d, accum) END AS step FROM l""")
def deaccumulate_reset(spark, sf_dir):
    return daily.deaccumulate_reset(fx.hourly_grid(spark, sf_dir), "accum", "step").select("cell", "ts", "accum", "step")


@query("deaccumulate_cycle", f"""WITH {fx.HOURLY}, l AS (SELECT cell, ts, accum, v, row_number() OVER (PARTITION BY cell ORDER BY ts) AS n FROM hourly)
SELECT cell, ts, accum, v AS step FROM l WHERE n > 1""")
def deaccumulate_cycle(spark, sf_dir):
    return daily.deaccumulate_cycle(fx.hourly_grid(spark, sf_dir), "accum", "step").select("cell", "ts", "accum", "step")


@query("daily_precipitation", f"""WITH {fx.HOURLY}, l AS (SELECT *, accum - lag(accum) OVER (PARTITION BY cell, year(ts) ORDER BY ts) AS d FROM hourly)
SELECT cell, CAST(ts AS DATE) AS day, ROUND(SUM(CASE WHEN d < 0 THEN accum ELSE COALESCE(d, accum) END * 1000.0::DOUBLE), 4) AS tp_sum, COUNT(accum) AS n_hours FROM l GROUP BY 1, 2""")
def daily_precipitation(spark, sf_dir):
    return daily.daily_precipitation(fx.hourly_grid(spark, sf_dir), "accum").select("cell", "day", F.round("tp_sum", 4).alias("tp_sum"), "n_hours")


@query("daily_agg", f"""WITH {fx.MET} SELECT cell, CAST(ts AS DATE) AS day, ROUND(AVG(t), 9) AS t_mean, ROUND(MAX(t), 9) AS t_max, ROUND(MIN(t), 9) AS t_min, ROUND(AVG(td), 9) AS td_mean, ROUND(SUM(tp), 9) AS tp_sum FROM met GROUP BY 1, 2""")
def daily_agg(spark, sf_dir):
    out = daily.aggregate_daily(fx.met_hourly(spark, sf_dir), {"t": ["mean", "max", "min"], "td": ["mean"], "tp": ["sum"]})
    return out.select("cell", "day", rounded("t_mean"), rounded("t_max"), rounded("t_min"), rounded("td_mean"), F.round("tp_sum", 9).alias("tp_sum"))


_LOCAL = """ld AS (SELECT cell, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS day, COUNT(t) AS n, MAX(t) - 273.15::DOUBLE AS tmax, MIN(t) - 273.15::DOUBLE AS tmin, AVG(t - 273.15::DOUBLE) AS tmean, AVG(td - 273.15::DOUBLE) AS tdew, SUM(tp * 1000) AS rain_mm, AVG(sqrt(u * u + v * v)) AS u10, SUM(rs * 1e-6::DOUBLE) AS rs_mj, AVG(p * 0.001::DOUBLE) AS p_kpa FROM met GROUP BY 1, 2),
lk AS (SELECT *, MAX(CASE WHEN n = 24 THEN 1 ELSE 0 END) OVER (PARTITION BY day) AS k FROM ld)"""
_FIELDS = ["tmax", "tmin", "tmean", "tdew", "rain_mm", "u10", "rs_mj", "p_kpa"]


@query("local_day_agg", f"WITH {fx.MET}, {_LOCAL} SELECT cell, day, {', '.join(f'ROUND(CASE WHEN n = 24 THEN {c} END, 9) AS {c}' for c in _FIELDS)} FROM lk WHERE k = 1")
def local_day_agg(spark, sf_dir):
    return daily.local_day_fields(fx.met_hourly(spark, sf_dir)).select("cell", "day", *[rounded(c) for c in _FIELDS])


def _e0(t: str) -> str:
    return f"(0.6108::DOUBLE * exp(17.27::DOUBLE * {t} / ({t} + 237.3::DOUBLE)))"


_T = "((tmax + tmin) / 2)"
_RSO = f"((0.75::DOUBLE + 2e-5::DOUBLE * ((1 - (p_kpa / 101.3::DOUBLE) ** (1 / 5.26::DOUBLE)) * (293 / 0.0065::DOUBLE))) * {_ra_sql(_LAT, 'dayofyear(day)', False)})"
_RNL = f"(4.903e-9::DOUBLE * (((tmax + 273.16::DOUBLE) ** 4 + (tmin + 273.16::DOUBLE) ** 4) / 2) * (0.34::DOUBLE - 0.14::DOUBLE * sqrt({_e0('tdew')})) * (1.35::DOUBLE * greatest(0.3::DOUBLE, least(1.0::DOUBLE, rs_mj / {_RSO})) - 0.35::DOUBLE))"
_SLOPE = f"(4098 * {_e0(_T)} / ({_T} + 237.3::DOUBLE) ** 2)"
_U2 = "(u10 * (4.87::DOUBLE / ln(67.8::DOUBLE * 10 - 5.42::DOUBLE)))"
_G = "(0.665e-3::DOUBLE * p_kpa)"
_PM = f"greatest(0, (0.408::DOUBLE * {_SLOPE} * (0.77::DOUBLE * rs_mj - {_RNL}) + {_G} * 900 / ({_T} + 273) * {_U2} * (({_e0('tmax')} + {_e0('tmin')}) / 2 - {_e0('tdew')})) / ({_SLOPE} + {_G} * (1 + 0.34::DOUBLE * {_U2})))"


@query("penman_monteith_pet", f"WITH {fx.MET}, {_LOCAL} SELECT cell, day, ROUND(CASE WHEN n = 24 THEN {_PM} END, 9) AS et0_mm FROM lk WHERE k = 1")
def penman_monteith_pet(spark, sf_dir):
    days = daily.local_day_fields(fx.met_hourly(spark, sf_dir))
    et0 = physics.penman_monteith(F.col("tmax"), F.col("tmin"), F.col("tdew"), F.col("p_kpa"), F.col("u10"), F.col("rs_mj"), F.col("cell") + 20.0, F.dayofyear("day"))
    return days.select("cell", "day", rounded(et0, "et0_mm"))


def _magnus(t: str) -> str:
    return f"(6.1094::DOUBLE * exp(17.625::DOUBLE * {t} / ({t} + 243.04::DOUBLE)))"


_HOURS = f"""hm AS (SELECT cell, ts, t - 273.15::DOUBLE AS t, td - 273.15::DOUBLE AS td, u, v, tp * 1000 AS rain FROM met),
hr AS (SELECT *, least(100, 100 * {_magnus('td')} / {_magnus('t')}) AS rh, sqrt(u * u + v * v) AS wind FROM hm)"""


def met_celsius(spark, sf_dir) -> DataFrame:
    met = fx.met_hourly(spark, sf_dir)
    return met.select("cell", "ts", physics.convert(F.col("t"), "t2m").alias("t"), physics.convert(F.col("td"), "d2m").alias("td"), "u", "v", physics.convert(F.col("tp"), "tp").alias("rain"))


@query("relative_humidity", f"WITH {fx.MET}, {_HOURS} SELECT cell, ts, ROUND({_magnus('t')}, 9) AS vapour_hpa, ROUND(rh, 9) AS rh, ROUND(wind, 9) AS wind FROM hr")
def relative_humidity(spark, sf_dir):
    h = met_celsius(spark, sf_dir)
    return h.select("cell", "ts", rounded(physics.vapour_pressure(F.col("t")), "vapour_hpa"), rounded(physics.relative_humidity(F.col("t"), F.col("td")), "rh"), rounded(physics.wind_speed(F.col("u"), F.col("v")), "wind"))


_AGRO = f"""{_HOURS}, agro AS (SELECT cell, CAST(ts AS DATE) AS day, AVG(rh) AS rh_mean, MAX(rh) AS rh_max, MIN(rh) AS rh_min, AVG(wind) AS wind_mean_ms, MAX(wind) AS wind_max_ms, SUM(rain) AS rain_mm, CAST(COUNT(*) FILTER (rh >= 70) AS BIGINT) AS leaf_wetness_hours, CAST(COUNT(*) FILTER (rain >= 0.1 AND wind > 8.0) AS BIGINT) AS wind_driven_rain_hours FROM hr GROUP BY 1, 2),
ag AS (SELECT *, CASE WHEN rain_mm >= 9.0 THEN 1 ELSE 0 END AS rain_day FROM agro)"""


def agromet(spark, sf_dir) -> DataFrame:
    """Limits are set so that both outcomes occur in these tables."""
    return daily.agromet_daily(met_celsius(spark, sf_dir), wet_rh=70.0, rain_day=9.0)


_AGRO_COLS = ["rh_mean", "rh_max", "rh_min", "wind_mean_ms", "wind_max_ms", "rain_mm"]


@query("agromet_daily", f"WITH {fx.MET}, {_AGRO} SELECT cell, day, {', '.join(f'ROUND({c}, 9) AS {c}' for c in _AGRO_COLS)}, leaf_wetness_hours, wind_driven_rain_hours, rain_day FROM ag")
def agromet_daily(spark, sf_dir):
    return agromet(spark, sf_dir).select("cell", "day", *[rounded(c) for c in _AGRO_COLS], "leaf_wetness_hours", "wind_driven_rain_hours", "rain_day")


@query("merge_variables", """SELECT CAST(user_id % 10 AS INTEGER) AS cell, date_trunc('hour', ts) AS ts, ROUND(MAX(CASE WHEN event_type = 'click' THEN value END), 9) AS click, ROUND(MAX(CASE WHEN event_type = 'view' THEN value END), 9) AS view FROM events GROUP BY 1, 2""")
def merge_variables(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    long = events.groupBy((F.col("user_id") % 10).cast("int").alias("cell"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("variable")).agg(F.max("value").alias("value"))
    return daily.merge_variables(long, ["click", "view"]).select("cell", "ts", rounded("click"), rounded("view"))


@query("area_mean_daily", f"WITH {fx.DAILY} SELECT day, ROUND(AVG(tp), 11) AS tp, ROUND(AVG(tmean), 11) AS tmean FROM daily GROUP BY day")
def area_mean_daily(spark, sf_dir):
    return daily.area_mean(fx.daily_grid(spark, sf_dir), ["tp", "tmean"]).select("day", F.round("tp", 11).alias("tp"), F.round("tmean", 11).alias("tmean"))


# --- normals and anomalies --------------------------------------------------------------------------

_NORMALS = "nrm AS (SELECT cell, CAST(dayofyear(day) AS INTEGER) AS doy, AVG(tp) AS tp, AVG(tmean) AS tmean FROM daily WHERE year(day) BETWEEN 1995 AND 1999 GROUP BY 1, 2)"
_SMOOTH = """nn AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY doy) AS pos, COUNT(*) OVER (PARTITION BY cell) AS n FROM nrm),
pad AS (SELECT cell, doy, pos, tp, tmean, TRUE AS own FROM nn UNION ALL SELECT cell, doy, pos - n, tp, tmean, FALSE FROM nn UNION ALL SELECT cell, doy, pos + n, tp, tmean, FALSE FROM nn),
smo AS (SELECT cell, doy, own, CASE WHEN COUNT(tp) OVER w = 5 THEN AVG(tp) OVER w END AS tp, CASE WHEN COUNT(tmean) OVER w = 5 THEN AVG(tmean) OVER w END AS tmean FROM pad WINDOW w AS (PARTITION BY cell ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
sm AS (SELECT cell, doy, tp, tmean FROM smo WHERE own)"""


@query("doy_normals", f"WITH {fx.DAILY}, {_NORMALS} SELECT cell, doy, ROUND(tp, 9) AS tp, ROUND(tmean, 9) AS tmean FROM nrm")
def doy_normals(spark, sf_dir):
    return normals.doy_normals(fx.daily_grid(spark, sf_dir), ["tp", "tmean"], BASELINE).select("cell", "doy", rounded("tp"), rounded("tmean"))


def smoothed(spark, sf_dir) -> DataFrame:
    return normals.smooth_circular(normals.doy_normals(fx.daily_grid(spark, sf_dir), ["tp", "tmean"], BASELINE), ["tp", "tmean"])


@query("doy_normals_smoothed", f"WITH {fx.DAILY}, {_NORMALS}, {_SMOOTH} SELECT cell, doy, ROUND(tp, 9) AS tp, ROUND(tmean, 9) AS tmean FROM sm")
def doy_normals_smoothed(spark, sf_dir):
    return smoothed(spark, sf_dir).select("cell", "doy", rounded("tp"), rounded("tmean"))


@query("daily_anomaly", f"""WITH {fx.DAILY}, {_NORMALS}, {_SMOOTH} SELECT d.cell, d.day, ROUND(d.tp - s.tp, 9) AS tp_anomaly, ROUND(d.tmean - s.tmean, 9) AS tmean_anomaly
FROM daily d LEFT JOIN sm s ON d.cell = s.cell AND dayofyear(d.day) = s.doy""")
def daily_anomaly(spark, sf_dir):
    out = normals.anomalies(fx.daily_grid(spark, sf_dir), smoothed(spark, sf_dir), ["tp", "tmean"])
    return out.select("cell", "day", rounded("tp_anomaly"), rounded("tmean_anomaly"))


@query("pct_of_normal", f"""WITH {fx.DAILY}, {_NORMALS}, {_SMOOTH} SELECT d.cell, d.day, ROUND(CASE WHEN s.tp > 0 THEN d.tp / s.tp * 100 END, 9) AS pct
FROM daily d LEFT JOIN sm s ON d.cell = s.cell AND dayofyear(d.day) = s.doy""")
def pct_of_normal(spark, sf_dir):
    out = normals.anomalies(fx.daily_grid(spark, sf_dir), smoothed(spark, sf_dir), ["tp"], percent_of="tp")
    return out.select("cell", "day", rounded("tp_pct_of_normal", "pct"))


# --- annual indicators ------------------------------------------------------------------------------


def indicator_context(spark, sf_dir) -> annual.Context:
    return annual.Context(daily=fx.indicator_days(spark, sf_dir), agromet=agromet(spark, sf_dir), baseline=BASELINE)


def _whole(column: str, value: str) -> str:
    return f"WITH {fx.INDICATOR} SELECT cell, year, ROUND(CASE WHEN COUNT({column}) = dayofyear(make_date(year, 12, 31)) THEN CAST({value} AS DOUBLE) END, 9) AS value FROM days GROUP BY cell, year"


def _beyond(column: str, p: str, sign: str) -> str:
    h = f"greatest(1, least(n, (n + 1::DOUBLE / 3) * {p}::DOUBLE + 1::DOUBLE / 3))"
    return f"""WITH {fx.INDICATOR}, spread AS (SELECT cell, CAST((dayofyear(day) - 1 + UNNEST([-2, -1, 0, 1, 2]) + 366) % 366 + 1 AS INTEGER) AS doy, {column} AS x FROM days WHERE {column} IS NOT NULL AND year BETWEEN 1995 AND 1999),
pool AS (SELECT cell, doy, list_sort(list(x)) AS xs, COUNT(*) AS n FROM spread GROUP BY 1, 2), hh AS (SELECT *, {h} AS h, CAST(floor({h}) AS BIGINT) AS lo FROM pool),
thr AS (SELECT cell, doy, xs[lo] + (h - lo) * (xs[least(lo + 1, n)] - xs[lo]) AS thr FROM hh)
SELECT d.cell, year, CASE WHEN COUNT({column}) = dayofyear(make_date(year, 12, 31)) THEN CAST(COUNT(*) FILTER ({column} {sign} thr) AS DOUBLE) END AS value
FROM days d LEFT JOIN thr t ON d.cell = t.cell AND dayofyear(day) = doy GROUP BY d.cell, year"""


def _run_sql(source: str, truth: str, whole: str | None) -> str:
    value = "CAST(COALESCE(MAX(CASE WHEN t THEN len END), 0) AS DOUBLE)"
    if whole:
        value = f"CASE WHEN ANY_VALUE(nv) = dayofyear(make_date(year, 12, 31)) THEN {value} END"
    return f"""{source}, tt AS (SELECT cell, day, year, COALESCE({truth}, FALSE) AS t, {f'COUNT({whole}) OVER (PARTITION BY cell, year)' if whole else '0'} AS nv FROM days),
gg AS (SELECT *, row_number() OVER (PARTITION BY cell, year ORDER BY day) - row_number() OVER (PARTITION BY cell, year, t ORDER BY day) AS grp FROM tt),
rr AS (SELECT cell, year, t, ANY_VALUE(nv) AS nv, COUNT(*) AS len FROM gg GROUP BY cell, year, t, grp)
SELECT cell, year, {value} AS value FROM rr GROUP BY cell, year"""


_IND, _AGD = f"WITH {fx.INDICATOR}", f"WITH {fx.MET}, {_AGRO}, days AS (SELECT *, CAST(year(day) AS INTEGER) AS year FROM ag)"
_FIVE = f"""WITH {fx.INDICATOR}, f AS (SELECT *, CASE WHEN COUNT(pr) OVER w = 5 THEN SUM(pr) OVER w END AS s5 FROM days WINDOW w AS (PARTITION BY cell ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT cell, year, ROUND(CASE WHEN COUNT(pr) = dayofyear(make_date(year, 12, 31)) THEN MAX(s5) END, 9) AS value FROM f GROUP BY cell, year"""
_R95 = f"""WITH {fx.INDICATOR}, w AS (SELECT cell, quantile_cont(pr, 0.95) AS p95 FROM days WHERE pr >= 1 AND year BETWEEN 1995 AND 1999 GROUP BY cell)
SELECT d.cell, year, ROUND(COALESCE(SUM(CASE WHEN pr >= 1 AND pr > p95 THEN pr END), 0), 9) AS value FROM days d LEFT JOIN w ON d.cell = w.cell GROUP BY d.cell, year"""
_INDICATOR_SQL = {
    "tx90p": _beyond("tmax", "0.9", ">"),
    "tn10p": _beyond("tmin", "0.1", "<"),
    "frost_days": _whole("tmin", "COUNT(*) FILTER (tmin < 0)"),
    "summer_days": _whole("tmax", "COUNT(*) FILTER (tmax > 25)"),
    "tropical_nights": _whole("tmin", "COUNT(*) FILTER (tmin > 20)"),
    "rx1day": _whole("pr", "MAX(pr)"),
    "rx5day": _FIVE,
    "sdii": _whole("pr", "AVG(CASE WHEN pr >= 1 THEN pr END)"),
    "cdd": _run_sql(_IND, "pr < 1", "pr"),
    "cwd": _run_sql(_IND, "pr >= 1", "pr"),
    "r95p": _R95,
    **{c: f"{_AGD} SELECT cell, year, CAST(COALESCE(SUM({s}), 0) AS DOUBLE) AS value FROM days GROUP BY cell, year" for c, s in (("rain_days", "rain_day"), ("leaf_wetness_hours", "leaf_wetness_hours"), ("wind_driven_rain_hours", "wind_driven_rain_hours"))},
    "wet_spell_max": _run_sql(_AGD, "rain_day = 1", None),
    "dry_spell_max": _run_sql(_AGD, "rain_day = 0", None),
}


def _indicator(name: str):
    @query(name, _INDICATOR_SQL[name])
    def run(spark, sf_dir):
        return annual.REGISTRY[name](indicator_context(spark, sf_dir)).select("cell", "year", rounded("value"))


for _name in annual.REGISTRY:
    _indicator(_name)

_SUMMARY = ["frost_days", "rx1day", "r95p", "summer_days"]


@query("index_summary", "SELECT index, ROUND(AVG(value), 5) AS mean, ROUND(MIN(value), 5) AS min, ROUND(MAX(value), 5) AS max, CASE WHEN index LIKE '%days' THEN 'days' ELSE 'mm' END AS units FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS index, value FROM ({_INDICATOR_SQL[n]})" for n in _SUMMARY) + ") WHERE value IS NOT NULL GROUP BY index")
def index_summary(spark, sf_dir):
    out = annual.summary(annual.compute(_SUMMARY, indicator_context(spark, sf_dir)))
    return out.select("index", *[F.round(c, 5).alias(c) for c in ("mean", "min", "max")], "units")


# --- figures as data, regions and planning ----------------------------------------------------------

_PNI = f"{fx.MONTHLY}, i AS (SELECT *, tp / NULLIF(AVG(tp) OVER (PARTITION BY cell, month(month)), 0) * 100 AS pni FROM monthly)"


def _pni(spark, sf_dir) -> DataFrame:
    return indices.percent_of_normal(monthly(spark, sf_dir), "tp", "pni", [month_of()])


@query("driest_wettest_month", f"""WITH {_PNI}, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY pni, month) AS lo, row_number() OVER (PARTITION BY cell ORDER BY pni DESC, month) AS hi FROM i WHERE pni IS NOT NULL)
SELECT cell, MAX(CASE WHEN lo = 1 THEN month END) AS driest, MAX(CASE WHEN hi = 1 THEN month END) AS wettest FROM r GROUP BY cell""")
def driest_wettest_month(spark, sf_dir):
    return figures.extremes(_pni(spark, sf_dir), "pni", by=["cell"]).select("cell", F.col("at_min").alias("driest"), F.col("at_max").alias("wettest"))


@query("spatial_month_mean", f"WITH {fx.DAILY} SELECT cell, ROUND(AVG(tp), 9) AS tp, ROUND(AVG(tmean), 9) AS tmean FROM daily WHERE year(day) = 1997 AND month(day) = 7 GROUP BY cell")
def spatial_month_mean(spark, sf_dir):
    return figures.month_mean(fx.daily_grid(spark, sf_dir), ["tp", "tmean"], 1997, 7).select("cell", rounded("tp"), rounded("tmean"))


@query("map_stats", f"""WITH {fx.DAILY}, mm AS (SELECT cell, AVG(tp) - 5 AS x FROM daily WHERE year(day) = 1997 AND month(day) = 7 GROUP BY cell)
SELECT ROUND(AVG(x), 9) AS mean, ROUND(MIN(x), 9) AS min, ROUND(MAX(x), 9) AS max, ROUND(COALESCE(NULLIF(MAX(abs(x)), 0), 1), 9) AS scale FROM mm""")
def map_stats(spark, sf_dir):
    field = figures.month_mean(fx.daily_grid(spark, sf_dir), ["tp"], 1997, 7).withColumn("x", F.col("tp") - 5)
    return figures.map_stats(field, "x").select(rounded("mean"), rounded("min"), rounded("max"), rounded("scale"))


@query("series_resolution", f"""WITH {fx.DAILY}, {_WEEKLY}, {_FORTNIGHTLY}, s AS (SELECT 'week' AS series, cell, date FROM weekly UNION ALL SELECT 'fortnight', cell, date FROM fort),
l AS (SELECT series, cell, datediff('day', lag(date) OVER (PARTITION BY series, cell ORDER BY date), date) AS gap FROM s)
SELECT series, cell, CAST(median(gap) AS DOUBLE) AS gap_days, median(gap) > 300 AS annual FROM l GROUP BY 1, 2""")
def series_resolution(spark, sf_dir):
    days = fx.daily_grid(spark, sf_dir)
    week = periods.weekly(days, "tp").select(F.lit("week").alias("series"), "cell", "date")
    fort = periods.fortnightly(days, "tp").select(F.lit("fortnight").alias("series"), "cell", "date")
    return figures.resolution(week.union(fort), by=["series", "cell"])


@query("series_callouts", f"""WITH {_PNI}, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY pni, month) AS lo, row_number() OVER (PARTITION BY cell ORDER BY pni DESC, month) AS hi FROM i)
SELECT cell, month, ROUND(pni, 9) AS value, ROUND(least(greatest(pni, 0), 200), 9) AS display_value, {bands.sql_case('pni', bands.PNI)} AS category, lo = 1 AS is_worst, hi = 1 AS is_best FROM r""")
def series_callouts(spark, sf_dir):
    out = figures.callouts(_pni(spark, sf_dir), "pni", bands.PNI, (0.0, 200.0), by=["cell"])
    return out.select("cell", "month", rounded("value"), rounded("display_value"), "category", "is_worst", "is_best")


_ROLLS = ", ".join(f"{_rolled(k)} AS p{k}" for k in (1, 3, 6, 12))


@query("plot_unpivot_scales", f"""WITH {fx.MONTHLY}, w AS (SELECT cell, month, {_ROLLS} FROM monthly)
SELECT cell, month, scale, value FROM (SELECT cell, month, UNNEST([1, 3, 6, 12]) AS scale, UNNEST([p1, p3, p6, p12]) AS value FROM w)""")
def plot_unpivot_scales(spark, sf_dir):
    wide = monthly(spark, sf_dir)
    for k in (1, 3, 6, 12):
        wide = indices.rolling_sum(wide, "tp", f"p{k}", k)
    return figures.unpivot_scales(wide, "p", (1, 3, 6, 12), ["cell", "month"])


#: A triangle over the five by five grid of the cells.
TRIANGLE = ((78.0, 20.0), (78.42, 20.0), (78.0, 20.42), (78.0, 20.0))


def grid_cells() -> list[tuple[int, float, float]]:
    return [(c, 20 + 0.1 * (c // 5), 78 + 0.1 * (c % 5)) for c in range(25)]


@query("polygon_clip_mean", f"""WITH {fx.DAILY} SELECT day, ROUND(AVG(CASE WHEN cell // 5 + cell % 5 <= 5 THEN tp END), 9) AS tp, COUNT(CASE WHEN cell // 5 + cell % 5 <= 5 THEN 1 END) AS n_cells FROM daily GROUP BY day""")
def polygon_clip_mean(spark, sf_dir):
    region = regions.Region("triangle", 20.5, 77.9, 19.9, 78.5, (TRIANGLE,))
    clipped = regions.clip(fx.daily_grid(spark, sf_dir), regions.cell_table(spark, grid_cells(), region), ["tp"])
    return clipped.groupBy("day").agg(rounded(F.avg("tp"), "tp"), F.count("tp").alias("n_cells"))


_VARIABLES = ["t2m", "tp", "sp"]


def _missing(spark, sf_dir) -> DataFrame:
    return inventory.missing(inventory.wanted(spark, _VARIABLES, *fx.months_of_orders(spark, sf_dir)), fx.file_inventory(spark, sf_dir))


_GAPS = f"{fx.INVENTORY}, {fx.WANTED}, gaps AS (SELECT * FROM want ANTI JOIN have USING (variable, year, month))"


@query("missing_month_files", f"WITH {_GAPS} SELECT variable, year, month FROM gaps")
def missing_month_files(spark, sf_dir):
    return _missing(spark, sf_dir)


@query("request_plan", f"WITH {_GAPS} SELECT variable, year, month, CASE variable WHEN 't2m' THEN '2m_temperature' WHEN 'tp' THEN 'total_precipitation' ELSE 'surface_pressure' END AS long_name, CAST(day(last_day(make_date(year, month, 1))) AS INTEGER) AS n_days, 24 AS n_hours FROM gaps")
def request_plan(spark, sf_dir):
    return inventory.requests(_missing(spark, sf_dir)).select("variable", "year", "month", "long_name", F.size("days").alias("n_days"), F.size("hours").alias("n_hours"))


@query("download_batches", f"""WITH {_GAPS}, pm AS (SELECT year, month, string_agg(variable, ',' ORDER BY variable) AS variables FROM gaps GROUP BY 1, 2),
isl AS (SELECT *, month - row_number() OVER (PARTITION BY year, variables ORDER BY month) AS isl FROM pm), cut AS (SELECT *, (row_number() OVER (PARTITION BY year, variables, isl ORDER BY month) - 1) // 3 AS b FROM isl)
SELECT year, MIN(month) AS first_month, MAX(month) AS last_month, variables FROM cut GROUP BY year, variables, isl, b""")
def download_batches(spark, sf_dir):
    return inventory.batches(_missing(spark, sf_dir))


@query("latest_common_month", f"""WITH {fx.INVENTORY} SELECT year, month FROM (SELECT year, month FROM have GROUP BY 1, 2 HAVING COUNT(DISTINCT variable) = 3) ORDER BY year DESC, month DESC LIMIT 1""")
def latest_common_month(spark, sf_dir):
    return inventory.latest_common_month(fx.file_inventory(spark, sf_dir), _VARIABLES)


@query("monthly_orders_spine", """WITH o AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS x FROM orders GROUP BY 1, 2),
sp AS (SELECT customer, CAST(UNNEST(generate_series(MIN(month), MAX(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM o GROUP BY 1) SELECT customer, month, ROUND(COALESCE(x, 0), 4) AS total FROM sp LEFT JOIN o USING (customer, month)""")
def monthly_orders_spine(spark, sf_dir):
    """Every customer's months from the first to the last order, months without orders with 0."""
    days = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("total"))
    return periods.monthly(days, sums=["total"], by=["customer"]).select("customer", "month", F.round("total", 4).alias("total"))


# --- sources and sinks: written, then read back ---------------------------------------------------------


@query("daily_fields_round_trip", f"WITH {fx.DAILY} SELECT cell, day, tp, ROUND(tmax, 9) AS tmax, ROUND(tmin, 9) AS tmin FROM daily WHERE year(day) BETWEEN 1996 AND 1998")
def daily_fields_round_trip(spark, sf_dir):
    """All daily fields go to a sink partitioned by year; a scan of the baseline years reads only theirs."""
    path = tables.new_folder(spark, "daily")
    tables.write_fields(fx.daily_grid(spark, sf_dir).withColumn("year", F.year("day")), path, partitions=["year"])
    return tables.read_years(spark, path, (1996, 1998)).select("cell", "day", "tp", rounded("tmax"), rounded("tmin"))


@query("hourly_scan_round_trip", f"WITH {fx.HOURLY} SELECT ts, CAST(20 + cell AS DOUBLE) AS lat, CAST(78 AS DOUBLE) AS lon, CAST(v AS DOUBLE) AS value FROM hourly")
def hourly_scan_round_trip(spark, sf_dir):
    """Hourly fields of two variables by variable, year and month, under the raw names of time and place; one variable is scanned."""
    path = tables.new_folder(spark, "hourly")
    raw = fx.hourly_grid(spark, sf_dir).select(F.explode(F.map_from_arrays(F.array(F.lit("tp"), F.lit("accum")), F.array("v", "accum"))).alias("variable", "value"), F.col("ts").alias("valid_time"), (20 + F.col("cell")).alias("latitude"), F.lit(78).alias("longitude"))
    tables.write_fields(raw.withColumns({"year": F.year("valid_time"), "month": F.month("valid_time")}), path, partitions=["variable", "year", "month"])
    return tables.read_hourly(spark, path, variable="tp").select("ts", "lat", "lon", "value")


@query("workbook_round_trip", f"""WITH {fx.MONTHLY}, p AS (SELECT *, tp / NULLIF(AVG(tp) OVER (PARTITION BY cell, month(month)), 0) * 100 AS pni, {_DEPARTURE} AS departure FROM monthly WINDOW w AS (PARTITION BY cell, month(month)))
SELECT 'pni' AS name, cell, month, ROUND(pni, 9) AS value FROM p UNION ALL SELECT 'departure' AS name, cell, month, ROUND(departure, 9) AS value FROM p""")
def workbook_round_trip(spark, sf_dir):
    """Two result tables go to a workbook and are read back by the names in its list of tables."""
    path, months = tables.new_folder(spark, "workbook"), monthly(spark, sf_dir)
    made = {"pni": indices.percent_of_normal(months, "tp", "value", [month_of()]), "departure": indices.departure(months, "tp", "value", [month_of()])}
    tables.write_workbook({n: t.select(F.lit(n).alias("name"), "cell", "month", rounded("value")) for n, t in made.items()}, path, {"pni": "percent of normal"})
    one, two = workbook.read(spark, path).values()
    return one.unionByName(two)
