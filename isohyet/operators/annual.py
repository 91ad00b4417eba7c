"""Annual climate indicators: a registry of functions from a context to (by..., year, value).

Indicators of temperature and precipitation are NULL for a cell and year that lacks a value of any day;
those of exposure hours sum what there is.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@dataclass
class Context:
    """daily: (by..., day, tmax, tmin, pr) and agromet: (by..., day, rain_day, leaf_wetness_hours, wind_driven_rain_hours)."""

    daily: DataFrame | None = None
    agromet: DataFrame | None = None
    baseline: tuple[int, int] = (1991, 2020)
    by: Sequence[str] = field(default_factory=lambda: ("cell",))

    @cached_property
    def days(self) -> DataFrame:
        if self.daily is None:
            raise ValueError("no daily fields")
        return self.daily.withColumn("year", F.year("day"))

    @property
    def base(self) -> DataFrame:
        return self.days.where(F.col("year").between(*self.baseline))


def days_of_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))


def _complete(df: DataFrame, ctx: Context, column: str, value: Column, name: str = "value") -> DataFrame:
    """Yearly ``value``, NULL unless ``column`` has a value on each day of the year."""
    whole = F.count(column) == days_of_year(F.col("year"))
    return df.groupBy(*ctx.by, "year").agg(F.when(whole, value).alias(name))


def percentile_by_doy(base: DataFrame, column: str, p: float, *, by: Sequence[str], half: int = 2) -> DataFrame:
    """(by..., doy, threshold): quantile of the values within ``half`` days of each day of the year, over all years.

    Interpolates at (n + 1/3) p + 1/3 (type 8 of Hyndman and Fan). The days around the turn of the year
    are neighbours. Each value is shuffled once, into the sorted array of its day; a window then takes the arrays
    of the days around. An array holds a value per year, so it stays small. Days that have no value near have no row.
    """
    own = base.where(F.col(column).isNotNull()).groupBy(*by, F.dayofyear("day").alias("doy")).agg(F.array_sort(F.collect_list(column)).alias("xs"))
    # Days near the turn of the year stand at its other end as well: a few of 366, none twice within one window.
    line = Window.partitionBy(*by).orderBy("doy")
    entry = lambda d, xs, asks: F.struct(d.alias("doy"), xs.alias("xs"), F.lit(asks).alias("asks"))
    have = F.filter(F.array(*(entry(F.col("doy") + turn, F.col("xs"), False) for turn in (0, 366, -366))), lambda x: x["doy"].between(1 - half, 366 + half))
    # The first day of a group also asks for each day of the year, be there values of its own or not.
    ask = F.when(F.row_number().over(line) == 1, F.transform(F.sequence(F.lit(1), F.lit(366)), lambda d: entry(d, F.slice("xs", 1, 0), True)))
    rows = own.withColumn("ask", ask).select(*by, F.inline(F.when(F.col("ask").isNull(), have).otherwise(F.concat(have, "ask"))))
    near = line.rangeBetween(-half, half)
    # Sorting what are five sorted runs merges them.
    pooled = rows.withColumn("xs", F.array_sort(F.flatten(F.collect_list("xs").over(near)))).where(F.col("asks") & (F.size("xs") > 0))
    n = F.size("xs")
    h = F.greatest(F.lit(1.0), F.least(n.cast("double"), (n + 1 / 3) * p + 1 / 3))
    low = F.floor(h).cast("int")
    at = lambda i: F.element_at("xs", i.cast("int"))
    value = at(low) + (h - low) * (at(F.least(low + 1, n)) - at(low))
    return pooled.select(*by, "doy", value.alias("threshold"))


def _beyond_doy(column: str, p: float, above: bool) -> Callable[[Context], DataFrame]:
    def count(ctx: Context) -> DataFrame:
        limits = percentile_by_doy(ctx.base, column, p, by=ctx.by)
        days = ctx.days.withColumn("doy", F.dayofyear("day")).join(limits, [*ctx.by, "doy"], "left")
        beyond = F.col(column) > F.col("threshold") if above else F.col(column) < F.col("threshold")
        return _complete(days, ctx, column, F.count_if(beyond).cast("double"))

    return count


def _count(column: str, test: Callable[[Column], Column]) -> Callable[[Context], DataFrame]:
    return lambda ctx: _complete(ctx.days, ctx, column, F.count_if(test(F.col(column))).cast("double"))


def _rx1day(ctx: Context) -> DataFrame:
    return _complete(ctx.days, ctx, "pr", F.max("pr"))


def _rx5day(ctx: Context) -> DataFrame:
    near = Window.partitionBy(*ctx.by).orderBy("day").rowsBetween(-4, 0)
    days = ctx.days.withColumn("sum5", F.when(F.count("pr").over(near) == 5, F.sum("pr").over(near)))
    return _complete(days, ctx, "pr", F.max("sum5"))


def _sdii(ctx: Context) -> DataFrame:
    return _complete(ctx.days, ctx, "pr", F.avg(F.when(F.col("pr") >= 1, F.col("pr"))))


def longest_run(df: DataFrame, truth: Column, *, by: Sequence[str]) -> DataFrame:
    """(by..., year, run): longest row of consecutive rows of a year with ``truth``; NULL counts as false; 0 if none.

    Rows with truth keep the difference of two row numbers for as long as they are consecutive.
    """
    year = [*by, "year"]
    told = df.withColumn("__t", F.coalesce(truth, F.lit(False)))
    place = F.row_number().over(Window.partitionBy(*year).orderBy("day")) - F.row_number().over(Window.partitionBy(*year, "__t").orderBy("day"))
    runs = told.withColumn("__g", place).groupBy(*year, "__t", "__g").agg(F.count(F.lit(1)).alias("__n"))
    return runs.groupBy(*year).agg(F.coalesce(F.max(F.when(F.col("__t"), F.col("__n"))), F.lit(0)).alias("run"))


def _dry_wet_run(wet: bool) -> Callable[[Context], DataFrame]:
    def run(ctx: Context) -> DataFrame:
        truth = F.col("pr") >= 1 if wet else F.col("pr") < 1
        runs = longest_run(ctx.days, truth, by=ctx.by)
        whole = _complete(ctx.days, ctx, "pr", F.lit(True), "whole")
        return runs.join(whole, [*ctx.by, "year"]).select(*ctx.by, "year", F.when(F.col("whole"), F.col("run").cast("double")).alias("value"))

    return run


def _r95p(ctx: Context) -> DataFrame:
    """Sum of daily amounts of at least 1 mm above the 95th percentile of such days in the baseline; 0 if none."""
    wet = ctx.base.where("pr >= 1").groupBy(*ctx.by).agg(F.percentile("pr", 0.95).alias("p95"))
    days = ctx.days.join(wet, list(ctx.by), "left")
    strong = F.when((F.col("pr") >= 1) & (F.col("pr") > F.col("p95")), F.col("pr"))
    return days.groupBy(*ctx.by, "year").agg(F.coalesce(F.sum(strong), F.lit(0.0)).alias("value"))


def _agromet(ctx: Context) -> DataFrame:
    if ctx.agromet is None:
        raise ValueError("no agromet fields")
    return ctx.agromet.withColumn("year", F.year("day"))


def _sum_of(column: str) -> Callable[[Context], DataFrame]:
    return lambda ctx: _agromet(ctx).groupBy(*ctx.by, "year").agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("value"))


def _spell(value: int) -> Callable[[Context], DataFrame]:
    return lambda ctx: longest_run(_agromet(ctx), F.col("rain_day") == value, by=ctx.by).select(*ctx.by, "year", F.col("run").cast("double").alias("value"))


REGISTRY: dict[str, Callable[[Context], DataFrame]] = {
    "tx90p": _beyond_doy("tmax", 0.9, True),
    "tn10p": _beyond_doy("tmin", 0.1, False),
    "frost_days": _count("tmin", lambda t: t < 0),
    "summer_days": _count("tmax", lambda t: t > 25),
    "tropical_nights": _count("tmin", lambda t: t > 20),
    "rx1day": _rx1day,
    "rx5day": _rx5day,
    "sdii": _sdii,
    "cdd": _dry_wet_run(False),
    "cwd": _dry_wet_run(True),
    "r95p": _r95p,
    "rain_days": _sum_of("rain_day"),
    "leaf_wetness_hours": _sum_of("leaf_wetness_hours"),
    "wind_driven_rain_hours": _sum_of("wind_driven_rain_hours"),
    "wet_spell_max": _spell(1),
    "dry_spell_max": _spell(0),
}
UNITS = {n: "days" for n in REGISTRY} | {"rx1day": "mm", "rx5day": "mm", "sdii": "mm/day", "r95p": "mm", "leaf_wetness_hours": "hours", "wind_driven_rain_hours": "hours"}


def makers(names: Sequence[str], ctx: Context, registry: Mapping[str, Callable] = REGISTRY) -> dict[str, Callable[[], DataFrame]]:
    """Functions that plan each indicator, for ``workbook.write_isolated``. An unknown name is logged and left out."""
    for name in names:
        if name not in registry:
            log.warning("unknown indicator %s", name)
    return {name: (lambda f=registry[name]: f(ctx)) for name in names if name in registry}


def compute(names: Sequence[str], ctx: Context, registry: Mapping[str, Callable] = REGISTRY) -> dict[str, DataFrame]:
    """Indicators by name. One that can't be planned is logged and doesn't stop the others."""
    out = {}
    for name, make in makers(names, ctx, registry).items():
        try:
            out[name] = make()
        except Exception:
            log.exception("indicator %s failed", name)
    return out


def summary(values: Mapping[str, DataFrame]) -> DataFrame:
    """(index, mean, min, max, units) over the cells and years that have a value, by name; empty indicators are left out; ValueError without any."""
    if not values:
        raise ValueError("no indicators to sum up")
    tables = [df.select(F.lit(name).alias("index"), F.col("value").cast("double").alias("value")) for name, df in values.items()]
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    units = F.create_map(*[F.lit(x) for name in values for x in (name, UNITS.get(name, ""))])
    return union.where("value is not null").groupBy("index").agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")).withColumn("units", units[F.col("index")])
