"""Hourly fields to daily fields. Cells are keyed by ``by`` columns; rows are (by..., ts, values...)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.functions import physics
from isohyet.functions.calendar import local_day

AGGREGATES = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def deaccumulate_reset(df: DataFrame, column: str, out: str, *, by: Sequence[str] = ("cell",), ts: str = "ts") -> DataFrame:
    """Increments of a running total that restarts within a year: a drop is taken as a restart.

    The first sample of a cell and year is its own increment. A restart that ends above the old total and
    a dip of the total can't be told from this rule; ``deaccumulate_cycle`` knows the hour of restart.
    """
    window = Window.partitionBy(*by, F.year(ts)).orderBy(ts)
    step = F.col(column) - F.lag(column).over(window)
    return df.withColumn(out, F.when(step < 0, F.col(column)).otherwise(F.coalesce(step, F.when(F.row_number().over(window) == 1, F.col(column)))))


def deaccumulate_cycle(df: DataFrame, column: str, out: str, *, by: Sequence[str] = ("cell",), ts: str = "ts", restart_hour: int = 1, keep_first: bool = False) -> DataFrame:
    """Increments of a total that restarts at ``restart_hour`` each day; small dips count as no increment.

    Within a cycle the running maximum is differenced; at the restart the value itself is the increment.
    The first sample of a cell has none: it is dropped or, with ``keep_first``, its increment is NULL.
    """
    line = Window.partitionBy(*by).orderBy(ts)
    starts = (F.hour(ts) == restart_hour).cast("int")
    cycled = df.withColumn("__cycle", F.sum(starts).over(line))
    run = Window.partitionBy(*by, "__cycle").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    raised = cycled.withColumn("__top", F.max(column).over(run))
    before = F.lag("__top").over(line)
    step = F.when(F.hour(ts) == restart_hour, F.col(column)).otherwise(F.col("__top") - before)
    numbered = raised.withColumn("__n", F.row_number().over(line)).withColumn(out, F.when(F.col("__n") > 1, step))
    return (numbered if keep_first else numbered.where("__n > 1")).drop("__cycle", "__top", "__n")


def aggregate_daily(df: DataFrame, aggregates: Mapping[str, Sequence[str]], *, by: Sequence[str] = ("cell",), day: Column | None = None) -> DataFrame:
    """One row per cell and day with a column ``{variable}_{aggregate}`` for each entry of ``aggregates``."""
    day = F.col("ts").cast("date") if day is None else day
    return df.groupBy(*by, day.alias("day")).agg(*daily_outputs(aggregates))


def daily_outputs(aggregates: Mapping[str, Sequence[str]], source: Callable[[str], str] = str) -> list[Column]:
    """The aggregates of ``aggregate_daily``; ``source`` names the column of a variable."""
    return [AGGREGATES[how](source(name)).alias(f"{name}_{how}") for name, hows in aggregates.items() for how in hows]


def daily_precipitation(df: DataFrame, column: str = "tp", *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Daily mm from an hourly running total in metres: increments, negative ones as 0, summed by UTC day.

    The last day of a cell has fewer samples when its series ends early; ``n_hours`` tells.
    """
    steps = deaccumulate_reset(df, column, "__step", by=by)
    mm = physics.not_negative(F.col("__step")) * 1000.0
    return steps.groupBy(*by, F.col("ts").cast("date").alias("day")).agg(F.sum(mm).alias("tp_sum"), F.count(column).alias("n_hours"))


def local_day_fields(df: DataFrame, *, by: Sequence[str] = ("cell",), minutes: int = 330, hours: int = 24) -> DataFrame:
    """Fields of local days from hourly t, td, tp, u, v, rs and p (K, m, m/s, J/m2, Pa; tp and rs as increments).

    A cell and day is kept as NULLs unless all ``hours`` temperatures are there; a day without any complete
    cell is dropped.
    """
    daily = df.groupBy(*by, local_day(F.col("ts"), minutes).alias("day")).agg(*local_outputs())
    return complete_days(daily, by=by, hours=hours)


LOCAL_FIELDS = ("tmax", "tmin", "tmean", "tdew", "rain_mm", "u10", "rs_mj", "p_kpa")


def local_outputs(source: Callable[[str], str] = str) -> list[Column]:
    """The aggregates of ``local_day_fields`` and ``n_t``; ``source`` names the columns of t, td, tp, u, v, rs and p."""
    c, x = physics.convert, lambda name: F.col(source(name))
    return [
        F.count(source("t")).alias("n_t"),
        F.max(c(x("t"), "t2m")).alias("tmax"),
        F.min(c(x("t"), "t2m")).alias("tmin"),
        F.avg(c(x("t"), "t2m")).alias("tmean"),
        F.avg(c(x("td"), "d2m")).alias("tdew"),
        F.sum(c(x("tp"), "tp")).alias("rain_mm"),
        F.avg(physics.wind_speed(x("u"), x("v"))).alias("u10"),
        F.sum(c(x("rs"), "ssrd")).alias("rs_mj"),
        F.avg(c(x("p"), "sp", pressure="kPa")).alias("p_kpa"),
    ]


def complete_days(daily: DataFrame, *, by: Sequence[str] = ("cell",), hours: int = 24) -> DataFrame:
    """Local days with ``n_t`` as ``local_day_fields`` keeps them."""
    full = F.col("n_t") == hours
    complete = daily.where(full).select("day").distinct()  # one row for each day of the calendar at most
    kept = daily.join(F.broadcast(complete), "day", "left_semi")
    return kept.select(*by, "day", *[F.when(full, F.col(f)).alias(f) for f in LOCAL_FIELDS])


def by_kinds_of_day(df: DataFrame, kinds: Mapping[str, Column], outputs: Sequence[Column], *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """(by..., kind, day, outputs...): each row counts in its day of every kind, in one grouping."""
    days = F.array(*(F.struct(F.lit(k).alias("kind"), day.alias("day")) for k, day in kinds.items()))
    return df.select("*", F.inline(days)).groupBy(*by, "kind", "day").agg(*outputs)


def merge_variables(long: DataFrame, variables: Sequence[str], *, by: Sequence[str] = ("cell",), ts: str = "ts") -> DataFrame:
    """A long table (by..., ts, variable, value) as one column per variable: an outer merge in one grouping, no join."""
    return long.groupBy(*by, ts).pivot("variable", list(variables)).agg(F.first("value", ignorenulls=True))


def agromet_daily(df: DataFrame, *, by: Sequence[str] = ("cell",), rain_day: float = 2.5, rain_hour: float = 0.1, wet_rh: float = 90.0, windy: float = 8.0) -> DataFrame:
    """Humidity, wind, rain and exposure hours per cell and UTC day, from hourly t, td (C), u, v (m/s) and rain (mm).

    A rain hour counts as wind-driven at wind above ``windy``; both limits of rain and humidity are inclusive.
    """
    daily = df.groupBy(*by, F.col("ts").cast("date").alias("day")).agg(*agromet_outputs(rain_hour=rain_hour, wet_rh=wet_rh, windy=windy))
    return daily.withColumn("rain_day", physics.flag(F.col("rain_mm") >= rain_day))


def agromet_outputs(source: Callable[[str], str] = str, *, rain_hour: float = 0.1, wet_rh: float = 90.0, windy: float = 8.0, suffix: str = "") -> list[Column]:
    """The aggregates of ``agromet_daily``, ``suffix`` behind their names; ``source`` names the columns of t, td, u, v and rain."""
    x = lambda name: F.col(source(name))
    rh, wind = physics.relative_humidity(x("t"), x("td")), physics.wind_speed(x("u"), x("v"))
    outputs = {
        "rh_mean": F.avg(rh),
        "rh_max": F.max(rh),
        "rh_min": F.min(rh),
        "wind_mean_ms": F.avg(wind),
        "wind_max_ms": F.max(wind),
        "rain_mm": F.sum(source("rain")),
        "leaf_wetness_hours": F.sum(physics.flag(rh >= wet_rh)),
        "wind_driven_rain_hours": F.sum(physics.flag((x("rain") >= rain_hour) & (wind > windy))),
    }
    return [value.alias(f"{name}{suffix}") for name, value in outputs.items()]


def area_mean(df: DataFrame, columns: Sequence[str], *, over: Sequence[str] = ("day",)) -> DataFrame:
    """Unweighted mean over the cells that have a value, for each of ``over``."""
    return df.groupBy(*over).agg(*[F.avg(c).alias(c) for c in columns])
