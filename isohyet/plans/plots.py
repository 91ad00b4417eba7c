"""What the figures of a run show, made from its saved tables alone: a stage of its own that can be run again later."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.plans import figures
from isohyet.sources import workbook

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Bars:
    """A bar for each date of a table: its value, its saved category and, where bars are cut off, the limits."""

    table: str
    value: str
    category: str
    date: str = "month"
    limits: tuple[float, float] | None = None


#: Fixed value: where bars of departures are cut off, as they can be very large where hardly any rain is normal.
_CUT = (-100.0, 150.0)
BARS = {
    "spi": Bars("spi", "spi3", "spi3_category"),
    "spei": Bars("spei", "spei3", "spei3_category"),
    "eddi": Bars("eddi", "eddi3", "eddi3_category"),
    "czi": Bars("czi", "czi3", "czi3_category"),
    "pni": Bars("pni", "pni_pct", "pni_pct_category"),
    "imd-departure": Bars("imd-departure", "departure_pct", "departure_pct_category", limits=_CUT),
    "weekly_departure": Bars("weekly", "departure_pct", "departure_category", "date", _CUT),
    "fortnightly_departure": Bars("fortnightly", "departure_pct", "departure_category", "date", _CUT),
    "decile": Bars("decile", "decile", "decile_category"),
    "rai": Bars("rai", "rai", "rai_category"),
    "weekly": Bars("weekly", "spi1", "spi1_category", "date"),
    "fortnightly": Bars("fortnightly", "spi1", "spi1_category", "date"),
    "pci": Bars("pci", "pci", "pci_category", "year"),
    "ai": Bars("ai", "ai", "ai_category", "year"),
    "water-balance": Bars("water-balance", "water_balance_anomaly_mm", "anomaly_category"),
    "temperature": Bars("temperature", "t2m_mean_anomaly", "t2m_category"),
}
SCALED = {"spi": "spi", "spei": "spei", "eddi": "eddi", "czi": "czi"}


def _date(df: DataFrame, column: str) -> Column:
    """A year stands for its first day."""
    return F.make_date(F.col(column).cast("int"), F.lit(1), F.lit(1)) if dict(df.dtypes)[column] in ("int", "bigint") else F.col(column).cast("date")


def bars(table: DataFrame, spec: Bars) -> DataFrame:
    """(date, value, display_value, category, is_worst, is_best, annual) of the dates that have a value.

    The category is the saved one, that of the value itself; the marks go to the first of equals. ``annual``: the
    dates are more than 300 days apart, by the median.
    """
    rows = table.select(_date(table, spec.date).alias("date"), F.col(spec.value).cast("double").alias("value"), F.coalesce(F.col(spec.category), F.lit("")).alias("category")).where("value is not null")
    low, high = spec.limits or (float("-inf"), float("inf"))
    shown = F.greatest(F.least(F.col("value"), F.lit(high)), F.lit(low))
    one = rows.withColumn("all", F.lit(1))
    marks = figures.extremes(one, "value", by=["all"], date="date").join(figures.resolution(one, by=["all"]), "all").drop("all")
    marked = rows.join(F.broadcast(marks))  # one row
    return marked.select("date", "value", shown.alias("display_value"), "category", (F.col("date") == F.col("at_min")).alias("is_worst"), (F.col("date") == F.col("at_max")).alias("is_best"), F.coalesce("annual", F.lit(False)).alias("annual"))


def month_map(anomalies: DataFrame, cells: DataFrame, column: str, month: DataFrame, value: Column) -> DataFrame:
    """(month, cell, lat, lon, value, scale): means over the days of the one month in ``month`` (a row of ``month``), and the
    bound of a colour scale symmetric about 0. No row if there is no such month."""
    days = anomalies.withColumn("month", F.trunc("day", "month")).join(F.broadcast(month), "month", "left_semi")
    field = days.groupBy("month", "cell").agg(F.avg(column).alias("mean")).withColumn("value", value)
    top = figures.map_stats(field, "value").select("scale")
    return field.join(cells.select("cell", "lat", "lon"), "cell").join(F.broadcast(top)).select("month", "cell", "lat", "lon", "value", "scale")


def makers(tables: Mapping[str, DataFrame], anomalies: DataFrame | None = None, cells: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """What plans each figure's table, of those whose saved tables are there: bars of each index, its scales side by side,
    rainfall maps of the driest and wettest month by SPI-3, and a temperature map of the hottest month."""
    out: dict[str, Callable[[], DataFrame]] = {}
    for name, spec in BARS.items():
        if spec.table in tables and spec.value in tables[spec.table].columns:
            out[f"{name}_bars"] = lambda spec=spec: bars(tables[spec.table], spec)
    for name, prefix in SCALED.items():
        if name in tables:
            scales = [int(c.removeprefix(prefix)) for c in tables[name].columns if c.removeprefix(prefix).isdigit() and c.startswith(prefix)]
            if scales:
                out[f"{name}_scales"] = lambda name=name, prefix=prefix, scales=scales: figures.unpivot_scales(tables[name].select("month", *(f"{prefix}{k}" for k in scales)), prefix, scales, ["month"])
    if anomalies is None or cells is None:
        return out

    def at(table: str, column: str, which: str) -> DataFrame:
        rows = tables[table].select(F.col("month").cast("date").alias("month"), F.col(column).alias("value"), F.lit(1).alias("all"))
        return figures.extremes(rows, "value", by=["all"]).select(F.trunc(which, "month").alias("month"))

    if "spi_bars" in out and "tp_sum_pct_of_normal" in anomalies.columns:
        for label, which in (("driest", "at_min"), ("wettest", "at_max")):
            out[f"rain_map_{label}"] = lambda which=which: month_map(anomalies, cells, "tp_sum_pct_of_normal", at("spi", "spi3", which), F.col("mean") - 100.0)
    if "temperature_bars" in out and "t2m_mean_anomaly" in anomalies.columns:
        out["temperature_map_hottest"] = lambda: month_map(anomalies, cells, "t2m_mean_anomaly", at("temperature", "t2m_mean_anomaly", "at_max"), F.col("mean"))
    return out


def write(spark: SparkSession, saved: str, path: str, *, anomalies: str | None = None, cells: str | None = None) -> DataFrame:
    """Publish the figures' tables of the workbook ``saved`` as a workbook, each on its own; returns their status.

    ``anomalies`` and ``cells`` are Parquet folders; without both there are no maps.
    """
    tables = workbook.read(spark, saved)
    fields = [spark.read.parquet(p) if p else None for p in (anomalies, cells)]
    return workbook.write_isolated(spark, path, makers(tables, *fields))
