"""Sums and means by calendar periods. Months and years have gap-free spines; weeks and fortnights don't."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.functions import calendar


def _spined(df: DataFrame, unit: str, by: Sequence[str], sums: Sequence[str], means: Sequence[str], day: str) -> DataFrame:
    start = F.trunc(F.col(day), unit)
    grouped = df.groupBy(*by, start.alias(unit)).agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means], F.count(F.lit(1)).alias("n_days"))
    step = F.expr(f"interval 1 {unit}")
    spine = grouped.groupBy(*by).agg(F.min(unit).alias("__a"), F.max(unit).alias("__b")).select(*by, F.explode(F.sequence("__a", "__b", step)).alias(unit))
    out = spine.join(grouped, [*by, unit], "left")
    return out.withColumns({**{c: F.coalesce(c, F.lit(0.0)) for c in sums}, "n_days": F.coalesce("n_days", F.lit(0))})


def monthly(df: DataFrame, *, sums: Sequence[str] = (), means: Sequence[str] = (), by: Sequence[str] = ("cell",), day: str = "day") -> DataFrame:
    """(by..., month, values..., n_days) for every month from the first to the last; an empty sum is 0, an empty mean NULL."""
    return _spined(df, "month", by, sums, means, day)


def annual(df: DataFrame, *, sums: Sequence[str] = (), means: Sequence[str] = (), by: Sequence[str] = ("cell",), day: str = "day") -> DataFrame:
    return _spined(df, "year", by, sums, means, day)


def weekly(df: DataFrame, column: str, *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Sums by ISO week of the days that have a value; (date: the first such day, iso_year, week)."""
    keys = [calendar.iso_year(F.col("day")).alias("iso_year"), F.weekofyear("day").alias("week")]
    return df.where(F.col(column).isNotNull()).groupBy(*by, *keys).agg(F.min("day").alias("date"), F.sum(column).alias(column))


def fortnightly(df: DataFrame, column: str, *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Sums by fourteen-day periods of each year (0 to 26) of the days that have a value."""
    keys = [F.year("day").alias("year"), calendar.fortnight(F.col("day")).alias("fortnight")]
    return df.where(F.col(column).isNotNull()).groupBy(*by, *keys).agg(F.min("day").alias("date"), F.sum(column).alias(column))
