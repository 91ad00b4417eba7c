"""What the figures of a run show, as tables; drawing them is left to the reader's tools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.functions.bands import categorize


def extremes(df: DataFrame, column: str, *, by: Sequence[str], date: str = "month") -> DataFrame:
    """(by..., at_min, at_max): the dates of the lowest and highest value, the first of equals."""
    first = F.struct(F.col(column), F.col(date))
    last = F.struct(F.col(column), (-F.unix_date(date)).alias("d"))
    return df.where(F.col(column).isNotNull()).groupBy(*by).agg(F.min_by(date, first).alias("at_min"), F.max_by(date, last).alias("at_max"))


def callouts(df: DataFrame, column: str, bands, limits: tuple[float, float], *, by: Sequence[str], date: str = "month") -> DataFrame:
    """A bar per value: what is drawn is held within ``limits``, the category is that of the value itself."""
    low = Window.partitionBy(*by).orderBy(F.asc_nulls_last(column), date)
    high = Window.partitionBy(*by).orderBy(F.desc_nulls_last(column), date)
    x = F.col(column)
    shown = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(limits[0])), F.lit(limits[1])))
    return df.select(*by, date, x.alias("value"), shown.alias("display_value"), categorize(x, bands).alias("category"), (F.row_number().over(low) == 1).alias("is_worst"), (F.row_number().over(high) == 1).alias("is_best"))


def month_mean(daily: DataFrame, columns: Sequence[str], year: int, month: int, *, by: Sequence[str] = ("cell",)) -> DataFrame:
    chosen = daily.where((F.year("day") == year) & (F.month("day") == month))
    return chosen.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def map_stats(field: DataFrame, column: str) -> DataFrame:
    """mean, min, max and the bound of a colour scale that is symmetric about 0 (1 where all values are 0)."""
    top = F.max(F.abs(column))
    return field.agg(F.avg(column).alias("mean"), F.min(column).alias("min"), F.max(column).alias("max"), F.when(top > 0, top).otherwise(1.0).alias("scale"))


def resolution(series: DataFrame, *, by: Sequence[str], date: str = "date") -> DataFrame:
    """(by..., gap_days, annual): median distance of neighbouring dates; annual if over 300 days."""
    gap = F.datediff(date, F.lag(date).over(Window.partitionBy(*by).orderBy(date)))
    gaps = series.select(*by, gap.alias("gap")).groupBy(*by).agg(F.median("gap").alias("gap_days"))
    return gaps.withColumn("annual", F.col("gap_days") > 300)


def unpivot_scales(wide: DataFrame, prefix: str, scales: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """(keys..., scale, value) from the columns ``{prefix}{scale}``."""
    long = wide.unpivot(list(keys), [f"{prefix}{k}" for k in scales], "scale", "value")
    return long.withColumn("scale", F.substring("scale", len(prefix) + 1, 9).cast("int"))
