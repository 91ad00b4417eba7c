"""Drought indices of periodic series.

Each works on rows (by..., date, value) and treats a group of one ``period`` key (calendar month, ISO week,
fortnight, ...) of one cell. Where a group needs several statistics they come from one grouping, a small
table that is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.functions import special


def rolling_sum(df: DataFrame, column: str, out: str, length: int, *, by: Sequence[str] = ("cell",), order: str = "month") -> DataFrame:
    """Sum of the last ``length`` rows of a cell; NULL until there are as many values."""
    near = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - length, 0)
    return df.withColumn(out, F.when(F.count(column).over(near) == length, F.sum(column).over(near)))


def spi(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",), least: int = 5, least_wet: int = 3) -> DataFrame:
    """Standardised precipitation index: gamma fit of the values above 0 in each group, with the mass at 0.

    NULL in groups of fewer than ``least`` values. With fewer than ``least_wet`` values above 0, or equal
    ones, a value above 0 stands at the middle of the wet probability.
    """
    keys = [f"__k{i}" for i in range(len(period))]
    keyed = df.withColumns({k: F.col(p) if isinstance(p, str) else p for k, p in zip(keys, period, strict=True)})
    x = F.col(column)
    wet = F.when(x > 0, x)
    stats = keyed.groupBy(*by, *keys).agg(F.count(x).alias("__n"), F.avg((x <= 0).cast("double")).alias("__q"), F.count(wet).alias("__wet"), F.avg(wet).alias("__mean"), F.avg(F.log(wet)).alias("__log"))
    fits = stats.withColumn("__k", F.when(F.col("__wet") >= least_wet, special.gamma_shape(F.col("__mean"), F.col("__log"))))
    both = keyed.join(fits, [*by, *keys], "left")
    p_wet = F.coalesce(special.gamma_cdf(F.col("__k"), x * F.col("__k") / F.col("__mean")), F.lit(0.5))
    h = F.when(x > 0, F.col("__q") + (1 - F.col("__q")) * p_wet).otherwise(F.col("__q"))
    clipped = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), h))
    placed = both.withColumn("__h", F.when((F.col("__n") >= least) & x.isNotNull(), clipped))
    return placed.withColumn(out, F.when(F.col("__h").isNotNull(), special.normal_quantile(F.col("__h")))).drop(*keys, "__n", "__q", "__wet", "__mean", "__log", "__k", "__h")


#: The same index of evaporative demand.
eddi = spi


def spei(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",), least: int = 5) -> DataFrame:
    """(x - mean) / sample standard deviation of the group; NULL below ``least`` values or without spread."""
    group = Window.partitionBy(*by, *period)
    x, sd = F.col(column), F.stddev_samp(column).over(group)
    return df.withColumn(out, F.when((F.count(column).over(group) >= least) & (sd != 0), (x - F.avg(column).over(group)) / sd))


def percent_of_normal(df: DataFrame, column: str, out: str, period: Sequence[Column | str] = (), *, by: Sequence[str] = ("cell",)) -> DataFrame:
    mean = F.avg(column).over(Window.partitionBy(*by, *period))
    return df.withColumn(out, F.try_divide(F.col(column), mean) * 100)


def departure(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Percentage by which a value departs from its group's mean; NULL where the mean is 0."""
    mean = F.avg(column).over(Window.partitionBy(*by, *period))
    return df.withColumn(out, F.try_divide(F.col(column) - mean, mean) * 100)


def decile(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Ten times the rank of a value among the group's values over their number; equal values share the mean rank."""
    x = F.col(column)
    group = [*by, *period]
    rank = F.rank().over(Window.partitionBy(*group, x.isNull()).orderBy(x))
    ties = F.count(x).over(Window.partitionBy(*group, x))
    share = (rank + (ties - 1) / 2) / F.count(x).over(Window.partitionBy(*group))
    return df.withColumn(out, F.when(x.isNotNull(), share * 10))


def czi(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",), least: int = 5) -> DataFrame:
    """China Z index: a normalising transform by the group's (population) skewness."""
    group = Window.partitionBy(*by, *period)
    sd, cs = F.stddev_samp(column).over(group), F.skewness(column).over(group)
    ready = df.withColumns({"__z": F.when((F.count(column).over(group) >= least) & (sd != 0), (F.col(column) - F.avg(column).over(group)) / sd), "__cs": F.when(cs != 0, cs)})
    term = F.greatest(F.col("__cs") * F.col("__z") / 2 + 1, F.lit(1e-6))
    value = 6 / F.col("__cs") * F.pow(term, F.lit(1 / 3)) - 6 / F.col("__cs") + F.col("__cs") / 6
    return ready.withColumn(out, F.when(F.col("__z").isNotNull() & F.col("__cs").isNotNull(), value)).drop("__z", "__cs")


def rai(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",), date: str = "month", least: int = 10) -> DataFrame:
    """Rainfall anomaly index: 3 at the mean of the wettest tenth of a group, -3 at that of the driest."""
    group = Window.partitionBy(*by, *period)
    x = F.col(column)
    n = F.count(x).over(group)
    ranked = df.withColumns({
        "__n": n,
        "__mean": F.avg(x).over(group),
        "__up": F.row_number().over(group.orderBy(F.desc_nulls_last(column), date)),
        "__down": F.row_number().over(group.orderBy(F.asc_nulls_last(column), date)),
    }).withColumn("__m", F.greatest(F.lit(1), F.least(F.floor(F.col("__n") / 10), F.floor(F.col("__n") / 2))))
    top = F.avg(F.when(F.col("__up") <= F.col("__m"), x)).over(group)
    bottom = F.avg(F.when(F.col("__down") <= F.col("__m"), x)).over(group)
    mean = F.col("__mean")
    value = F.when(x >= mean, F.try_divide(3 * (x - mean), top - mean)).otherwise(F.try_divide(-3 * (mean - x), mean - bottom))
    return ranked.withColumn(out, F.when((F.col("__n") >= least) & x.isNotNull(), value)).drop("__n", "__mean", "__up", "__down", "__m")


def pci(monthly: DataFrame, column: str, out: str = "pci", *, by: Sequence[str] = ("cell",), month: str = "month") -> DataFrame:
    """Precipitation concentration index of each year that has twelve months: 100 * sum of squares / square of sum."""
    x = F.col(column)
    yearly = monthly.groupBy(*by, F.year(month).alias("year")).agg(F.count(x).alias("__n"), F.sum(x * x).alias("__s2"), F.sum(x).alias("__s"))
    return yearly.where("__n >= 12").select(*by, "year", (F.try_divide(F.col("__s2"), F.col("__s") * F.col("__s")) * 100).alias(out))


def aridity(precipitation: DataFrame, pet: DataFrame, out: str = "aridity", *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Annual precipitation over annual demand, from (by..., year, p) and (by..., year, pet); NULL unless demand is above 0."""
    both = precipitation.join(pet, [*by, "year"], "full_outer")
    return both.withColumn(out, F.when(F.col("pet") > 0, F.col("p") / F.col("pet")))


def water_balance_anomaly(df: DataFrame, column: str, out: str, period: Sequence[Column | str], *, by: Sequence[str] = ("cell",)) -> DataFrame:
    return df.withColumn(out, F.col(column) - F.avg(column).over(Window.partitionBy(*by, *period)))
