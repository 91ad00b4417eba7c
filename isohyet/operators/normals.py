"""Day-of-year normals, circular smoothing and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def doy_normals(daily: DataFrame, columns: Sequence[str], baseline: tuple[int, int], *, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Mean of each day of the year over the baseline years (both included)."""
    chosen = daily.where(F.year("day").between(*baseline))
    return chosen.groupBy(*by, F.dayofyear("day").alias("doy")).agg(*[F.avg(c).alias(c) for c in columns])


def smooth_circular(normals: DataFrame, columns: Sequence[str], width: int = 5, *, by: Sequence[str] = ("cell",), position: str = "doy") -> DataFrame:
    """Centred mean over ``width`` neighbouring positions; the year's ends are neighbours.

    A window that holds a NULL, or a year shorter than the window, gives NULL; width 1 changes nothing.
    """
    if width <= 1:
        return normals
    half = width // 2
    span = 2 * half + 1
    order = Window.partitionBy(*by).orderBy(position)
    placed = normals.withColumns({"__pos": F.row_number().over(order), "__n": F.count(F.lit(1)).over(Window.partitionBy(*by))})
    # only the edges are repeated: the last ``half`` before the first and the first ``half`` after the last
    shifts = F.array(F.lit(0), F.when(F.col("__pos") > F.col("__n") - half, -1), F.when(F.col("__pos") <= half, 1))
    wrapped = placed.withColumn("__turn", F.explode(F.filter(shifts, lambda s: s.isNotNull())))
    near = Window.partitionBy(*by).orderBy(F.col("__pos") + F.col("__turn") * F.col("__n")).rowsBetween(-half, half)
    smooth = wrapped.withColumns({c: F.when(F.count(c).over(near) == span, F.avg(c).over(near)) for c in columns})
    return smooth.where("__turn = 0").drop("__pos", "__n", "__turn")


def anomalies(daily: DataFrame, normals: DataFrame, columns: Sequence[str], *, by: Sequence[str] = ("cell",), percent_of: str | None = None, broadcast_rows: int | None = None) -> DataFrame:
    """``{column}_anomaly`` = value - normal of its day of the year; NULL where the baseline lacks that day.

    ``percent_of`` adds ``{column}_pct_of_normal`` (where the normal is above 0). ``broadcast_rows``, if the
    caller has counted the normals, lets them be broadcast when they are few enough.
    """
    table = normals.select(*by, "doy", *[F.col(c).alias(f"__n_{c}") for c in columns])
    if broadcast_rows is not None and broadcast_rows <= 1_000_000:
        table = F.broadcast(table)
    out = daily.withColumn("doy", F.dayofyear("day")).join(table, [*by, "doy"], "left")
    out = out.withColumns({f"{c}_anomaly": F.col(c) - F.col(f"__n_{c}") for c in columns})
    if percent_of:
        out = out.withColumn(f"{percent_of}_pct_of_normal", F.when(F.col(f"__n_{percent_of}") > 0, F.col(percent_of) / F.col(f"__n_{percent_of}") * 100))
    return out.drop(*[f"__n_{c}" for c in columns])
