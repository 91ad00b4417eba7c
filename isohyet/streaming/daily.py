"""Hourly to daily aggregation of a stream, with a watermark for late rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.operators.daily import AGGREGATES


def daily_stream(hourly: DataFrame, aggregates: Mapping[str, Sequence[str]], *, by: Sequence[str] = ("cell",), late: str = "1 day") -> DataFrame:
    """(by..., day, {variable}_{aggregate}...) of a stream (by..., ts TIMESTAMP, values...).

    A day is final, and leaves the state, once the watermark has passed it by ``late``; later rows of it are
    dropped. The same plan runs on a static table.
    """
    outputs = [AGGREGATES[how](name).alias(f"{name}_{how}") for name, hows in aggregates.items() for how in hows]
    windowed = hourly.withWatermark("ts", late).groupBy(*by, F.window("ts", "1 day")).agg(*outputs)
    return windowed.withColumn("day", F.col("window.start").cast("date")).drop("window")
