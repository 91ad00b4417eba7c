"""Sources and sinks: partitioned Parquet fields, result tables and run metadata."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.sources import workbook

#: Folders below the output folder of a run.
FOLDERS = ("raw", "processed", "normals", "anomalies", "indices", "plots", "logs")
_TIME_NAMES, _LAT_NAMES, _LON_NAMES = ("ts", "time", "valid_time"), ("lat", "latitude"), ("lon", "longitude")


def build_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in FOLDERS}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that nothing has yet, in the folder that ``spark.checkpoint.dir`` names or, where it is unset (tests), a local one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{named.rstrip('/') if named else f'file://{tempfile.gettempdir()}'}/isohyet-{name}-{uuid.uuid4().hex}"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere: NaN would count, sort and sum as a value."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_hourly(spark: SparkSession, path: str | Sequence[str], *, variable: str | None = None, years: tuple[int, int] | None = None, months: Sequence[int] | None = None) -> DataFrame:
    """Long hourly fields (variable, ts, lat, lon, value) from Parquet partitioned by variable, year and month.

    Time and coordinate columns may have any of the usual names; others are dropped. Filters on the
    partition columns prune files.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if variable:
        df = df.where(F.col("variable") == variable)
    if years:
        df = df.where(F.col("year").between(*years))
    if months:
        df = df.where(F.col("month").isin(*months))
    pick = lambda names: F.col(next(n for n in names if n in df.columns))
    return nan_to_null(df.select("variable", pick(_TIME_NAMES).cast("timestamp_ntz").alias("ts"), pick(_LAT_NAMES).cast("double").alias("lat"), pick(_LON_NAMES).cast("double").alias("lon"), F.col("value").cast("double").alias("value")))


def read_years(spark: SparkSession, path: str, years: tuple[int, int]) -> DataFrame:
    """Daily fields of the years; FileNotFoundError where there are none."""
    df = nan_to_null(spark.read.parquet(path)).where(F.col("year").between(*years))
    if df.isEmpty():
        raise FileNotFoundError(f"no year of {years} in {path}")
    return df


def cell_id(lat, lon, step: float = 0.1):
    """Whole-number key of a grid cell; joins never compare coordinates."""
    rows = int(round(360 / step))
    return (F.round((lat + 90) / step) * rows + F.round((lon + 180) / step)).cast("long")


def write_fields(df: DataFrame, path: str, *, partitions: Sequence[str] = ("variable", "year")) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_workbook(tables: Mapping[str, DataFrame], path: str, notes: Mapping[str, str] | None = None) -> None:
    """Publish all result tables with their notes, or none: see ``workbook``."""
    if tables:
        workbook.write(next(iter(tables.values())).sparkSession, path, {name: (lambda df=df: df) for name, df in tables.items()}, notes)


def read_workbook(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return workbook.read(spark, path, names)


def one_decimal(value: Column) -> Column:
    """Text of a double with one decimal, rounded by the number's exact binary value, ties to even (Java's formatter
    rounds the shortest decimal text instead: 23.15, which is a little less, would give 23.2). For values below 10**14."""
    x = F.abs(value)
    big, small = x * 16, x * 4
    twenty = big + small
    lost = small - (twenty - big)  # what the sum has rounded off
    near = F.rint(twenty)
    over = (twenty - near) + lost
    low = (near - 1) / 2
    tie = F.when(over > 0, low + 1).when(over < 0, low).otherwise(low + low % 2)
    tenths = F.when(near % 2 == 0, near / 2).otherwise(tie)
    return F.concat(F.when(value < 0, "-").otherwise(""), F.format_string("%.1f", tenths / 10))


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """Index, Mean, Min, Max, Units with one decimal, ordered by name."""
    one = lambda c: one_decimal(F.col(c))
    rows = summary.orderBy("index").select(F.col("index").alias("Index"), one("mean").alias("Mean"), one("min").alias("Min"), one("max").alias("Max"), F.col("units").alias("Units"))
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # one row per index


#: Standard attributes of the output columns.
ATTRIBUTES = {
    "t2m": {"units": "degC", "long_name": "2 metre temperature"},
    "d2m": {"units": "degC", "long_name": "2 metre dewpoint temperature"},
    "tp": {"units": "mm", "long_name": "total precipitation"},
    "u10": {"units": "m s-1", "long_name": "10 metre eastward wind"},
    "v10": {"units": "m s-1", "long_name": "10 metre northward wind"},
    "sp": {"units": "hPa", "long_name": "surface pressure"},
    "ssrd": {"units": "MJ m-2", "long_name": "surface solar radiation downwards"},
}


def stamp(df: DataFrame, *, source: str, region: str, step: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with attributes in its column metadata, and a one-row table that says how it was made.

    A column takes the attributes of the variable that its name starts with; an anomaly says so.
    """
    columns = []
    for c in df.columns:
        own = ATTRIBUTES.get(c.split("_")[0])
        if own:
            own = own | ({"long_name": f"{own['long_name']} anomaly"} if c.endswith("_anomaly") else {})
        columns.append(F.col(c).alias(c, metadata=own) if own else F.col(c))
    line = f"{dt.datetime.now(dt.UTC):%Y-%m-%dT%H:%M:%SZ}: {step}"
    meta = df.sparkSession.createDataFrame([("CF-1.8", source, region, line)], "conventions string, source string, region string, history string")
    return df.select(*columns), meta
