"""Planning of what data there is and what is still missing, as joins over tables of (variable, year, month)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Short and long names of the data service's variables.
LONG_NAMES = {
    "t2m": "2m_temperature",
    "d2m": "2m_dewpoint_temperature",
    "tp": "total_precipitation",
    "u10": "10m_u_component_of_wind",
    "v10": "10m_v_component_of_wind",
    "ssrd": "surface_solar_radiation_downwards",
    "sp": "surface_pressure",
}


def long_name(short: str) -> str:
    """KeyError if the variable is unknown."""
    return LONG_NAMES[short]


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(year, month) from the month of ``first`` to that of ``last``, both included."""
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.trunc(F.lit(last).cast("date"), "month"), F.expr("interval 1 month"))).alias("m"))
    return months.select(F.year("m").alias("year"), F.month("m").alias("month"))


def wanted(spark: SparkSession, variables: Sequence[str], first: str, last: str) -> DataFrame:
    """Every (variable, year, month) of a request."""
    return months_between(spark, first, last).select(F.explode(F.array(*map(F.lit, variables))).alias("variable"), "year", "month")


def missing(want: DataFrame, have: DataFrame) -> DataFrame:
    return want.join(have, ["variable", "year", "month"], "left_anti")


def requests(months: DataFrame) -> DataFrame:
    """One request per row of (variable, year, month): its days, hours 0 to 23 and long name."""
    names = F.create_map(*[F.lit(x) for pair in LONG_NAMES.items() for x in pair])
    last = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
    return months.select("variable", "year", "month", names[F.col("variable")].alias("long_name"), F.sequence(F.lit(1), last).alias("days"), F.sequence(F.lit(0), F.lit(23)).alias("hours"))


def batches(gaps: DataFrame, size: int = 3) -> DataFrame:
    """(year, first_month, last_month, variables): runs of at most ``size`` months in a row, in one year, that miss the same variables."""
    per_month = gaps.groupBy("year", "month").agg(F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("variables"))
    same = Window.partitionBy("year", "variables").orderBy("month")
    islands = per_month.withColumn("__i", F.col("month") - F.row_number().over(same))
    inside = Window.partitionBy("year", "variables", "__i").orderBy("month")
    cut = islands.withColumn("__b", F.floor((F.row_number().over(inside) - 1) / size))
    return cut.groupBy("year", "variables", "__i", "__b").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month")).select("year", "first_month", "last_month", "variables")


def latest_common_month(have: DataFrame, variables: Sequence[str]) -> DataFrame:
    """(year, month), one row: the last month that every variable has; no row if there is none."""
    found = have.where(F.col("variable").isin(*variables)).groupBy("year", "month").agg(F.countDistinct("variable").alias("n"))
    return found.where(F.col("n") == len(set(variables))).agg(F.max(F.struct("year", "month")).alias("m")).where("m is not null").select("m.year", "m.month")


_SPLIT = """
WITH RECURSIVE request(year, first_month, last_month, variables, most, depth) AS (
  SELECT b.year, b.first_month, b.last_month, b.variables, l.most, 0 FROM {batches} b LEFT JOIN {limits} l ON l.year = b.year
  UNION ALL
  SELECT year, part.first_month, part.last_month, part.variables, most, depth + 1 FROM (
    SELECT year, most, depth, explode(
      CASE WHEN last_month > first_month THEN transform(sequence(first_month, last_month), m -> struct(m AS first_month, m AS last_month, variables))
      ELSE array(
        struct(first_month, last_month, slice(variables, 1, size(variables) div 2) AS variables),
        struct(first_month, last_month, slice(variables, size(variables) div 2 + 1, size(variables)) AS variables)) END) AS part
    FROM request
    WHERE (last_month - first_month + 1) * size(variables) > most AND (last_month > first_month OR size(variables) > 1)))
SELECT year, first_month, last_month, variables, depth, coalesce(size(variables) > most, false) AS refused FROM request
WHERE most IS NULL OR (last_month - first_month + 1) * size(variables) <= most OR (last_month = first_month AND size(variables) = 1)"""


def split_refused(requested: DataFrame, limits: DataFrame) -> DataFrame:
    """Requests that the service takes: (year, first_month, last_month, variables, depth, refused), variables joined by commas.

    ``requested`` has what ``batches`` gives, ``limits`` the ``most`` files (variables x months) of one request of a
    year; a year without a limit takes anything. A request that is too large is asked again a month at a time; one
    month that is too large in halves of its variables (the smaller half first), and so on. ``depth`` counts the
    splits; what can't be split and is still too large is ``refused``.
    """
    spark = requested.sparkSession
    listed = requested.withColumn("variables", F.split("variables", ",")).withColumns({c: F.col(c).cast("int") for c in ("year", "first_month", "last_month")})
    found = spark.sql(_SPLIT, batches=listed, limits=limits.select(F.col("year").cast("int").alias("year"), F.col("most").cast("int").alias("most")))
    return found.withColumn("variables", F.array_join("variables", ","))
