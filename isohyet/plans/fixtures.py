"""Climate-like tables derived from the driver's tables, each with the SQL text of the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_spine(grouped: DataFrame) -> DataFrame:
    return grouped.groupBy("cell").agg(F.min("day").alias("a"), F.max("day").alias("b")).select("cell", F.explode(F.sequence("a", "b")).alias("day"))


def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, day, tp, tmean, tmax, tmin) by nation of the supplier; days without rows have tp 0 and no temperature."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_extendedprice") / 1000).alias("t"), F.col("l_shipdate").cast("date").alias("day"))
    cells = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("cell"))
    grouped = items.join(cells, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("cell", "day").agg(F.sum("l_quantity").alias("tp"), F.avg("t").alias("tmean"), F.max("t").alias("tmax"), F.min("t").alias("tmin"))
    return _day_spine(grouped).join(grouped, ["cell", "day"], "left").withColumn("tp", F.coalesce("tp", F.lit(0.0)))


DAILY = """g AS (SELECT s_nationkey AS cell, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS tp, AVG(l_extendedprice / 1000) AS tmean,
 MAX(l_extendedprice / 1000) AS tmax, MIN(l_extendedprice / 1000) AS tmin FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
spine AS (SELECT cell, CAST(UNNEST(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE) AS day FROM g GROUP BY cell),
daily AS (SELECT cell, day, COALESCE(tp, CAST(0 AS DOUBLE)) AS tp, tmean, tmax, tmin FROM spine LEFT JOIN g USING (cell, day))"""

MONTHLY = DAILY + """,
monthly AS (SELECT cell, CAST(date_trunc('month', day) AS DATE) AS month, SUM(tp) AS tp, AVG(tmean) AS tmean, COUNT(*) AS n_days FROM daily GROUP BY 1, 2)"""


def indicator_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, day, tmax, tmin, pr) of two cells with a value on nearly every day."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 2).cast("int").alias("cell"), F.col("l_shipdate").cast("date").alias("day"), "l_extendedprice", "l_quantity", "l_tax")
    grouped = rows.groupBy("cell", "day").agg(
        ((F.avg("l_extendedprice") / 1000 - 38) * 1.5 + 24).alias("tmax"),
        ((F.avg("l_quantity") - 25.5) * 3 + 8).alias("tmin"),
        F.sum(F.when(F.col("l_quantity") > 47, F.col("l_tax") * 100 + 0.5).otherwise(0.0)).alias("pr"),
    )
    return _day_spine(grouped).join(grouped, ["cell", "day"], "left")


INDICATOR = """g AS (SELECT CAST(l_suppkey % 2 AS INTEGER) AS cell, CAST(l_shipdate AS DATE) AS day, (AVG(l_extendedprice) / 1000 - 38) * CAST(1.5 AS DOUBLE) + 24 AS tmax,
 (AVG(l_quantity) - CAST(25.5 AS DOUBLE)) * 3 + 8 AS tmin, SUM(CASE WHEN l_quantity > 47 THEN l_tax * 100 + CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS pr FROM lineitem GROUP BY 1, 2),
spine AS (SELECT cell, CAST(UNNEST(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE) AS day FROM g GROUP BY cell),
days AS (SELECT cell, day, CAST(year(day) AS INTEGER) AS year, tmax, tmin, pr FROM spine LEFT JOIN g USING (cell, day))"""


def hourly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, ts, v, accum): hundredths of the events' values by user and hour, every hour of a cell, and their
    running total that restarts with the 01:00 value of each day."""
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events").select((F.col("user_id") % 10).cast("int").alias("cell"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "value")
    hours = events.groupBy("cell", "ts").agg(F.round(F.sum("value") * 100).cast("long").alias("v"))
    spine = hours.groupBy("cell").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select("cell", F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("ts"))
    dense = spine.join(hours, ["cell", "ts"], "left").withColumn("v", F.coalesce("v", F.lit(0)))
    cycle = (F.col("ts") - F.expr("interval 1 hour")).cast("date")
    return dense.withColumn("accum", F.sum("v").over(Window.partitionBy("cell", cycle).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)))


HOURLY = """e AS (SELECT CAST(user_id % 10 AS INTEGER) AS cell, date_trunc('hour', ts) AS ts, CAST(ROUND(SUM(value) * 100) AS BIGINT) AS v FROM events GROUP BY 1, 2),
sp AS (SELECT cell, UNNEST(generate_series(MIN(ts), MAX(ts), INTERVAL 1 HOUR)) AS ts FROM e GROUP BY cell),
dense AS (SELECT cell, ts, COALESCE(v, 0) AS v FROM sp LEFT JOIN e USING (cell, ts)),
hourly AS (SELECT cell, ts, v, CAST(SUM(v) OVER (PARTITION BY cell, CAST(ts - INTERVAL 1 HOUR AS DATE) ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS accum FROM dense)"""


def met_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, ts, t, td, tp, u, v, rs, p) in raw units from the mean value of each hour's events, two cells.

    Means come from whole hundredths, and temperatures are whole 1024ths, so that their sums are exact in any order.
    """
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 2).cast("int").alias("cell"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "value")
    x = events.groupBy("cell", "ts").agg((F.sum(F.round(F.col("value") * 100).cast("long")).cast("double") / (F.count("*") * 100)).alias("x"), F.max("value").alias("y"))
    part = lambda k: F.round(F.col("x") * k) / 1024
    return x.select("cell", "ts", (285 + part(51.2)).alias("t"), (284 + part(20.48)).alias("td"), (F.col("y") * 1e-6).alias("tp"), (F.col("x") * 0.05).alias("u"), (F.col("y") * 0.02 - 2).alias("v"), (F.col("y") * 2000).alias("rs"), (95000 + F.col("x") * 10).alias("p"))


MET = """x AS (SELECT CAST(user_id % 2 AS INTEGER) AS cell, date_trunc('hour', ts) AS ts, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / (COUNT(*) * 100) AS x, MAX(value) AS y FROM events GROUP BY 1, 2),
met AS (SELECT cell, ts, 285 + ROUND(x * 51.2::DOUBLE) / 1024 AS t, 284 + ROUND(x * 20.48::DOUBLE) / 1024 AS td, y * 1e-6::DOUBLE AS tp, x * 0.05::DOUBLE AS u, y * 0.02::DOUBLE - 2 AS v, y * 2000 AS rs, 95000 + x * 10 AS p FROM x)"""


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(variable, year, month) that 'exist': orders stand for files by customer, and a variable's month is there
    if it has at least as many orders as the variable's mean month. All orders count."""
    from pyspark.sql import Window

    variable = F.when(F.pmod("o_custkey", F.lit(3)) == 0, "t2m").when(F.pmod("o_custkey", F.lit(3)) == 1, "tp").otherwise("sp")
    per = table(spark, sf_dir, "orders").groupBy(variable.alias("variable"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    of = Window.partitionBy("variable")  # three variables, a row for each of their months
    return per.withColumns({"total": F.sum("n").over(of), "months": F.count("*").over(of)}).where("n * months >= total").select("variable", "year", "month")


def months_of_orders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of all orders."""
    return tuple(map(str, table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()))


INVENTORY = """per AS (SELECT CASE o_custkey % 3 WHEN 0 THEN 't2m' WHEN 1 THEN 'tp' ELSE 'sp' END AS variable, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3),
have AS (SELECT variable, year, month FROM (SELECT *, SUM(n) OVER (PARTITION BY variable) AS total, COUNT(*) OVER (PARTITION BY variable) AS months FROM per) WHERE n * months >= total)"""
WANTED = """want AS (SELECT UNNEST(['t2m', 'tp', 'sp']) AS variable, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM (SELECT UNNEST(generate_series(date_trunc('month', MIN(o_orderdate)), MAX(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders))"""
