"""Named bands of index values, half-open [low, high), and the CASE expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOW, _HIGH = float("-inf"), float("inf")


# Published class limits and names, as (low, high, label).
DROUGHT = [
    (_LOW, -2.0, "Extremely dry"),
    (-2.0, -1.5, "Severely dry"),
    (-1.5, -1.0, "Moderately dry"),
    (-1.0, 1.0, "Near normal"),
    (1.0, 1.5, "Moderately wet"),
    (1.5, 2.0, "Severely wet"),
    (2.0, _HIGH, "Extremely wet"),
]
PNI = [
    (_LOW, 25.0, "Extreme drought"),
    (25.0, 50.0, "Severe drought"),
    (50.0, 75.0, "Moderate drought"),
    (75.0, 100.0, "Mild drought"),
    (100.0, _HIGH, "Above normal"),
]
TEMPERATURE = [
    (_LOW, -2.0, "Much colder than normal"),
    (-2.0, -1.0, "Colder than normal"),
    (-1.0, 1.0, "Normal"),
    (1.0, 2.0, "Hotter than normal"),
    (2.0, _HIGH, "Much hotter than normal"),
]
PCI = [
    (_LOW, 11.0, "Uniform"),
    (11.0, 16.0, "Moderate"),
    (16.0, 20.0, "Irregular"),
    (20.0, _HIGH, "Strongly irregular (concentrated)"),
]
ARIDITY = [
    (_LOW, 0.03, "Hyper-arid"),
    (0.03, 0.2, "Arid"),
    (0.2, 0.5, "Semi-arid"),
    (0.5, 0.65, "Dry sub-humid"),
    (0.65, _HIGH, "Humid"),
]
DEPARTURE = [
    (_LOW, -99.0, "No rain"),
    (-99.0, -60.0, "Scanty"),
    (-60.0, -20.0, "Deficient"),
    (-20.0, 20.0, "Normal"),
    (20.0, _HIGH, "Excess"),
]
DECILE = [
    (0.0, 2.0, "Drought (severe)"),
    (2.0, 3.0, "Drought (moderate)"),
    (3.0, 5.0, "Below normal"),
    (5.0, 7.0, "Normal"),
    (7.0, 9.0, "Above normal"),
    (9.0, 11.0, "Much above normal"),
]


def categorize(value: Column, bands: list[tuple[float, float, str]]) -> Column:
    """Label of the band that holds ``value``; '' for NULL, NaN and values in no band."""
    case = None
    for low, high, label in bands:
        inside = F.lit(True)
        if low != _LOW:
            inside = inside & (value >= low)
        inside = inside & (value < high)  # no band holds NaN or infinity
        case = F.when(inside, label) if case is None else case.when(inside, label)
    return case.otherwise("")


def band_table(spark, bands) -> DataFrame:
    return spark.createDataFrame([(float(a), float(b), c) for a, b, c in bands], "low double, high double, label string")


def categorize_by_join(df: DataFrame, column: str, bands: list[tuple[float, float, str]], name: str) -> DataFrame:
    """The same as a range join with the (constant-size, broadcast) band table."""
    table = F.broadcast(band_table(df.sparkSession, bands))
    inside = (F.col(column) >= F.col("low")) & (F.col(column) < F.col("high"))
    return df.join(table, inside, "left").withColumn(name, F.coalesce("label", F.lit(""))).drop("low", "high", "label")


def sql_case(value: str, bands) -> str:
    """The CASE text of ``categorize`` for SQL engines."""
    parts = []
    for low, high, label in bands:
        tests = [f"{value} >= {low!r}"] * (low != _LOW) + [f"{value} < {high!r}" if high != _HIGH else f"{value} < 'inf'::DOUBLE"]
        parts.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '' END"
