"""Rewriting only the partitions of a sink that have changed.

A partition's digest doesn't depend on the order of its rows: their number, the sum and the exclusive or of their
64-bit hashes (under two seeds). The digests of a sink lie beside it in a manifest. They are a row for each
partition, and they are made by one grouping that Spark combines before the shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.sources import workbook


def digests(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """(partitions..., rows, digest). Columns count by name, in any order; NULL and an empty text differ; equal rows count each."""
    names = sorted(set(df.columns) - set(partitions))
    told = [x for c in names for x in (F.lit(c), F.col(c).isNull(), F.col(c))]
    one, two = F.xxhash64(F.lit(1), *told), F.xxhash64(F.lit(2), *told)
    sums = df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("rows"), F.sum(one.cast("decimal(20,0)")).alias("__a"), F.bit_xor(two).alias("__b"))
    return sums.select(*partitions, "rows", F.format_string("%s:%s:%016x", F.col("rows").cast("string"), F.col("__a").cast("string"), F.col("__b")).alias("digest"))


def compared(new: DataFrame, old: DataFrame | None, partitions: Sequence[str]) -> DataFrame:
    """(partitions..., rows, digest, state): kept, changed, new, or gone (rows and digest of the old one)."""
    if old is None:
        return new.select(*partitions, "rows", "digest", F.lit("new").alias("state"))
    both = new.alias("n").join(old.alias("o"), [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in partitions], "full_outer")
    state = F.when(F.col("n.digest").isNull(), "gone").when(F.col("o.digest").isNull(), "new").when(F.col("n.digest") == F.col("o.digest"), "kept").otherwise("changed")
    pick = lambda c: F.coalesce(f"n.{c}", f"o.{c}").alias(c)
    return both.select(*map(pick, partitions), pick("rows"), pick("digest"), state.alias("state"))


def write_changed(df: DataFrame, path: str, *, partitions: Sequence[str] = ("variable", "year")) -> DataFrame:
    """Bring the sink at ``path`` to the rows of ``df``, rewriting what is new or has changed; returns ``compared``.

    Partitions that ``df`` lacks are deleted. Fields are written before the manifest: a run that breaks off in between
    rewrites the same partitions next time. An empty ``df`` empties the sink. ``df`` is scanned twice, once for the
    digests and once for what is rewritten; filters on partition columns prune the second scan.
    """
    spark = df.sparkSession
    log = f"{path}/_manifest"
    old = workbook.read(spark, log, ["digests"])["digests"] if workbook.versions(spark, log) else None
    stage = f"{path}/_compared-{uuid.uuid4().hex}"
    compared(digests(df, partitions), old, partitions).coalesce(1).write.parquet(stage)
    found = spark.read.parquet(stage)
    todo = found.where(F.col("state").isin("new", "changed")).select(*partitions)
    if not todo.isEmpty():
        rows = df.join(F.broadcast(todo), _same(df, todo, partitions), "left_semi")  # one row for each partition of the sink
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{path}/fields")
    for gone in found.where("state = 'gone'").select(*partitions).toLocalIterator():
        workbook._fs(spark, path).delete(workbook._path(spark, f"{path}/fields/{_folder(spark, gone.asDict())}"), True)
    current = found.where("state <> 'gone'").select(*partitions, "rows", "digest")
    workbook.write(spark, log, {"digests": lambda: current, "compared": lambda: found})
    workbook._fs(spark, path).delete(workbook._path(spark, stage), True)
    return workbook.read(spark, log, ["compared"])["compared"]


def _same(a: DataFrame, b: DataFrame, partitions: Sequence[str]):
    test = F.lit(True)
    for c in partitions:
        test &= a[c].eqNullSafe(b[c])
    return test


def _folder(spark: SparkSession, values: dict) -> str:
    """The folder of a partition, as Spark names it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(names.getPartitionPathString(c, None if v is None else str(v)) for c, v in values.items())
