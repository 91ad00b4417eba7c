"""Command line: choose variables, period, region and indices; read hourly Parquet, write result tables.

    python -m isohyet.cli --input HOURLY --output FOLDER --vars t2m,tp --indices spi,pni --bbox 21.3 78.9 20.9 79.3
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from isohyet.operators import annual, boundaries
from isohyet.operators.regions import resolve_region
from isohyet.plans import plots
from isohyet.plans.config import Settings
from isohyet.plans.run import NEEDS, Run, wanted_indices
from isohyet.sources import tables, workbook

STAGES = ("daily", "agromet", "normals", "anomalies", "indices", "annual", "plots", "all")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="isohyet", description=__doc__)
    p.add_argument("stage", nargs="?", choices=STAGES, default="all")
    p.add_argument("--input", required=True, help="hourly Parquet: variable, ts, lat, lon, value by variable, year, month")
    p.add_argument("--output", required=True)
    p.add_argument("--name", default="region")
    p.add_argument("--bbox", nargs=4, type=float, metavar=("N", "W", "S", "E"))
    p.add_argument("--boundary", help="KML or GeoJSON file")
    p.add_argument("--vars", default="t2m,tp")
    p.add_argument("--indices", default="spi", help="all, or some of " + ", ".join(NEEDS))
    p.add_argument("--start", default="1991-01-01")
    p.add_argument("--end", default="2020-12-31")
    p.add_argument("--baseline", nargs=2, type=int)
    p.add_argument("--step", type=float, default=0.1, help="grid spacing in degrees")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    split = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    settings = Settings(variables=split(args.vars), period=(args.start, args.end), baseline=tuple(args.baseline) if args.baseline else None, indices=split(args.indices))
    try:
        wanted_indices(settings.indices, settings.variables)
        boundary = open(args.boundary, encoding="utf-8").read() if args.boundary else None
        region = resolve_region(args.name, bbox=args.bbox, boundary=boundary, buffer=settings.boundary_buffer)
    except ValueError as e:
        p.error(str(e))
    spark = spark or SparkSession.builder.appName("isohyet").getOrCreate()
    if args.stage == "plots":  # from saved tables alone: the hourly input is not read
        _plots(spark, tables.build_paths(args.output))
        return 0
    years = (int(args.start[:4]), int(args.end[:4]))
    long = tables.read_hourly(spark, args.input, years=years).where(F.col("variable").isin(*settings.variables))
    long = long.where(F.col("lat").between(region.south, region.north) & F.col("lon").between(region.west, region.east)).withColumn("cell", tables.cell_id(F.col("lat"), F.col("lon"), args.step))
    wide = long.groupBy("cell", "ts").pivot("variable", list(settings.variables)).agg(F.first("value", ignorenulls=True))
    paths = tables.build_paths(args.output)

    cells = long.groupBy("cell").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    if boundary:
        cells = boundaries.mark_region(cells, boundaries.edges(spark, boundaries.read_polygons(boundary)), boundaries.Grid(args.step))
    else:
        cells = cells.withColumn("in_region", F.lit(True))
    cells.write.mode("overwrite").parquet(f"{paths['logs']}/cells")  # the hourly rows are scanned for their cells once
    run = Run(wide, spark.read.parquet(f"{paths['logs']}/cells"), settings, store=f"{paths['logs']}/kept")
    if args.stage in ("daily", "all"):
        stamped, meta = tables.stamp(run.daily.withColumn("year", F.year("day")), source=args.input, region=region.name, step="daily")
        tables.write_fields(stamped, paths["processed"], partitions=["year"])
        meta.write.mode("overwrite").parquet(f"{paths['logs']}/daily")
    if args.stage == "agromet" or args.stage == "all" and run.has_agromet:
        tables.write_fields(run.agromet.withColumn("year", F.year("day")), f"{paths['processed']}_agromet", partitions=["year"])
    if args.stage in ("normals", "all"):
        run.normals.write.mode("overwrite").parquet(paths["normals"])
    if args.stage in ("anomalies", "all"):
        tables.write_fields(run.anomalies.withColumn("year", F.year("day")), paths["anomalies"], partitions=["year"])
    if args.stage in ("indices", "all"):
        tables.write_workbook(run.tables(), paths["indices"])
    if args.stage in ("annual", "all"):
        book = f"{paths['indices']}_annual"
        status = workbook.write_isolated(spark, book, run.indicator_makers())
        found = [r["name"] for r in status.where("status = 'written'").select("name").collect()]  # 16 at most
        if found:
            tables.write_summary_csv(annual.summary(workbook.read(spark, book, found)), f"{book}/summary")
    if args.stage == "all":
        _plots(spark, paths)
    return 0


def _plots(spark: SparkSession, paths: dict[str, str]) -> None:
    plots.write(spark, paths["indices"], paths["plots"], anomalies=paths["anomalies"], cells=f"{paths['logs']}/cells")


if __name__ == "__main__":
    raise SystemExit(main())
