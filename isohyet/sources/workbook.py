"""Workbooks: a set of named tables that readers see whole or not at all.

Each write makes a fresh version of folders and, last, a manifest that names them. Renaming the manifest into place is
the only step that readers notice; it fails if somebody else has published meanwhile. The version before stays
for readers that have it open; older ones are deleted.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

log = logging.getLogger(__name__)
_MANIFEST = "manifest-"


@dataclass(frozen=True)
class Outcome:
    """Of one table: ``status`` is written or failed, with the rows or the first line of the error."""

    name: str
    status: str
    rows: int
    error: str
    cause: Exception | None = None


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def _rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error if there is one of the new name."""
    jvm = spark._jvm
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, source).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), spark.sparkContext._gateway.new_array(options, 0))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests, oldest first."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(_path(spark, path))]
    return sorted(int(n.removeprefix(_MANIFEST)) for n in names if n.startswith(_MANIFEST))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, tuple[str, str]]:
    """Folder and note of each table; FileNotFoundError where there is no workbook."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no workbook in {path}")
    rows = spark.read.schema("name string, folder string, note string").json(f"{path}/{_MANIFEST}{version or found[-1]:06d}")
    return {r["name"]: (r["folder"], r["note"]) for r in rows.collect()}  # one row for each table of the workbook


def write_each(spark: SparkSession, makers: Mapping[str, Callable[[], DataFrame]], folder: str, *, parallel: int = 4) -> list[Outcome]:
    """Write what each maker plans to ``folder``/name, each as a job group of its own, ``parallel`` at a time.

    An error while planning or in a task fails that table alone: what is left of its jobs is cancelled and its folder
    goes. Under ``spark.scheduler.mode`` FAIR each table has a pool, so a long one doesn't hold up the others.
    """
    context = spark.sparkContext

    def one(name: str, make: Callable[[], DataFrame]) -> Outcome:
        group = f"{name}-{uuid.uuid4().hex}"
        context.setJobGroup(group, f"table {name}", True)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            counted = Observation(group)
            make().observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{name}")
            return Outcome(name, "written", counted.get["rows"], "")
        except Exception as e:  # whatever it is, it is this table's
            log.exception("table %s failed", name)
            context.cancelJobGroup(group)
            _fs(spark, folder).delete(_path(spark, f"{folder}/{name}"), True)
            return Outcome(name, "failed", 0, (str(e).strip() or type(e).__name__).splitlines()[0][:500], e)

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(one), name, make) for name, make in makers.items()]
        return [f.result() for f in futures]


def _publish(spark: SparkSession, path: str, version: str, notes: Mapping[str, str]) -> None:
    found = versions(spark, path)
    rows = [(name, f"{path}/tables/{version}/{name}", note) for name, note in notes.items()]
    spark.createDataFrame(rows, "name string, folder string, note string").coalesce(1).write.json(f"{path}/new-{version}")
    old = {folder for n in found[-1:] for folder, _ in manifest(spark, path, n).values()}
    _rename_new(spark, f"{path}/new-{version}", f"{path}/{_MANIFEST}{(found[-1] if found else 0) + 1:06d}")
    fs, keep = _fs(spark, path), {version, *(f.rsplit("/", 2)[1] for f in old)}
    for n in found[:-1]:
        fs.delete(_path(spark, f"{path}/{_MANIFEST}{n:06d}"), True)
    for status in fs.listStatus(_path(spark, f"{path}/tables")):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def write(spark: SparkSession, path: str, makers: Mapping[str, Callable[[], DataFrame]], notes: Mapping[str, str] | None = None, *, parallel: int = 1) -> None:
    """Publish all tables as the next version. If one fails, its error is raised and the workbook stays as it was."""
    version = uuid.uuid4().hex
    outcomes = write_each(spark, makers, f"{path}/tables/{version}", parallel=parallel)
    if bad := [o for o in outcomes if o.cause]:
        _fs(spark, path).delete(_path(spark, f"{path}/tables/{version}"), True)
        raise bad[0].cause
    _publish(spark, path, version, {name: (notes or {}).get(name, "") for name in makers})


def write_isolated(spark: SparkSession, path: str, makers: Mapping[str, Callable[[], DataFrame]], notes: Mapping[str, str] | None = None, *, parallel: int = 4) -> DataFrame:
    """Publish the tables that could be written, and one, ``status``, of (name, status, rows, error) of all; that is returned."""
    version = uuid.uuid4().hex
    folder = f"{path}/tables/{version}"
    outcomes = write_each(spark, makers, folder, parallel=parallel)
    rows = [(o.name, o.status, o.rows, o.error) for o in outcomes]
    spark.createDataFrame(rows, "name string, status string, rows long, error string").coalesce(1).write.parquet(f"{folder}/status")
    _publish(spark, path, version, {o.name: (notes or {}).get(o.name, "") for o in outcomes if not o.cause} | {"status": "what became of each table"})
    return spark.read.parquet(f"{folder}/status")


def read(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the version that is current now; KeyError for a name that it lacks."""
    found = manifest(spark, path)
    return {name: spark.read.parquet(found[name][0]) for name in (found if names is None else names)}
