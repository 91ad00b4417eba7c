"""Sending this package to the tasks, for sources that run Python there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once for a Spark context; without the optional subpackage of training-data operators."""
    context = spark.sparkContext
    if getattr(context, "_isohyet_sources_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-")).resolve() / f"{package.name}_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            if "llm" not in path.relative_to(package).parts:
                out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._isohyet_sources_shipped = True
