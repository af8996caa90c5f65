"""Makes this package importable in the Python workers of whatever cluster the session has."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Hand the package's modules to Spark once per context, which sends them to executors as it sends jobs."""
    context = spark.sparkContext
    if getattr(context, "_seasonstats_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="seasonstats-")) / "seasonstats_modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._seasonstats_shipped = True
