"""Make this package importable on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's source files to the application, once. Spark serves them to
    every executor, also to those that start later."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="layercake-code-"))
    archive = os.path.join(folder, f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, str(file.relative_to(_PACKAGE.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
