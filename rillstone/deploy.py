"""Makes this package importable in Python workers that would not find it on their own."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's files with the application, unless workers inherit a path that holds them."""
    package = Path(__file__).resolve().parent
    root = str(package.parent)
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if app in _shipped or os.path.realpath(os.getcwd()) == root or root in paths:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), "rillstone.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
