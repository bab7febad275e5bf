"""Brings this package to the workers, whatever folder the driver runs in."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession, *modules: Path) -> None:
    """Sends a zip of the package, and of modules beside it, to the executors of this application; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for file in [*package.rglob("*.py"), *modules]:
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
