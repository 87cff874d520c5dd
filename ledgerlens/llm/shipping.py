"""Makes this package importable in Spark's Python workers, wherever the driver imported it from."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

import ledgerlens

_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = pathlib.Path(ledgerlens.__file__).parent
    _shipped[app] = folder = tempfile.TemporaryDirectory(prefix="ledgerlens-")
    archive = f"{folder.name}/ledgerlens-source.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
