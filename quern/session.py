"""Makes the package importable by Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's sources to the executors unless PYTHONPATH names them already.

    Spark's own file server hands them out; the driver's copy need not outlive it.
    """
    context = spark.sparkContext
    if str(ROOT) in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))) or getattr(context, "_quern_shipped", False):
        return spark
    path = Path(tempfile.mkdtemp(prefix="quern-package-")) / "quern.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((ROOT / "quern").rglob("*.py")):
            archive.write(file, file.relative_to(ROOT))
    context.addPyFile(str(path))
    context._quern_shipped = True
    return spark
