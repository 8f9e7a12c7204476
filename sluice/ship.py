"""Makes this package importable in the Python workers of a session that wasn't started with it on its path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to all executors, once an application; nothing where PYTHONPATH already holds it."""
    here = Path(__file__).resolve().parent
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    app = spark.sparkContext.applicationId
    if app in _shipped or any(p and Path(p).resolve() == here.parent for p in paths):
        return
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{here.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted(here.rglob("*.py")):
            out.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
