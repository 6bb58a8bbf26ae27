"""Sending this package to Python workers, for classes and functions that are pickled by name."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(), f"{root.name}_package.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(to)
    _shipped.add(sc.applicationId)
