"""Making the package importable in Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once per application.

    Needed where executors do not find the package by themselves: grouped pandas functions are
    sent by reference to their module.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    base = Path(tempfile.mkdtemp(prefix="package-")) / package.name
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
