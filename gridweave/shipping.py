"""Gives the executors this package, which they may not have installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_done: dict[str, str] = {}


def ship(spark: SparkSession | None = None) -> None:
    """Hands out the package's files by Spark's own file server, once for each application."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or (app := spark.sparkContext.applicationId) in _done:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="gridweave-"), "gridweave_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _done[app] = path
