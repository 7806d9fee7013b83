"""Sending this package's modules to Python workers that cannot import it from their own path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tallyloom

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once; Spark serves the archive to the executors."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    root = os.path.dirname(os.path.abspath(tallyloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "tallyloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
