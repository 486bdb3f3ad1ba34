"""Making the package known to Python workers, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import vellum


def ship(spark: SparkSession) -> None:
    """Give the executors a zip of this package, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_vellum_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(vellum.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="vellum-"), "vellum-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("vellum", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._vellum_shipped = True
