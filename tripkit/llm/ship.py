"""Make this package importable in Python workers that have not installed it."""

from __future__ import annotations

import os
import tempfile
import zipfile

import tripkit
from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, as ``--py-files`` would.

    The archive is uploaded from the driver by Spark; executors read no driver folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tripkit.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tripkit-"), "tripkit.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tripkit", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
