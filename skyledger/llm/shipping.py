"""Makes the package importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import skyledger

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(skyledger.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="skyledger-"), "skyledger_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
