"""Makes the package importable in Python workers, wherever the driver loaded it from."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

import corpusloom


@cache
def _archive() -> str:
    root = os.path.dirname(os.path.abspath(corpusloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


_shipped: set[str] = set()


def ship(source: DataFrame | SparkSession) -> None:
    """Send the package to the executors once for each Spark application. Spark's own file
    distribution carries it, also to executors that join later."""
    spark = source if isinstance(source, SparkSession) else source.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_archive())
        _shipped.add(application)
