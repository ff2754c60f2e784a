"""The package itself for the Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import weakref
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet[SparkContext] = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers, once per Spark context.

    Functions that run in tasks are found by import.  Workers know the package only if it
    is installed there or happens to lie in their folder.
    """
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="corpusflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).parent
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED.add(context)
