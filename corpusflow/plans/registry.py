"""The named queries and, where SQL can express them, the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from corpusflow.ship import ship_package

# Bytes of text or ids that a Python worker is handed at once, unless the session says otherwise.  Spark's
# own 64 MiB hold thousands of whole documents, and a worker keeps the ids of all of them beside their texts.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 * 1024 * 1024

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, folder) -> DataFrame`` under its name."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            if spark.conf.get(BATCH_SETTING, None) is None:
                spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
            return fn(spark, folder)

        key = name or fn.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
