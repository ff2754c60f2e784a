"""Parquet tables spread over the available cores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition only if the scan has fewer partitions than there are cores.

    A large table is left as it is; a small one in a single file would otherwise be
    worked on by one core.  Meant for work per character; lengths and keys are cheaper
    to take from the scan itself.
    """
    execution = df._jdf.queryExecution()
    if execution.executedPlan().nodeName().startswith("AdaptiveSparkPlan"):
        return df  # shuffled already, and asking for its partitions would run it
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if execution.toRdd().getNumPartitions() >= wanted else df.repartition(wanted, key)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` and further columns of the corpus table."""
    wanted = ["doc_id", "text", *[c for c in columns if c not in ("doc_id", "text")]]
    return read_table(spark, folder, "documents").select(*wanted)


def spread_documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The same for work per character."""
    return spread(read_documents(spark, folder, *columns), "doc_id")
