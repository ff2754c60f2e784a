"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for reliable checkpoints, as the cluster names it.

    ``spark.checkpoint.dir`` wins.  Only a local master may fall back to a folder
    of its own; on a cluster a machine-local folder would be lost with its host.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="corpusflow-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current


# Paths handed out and not yet cleared.
_OPEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that nobody else uses, until :func:`clear_scratch`."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _OPEN.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this process has made, once no DataFrame needs them any more."""
    count = len(_OPEN)
    while _OPEN:
        delete_path(spark, _OPEN.pop())
    return count


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and go on from the table.

    Cuts the lineage, survives the loss of executors, and lets every reader take only the
    columns it needs.  For rows that several branches read, and for row numbers that must
    not change between two evaluations.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Store what ``make`` gives and delete the intermediate tables that making it has left."""
    before = len(_OPEN)
    out = stored(make(), name)
    for path in _OPEN[before:-1]:
        delete_path(spark, path)
    del _OPEN[before:-1]
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system: one without a scheme means the session's, not each executor's disk."""
    files, place = _hadoop(spark, path)
    return files.makeQualified(place).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark reads."""
    files, place = _hadoop(spark, path)
    return files.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder; none for a file."""
    files, place = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder the library wrote itself; a missing one is fine."""
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place
