"""Tables written by the library: vocabularies, registries, run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store ``(id, ch)``; the size is the number of rows."""
    vocab.select("id", "ch").write.mode(mode).parquet(path)


def append_registry(df: DataFrame, path: str) -> None:
    """Add run or checkpoint folders to a growing list."""
    df.write.mode("append").parquet(path)


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    """Append long metrics ``(run_id, iter, grp, key, value)``.

    Folders by group, of which there are a few; runs would make a folder each.  Rows are
    ordered by run within a file, so that a reader of one run skips row groups.
    """
    ordered = metrics.repartitionByRange("grp", "run_id", "iter").sortWithinPartitions("grp", "run_id", "iter")
    ordered.write.mode("append").partitionBy("grp").parquet(path)
