"""Row-wise functions supplied by the user."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, types as T


def map_rows(
    df: DataFrame,
    fn: Callable[[dict], dict],
    schema: T.StructType | str,
    remove_columns: Sequence[str] = (),
) -> DataFrame:
    """Apply ``fn`` to every row as a dict and add the columns it returns.

    ``schema`` describes the returned columns; all other columns are kept, except
    ``remove_columns``.  One task per partition, whole Arrow batches at a time.
    """
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    new = added.fieldNames()
    kept = [c for c in df.columns if c not in remove_columns and c not in new]
    result = T.StructType([*[df.schema[c] for c in kept], *added.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [fn(row) for row in batch.to_dict("records")]
            values = {name: pd.Series([m[name] for m in made], dtype=object) for name in new}
            yield batch[kept].assign(**values)

    return df.mapInPandas(run, result)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """All columns but ``names``."""
    return df.drop(*names)
