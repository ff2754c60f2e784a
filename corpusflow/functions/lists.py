"""Array columns: cropping, shifting, summing, histograms, and Arrow list helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Characters, bytes or ids that a function in a task works on at once.
WORK_SIZE = 1 << 20


def row_stretches(sizes: np.ndarray, most: int = WORK_SIZE) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of rows of ``most`` in size together; a larger row is one by itself."""
    ends, low = np.cumsum(sizes, dtype=np.int64), 0
    while low < len(ends):
        done = int(ends[low - 1]) if low else 0
        high = max(int(np.searchsorted(ends, done + most, side="right")), low + 1)
        yield low, high
        low = high


def text_stretches(texts: pa.Array, most: int = WORK_SIZE) -> Iterator[pa.Array]:
    """The texts without nulls, a stretch at a time: what a function makes of them stays small."""
    filled = pc.fill_null(texts, "")
    sizes = pc.binary_length(filled).to_numpy(zero_copy_only=False)
    for low, high in row_stretches(sizes, most):
        yield filled.slice(low, high - low)


def list_array(values: np.ndarray, lengths: np.ndarray, nulls: pa.Array) -> pa.Array:
    """Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if offsets[-1] > np.iinfo(np.int32).max:
        raise OverflowError("an Arrow batch holds too many ids: lower spark.sql.execution.arrow.maxBytesPerBatch")
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values, type=pa.int32()), mask=nulls if nulls.true_count else None
    )


def list_parts(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the end of each list in them (null counts as empty)."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return values, np.cumsum(lengths, dtype=np.int64)


def crop_context(ids: str | Column, block: int) -> Column:
    """The last ``block`` ids; shorter lists stay whole."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.when(F.size(ids) <= block, ids).otherwise(F.slice(ids, -block, block))


def shift_pairs(ids: str | Column, block: int | Column) -> tuple[Column, Column]:
    """Inputs and targets: ``x`` is the first ``block`` ids, ``y`` is ``x`` moved by one."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    block = F.lit(block) if isinstance(block, int) else block
    return F.slice(ids, F.lit(1), block).alias("x"), F.slice(ids, F.lit(2), block).alias("y")


def array_total(values: str | Column) -> Column:
    """Sum of an array of numbers; missing elements are skipped."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v.cast("double"), F.lit(0.0)))


def array_count(values: str | Column) -> Column:
    """Number of elements that are not missing; NULL for a missing array."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: acc + v.isNotNull().cast("bigint"))


def array_mean(values: str | Column) -> Column:
    """Mean of an array of numbers without its missing elements; NULL if none is left."""
    return array_total(values) / F.nullif(array_count(values), F.lit(0))


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the equal-width bin of ``value`` in ``[low, high]``; the last bin is closed.

    Where all values are equal the range is widened by one half on either side.
    The estimate is corrected against the bin edges, so that a value lying on an
    edge always opens the upper bin.
    """
    flat = low == high
    first = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    step = width / bins
    guess = F.least(F.floor((value - first) / width * bins).cast("int"), F.lit(bins - 1))
    return (
        F.when(value < first + guess * step, guess - 1)
        .when((value >= first + (guess + 1) * step) & (guess != bins - 1), guess + 1)
        .otherwise(guess)
    )


def array_histogram(values: str | Column, bins: int = 64) -> Column:
    """Histogram of each array on its own: ``struct(low, high, counts)``.

    Missing and non-finite elements are left out; NULL if nothing is left.  The bins are
    those of :func:`bin_number`, counted in one pass over each array.
    """

    def count(arrays: pd.Series) -> pd.DataFrame:
        found = [_bin_counts(a, bins) for a in arrays]
        return pd.DataFrame(found, columns=["low", "high", "counts"])

    values = F.col(values) if isinstance(values, str) else values
    counted = F.pandas_udf(count, "low double, high double, counts array<int>")(values.cast("array<double>"))
    return F.when(counted["counts"].isNotNull(), counted)


def _bin_counts(values: np.ndarray | None, bins: int) -> tuple[float | None, float | None, np.ndarray | None]:
    """Range and counts of one array, in the arithmetic of :func:`bin_number`."""
    kept = np.array([] if values is None else values, dtype=np.float64)
    kept = kept[np.isfinite(kept)]
    if not len(kept):
        return None, None, None
    low, high = kept.min(), kept.max()
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = 1.0 if kept.min() == kept.max() else high - low
    step = width / bins
    guess = np.minimum(np.floor((kept - low) / width * bins), bins - 1)
    down = kept < low + guess * step
    up = ~down & (kept >= low + (guess + 1) * step) & (guess != bins - 1)
    return low, high, np.bincount((guess - down + up).astype(np.int64), minlength=bins).astype(np.int32)
