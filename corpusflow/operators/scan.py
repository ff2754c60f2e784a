"""Ordered scans that no single task has to hold: prefix sums, running minima, numbering.

A window over a whole split or a whole run puts all its rows into one task, and one
run may hold a third of the table.  The scans here cut the order key into buckets of
at most ``2**bits`` keys, scan inside the buckets, and scan the bucket totals the same
way until one bucket is left.  Windows therefore never see more than ``2**bits`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpusflow.functions.joins import join_null_safe
from corpusflow.scratch import stored

# Rows that one window may hold.
SCAN_BITS = 16
# Rows of a few numbers each that are sent to every executor; more are joined by shuffle.
BROADCAST_ROWS = 500_000

_MERGE = {
    "sum": (F.sum, lambda a, b: a + b),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def _required(df: DataFrame, name: str) -> Column:
    """The key column, failing on NULL.

    The constant behind the failure is never reached; it makes the key non-nullable, so
    that no null filter is added to one of two branches that should share an exchange.
    """
    kind = df.schema[name].dataType
    zero = "1970-01-01" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "0"
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"ordered scan: {name} is null")), F.lit(zero).cast(kind))


def _reads(*names: str) -> Column:
    """An aggregate that is never NULL and reads the named columns.

    Column pruning then leaves the bucket totals the same input as the window beside
    them, and Spark runs one exchange for both.
    """
    return F.max(F.xxhash64(*names)).isNotNull()


def exclusive_scan(
    df: DataFrame,
    value: str | Column,
    order: str,
    by: Sequence[str] = (),
    out: str = "before",
    how: str = "sum",
    bits: int = SCAN_BITS,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``out``: the sum, min or max of ``value`` over all rows before this one.

    ``order`` is an integer column, unique within ``by``; a repeated or missing key
    fails the job.  The first row of a group gets NULL (0 for sums).  ``bounds`` saves
    the pass that looks up the smallest and largest key.  Select only the columns the
    scan needs and join the result to wide rows afterwards.
    """
    if bounds is None:
        low, high = df.agg(F.min(order), F.max(order)).first()
        bounds = (low or 0, high or 0)
    value = F.col(value) if isinstance(value, str) else value
    guarded = {name: _required(df, name) for name in (*by, order)}
    rows = df.withColumn("_value", value).withColumns(guarded)
    scanned = _scan(rows, order, tuple(by), out, how, bits, *bounds).drop("_value")
    return scanned.withColumn(out, F.coalesce(out, F.lit(0).cast(scanned.schema[out].dataType))) if how == "sum" else scanned


def _scan(df: DataFrame, order: str, by: tuple[str, ...], out: str, how: str, bits: int, low: int, high: int) -> DataFrame:
    aggregate, merge = _MERGE[how]
    if high - low < 1 << bits:
        return df.withColumn(out, _before(aggregate, order, by))
    bucket = f"{order}_hi"
    keys = [*by, bucket]
    rows = df.withColumn(bucket, F.shiftright(F.col(order).cast("bigint"), bits)).repartition(*keys)
    inner = rows.withColumn("_inner", _before(aggregate, order, keys))
    totals = rows.groupBy(*keys).agg(F.when(_reads(*keys, order, "_value"), aggregate("_value")).alias("_value"))
    outer = _scan(totals, bucket, by, "_outer", how, bits, low >> bits, high >> bits)
    joined = inner.join(outer.select(*keys, "_outer"), keys)
    combined = (
        F.when(F.col("_outer").isNull(), F.col("_inner"))
        .when(F.col("_inner").isNull(), F.col("_outer"))
        .otherwise(merge(F.col("_outer"), F.col("_inner")))
    )
    return joined.select(*[c for c in df.columns], combined.alias(out))


def _before(aggregate, order: str, keys: Sequence[str]) -> Column:
    ordered = Window.partitionBy(*keys).orderBy(order)
    running = aggregate("_value").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    repeated = F.lag(order).over(ordered) == F.col(order)
    return F.when(repeated, F.raise_error(F.lit(f"ordered scan: {order} is not unique"))).otherwise(running)


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "iter") -> DataFrame:
    """Add ``out``: 0, 1, 2… within ``by``, ordered by any columns.

    Rows are range-partitioned on the full key, so a large group spreads over many
    tasks; each row's place in its task is known without a window.  The cut points of
    a range partitioning differ from one evaluation to the next, so the places are
    fixed in a stored table before they are used twice.  Rows without a group key are a
    group; a key that occurs twice fails the job, as nothing says which row comes first.
    """
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    # Equal keys share a range partition and lie next to each other: no further exchange or sort.
    counted = ranged.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy(*by, *order)))
    # The id holds the partition in its upper 31 bits and the place in its lower 33.
    counted = counted.withColumn("_place", F.monotonically_increasing_id())
    repeated = F.raise_error(F.lit(f"row numbers: {', '.join([*by, *order])} is not unique"))
    placed = stored(counted.withColumn("_place", F.when(F.col("_same") > 1, repeated).otherwise(F.col("_place"))).drop("_same"), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy(*by, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    # at most one row per group and range partition
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    keys = [*by, "_part"]
    # Counted before it is broadcast: without the hint Spark plans a shuffle of all rows.
    runs = stored(runs.select(*keys, "_first", "_base"), "runs")
    small = runs.count() <= BROADCAST_ROWS
    numbered = join_null_safe(placed, F.broadcast(runs) if small else runs, keys)
    return numbered.select(*df.columns, (F.col("_base") + F.col("_place") - F.col("_first")).alias(out))


def find_position(
    df: DataFrame,
    length: str | Column,
    order: str,
    target: int | None = None,
    fraction: float | None = None,
    bits: int = SCAN_BITS,
) -> tuple[int, int] | None:
    """Key of the row that holds position ``target`` of the concatenation, and the offset in it.

    Instead of a position, ``fraction`` of the whole length (rounded down) may be given.
    Descends the same buckets as :func:`exclusive_scan`, but follows only the bucket
    that holds the target: every step is one partial aggregation to at most ``2**bits``
    sums, on a key range that the scan can push down.
    """
    if (target is None) == (fraction is None):
        raise ValueError("give either target or fraction")
    rows = df.select(F.col(order).cast("bigint").alias("key"), (F.col(length) if isinstance(length, str) else length).alias("len"))
    low, high, missing = rows.agg(F.min("key"), F.max("key"), F.count_if(F.col("key").isNull())).first()
    if missing:
        raise ValueError(f"{order} is null in {missing} rows")
    if low is None:
        return None
    shift = 0
    while (high >> shift) - (low >> shift) >= 1 << bits:
        shift += bits
    before = 0
    while True:
        buckets = rows.groupBy(F.shiftright("key", shift).alias("bucket")).agg(
            F.sum("len").alias("len"), F.count("*").alias("rows")
        )
        ordered = Window.orderBy("bucket")
        earlier = F.sum("len").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        everything = F.sum("len").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        wanted = F.floor(everything.cast("double") * fraction) if target is None else F.lit(target)
        placed = buckets.withColumns({"start": F.coalesce(earlier, F.lit(0)) + before, "target": wanted})
        hit = placed.where((F.col("start") <= F.col("target")) & (F.col("start") + F.col("len") > F.col("target"))).first()
        if hit is None:
            return None
        target = hit["target"]
        if shift == 0:
            if hit["rows"] > 1:
                raise ValueError(f"{order} {hit['bucket']} is not unique")
            return hit["bucket"], target - hit["start"]
        before, first = hit["start"], hit["bucket"] << shift
        rows = rows.where(F.col("key").between(first, first + (1 << shift) - 1))
        shift -= bits
