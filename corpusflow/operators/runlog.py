"""Analysis of training logs: one row per run and iteration."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpusflow.functions.joins import join_null_safe
from corpusflow.functions.lists import array_count, array_histogram, array_mean, array_total, bin_number
from corpusflow.functions.nested import flatten_struct
from corpusflow.operators.scan import SCAN_BITS, exclusive_scan

# Fixed value: the loss that any first evaluation improves on.
NO_BEST = 1e9


def every_n(df: DataFrame, n: int | Column, step: str = "iter") -> DataFrame:
    """Rows of every n-th iteration."""
    return df.where(F.col(step) % n == 0)


def first_iters(df: DataFrame, n: int, step: str = "iter") -> DataFrame:
    """Rows of the first ``n`` iterations of every run."""
    return df.where(F.col(step) < n)


def adjust_log_interval(df: DataFrame, interval: int, run: str = "run_id", step: str = "iter", out: str = "log_interval") -> DataFrame:
    """Add the interval at which a run is logged: a twentieth of its length if it is shorter than ``interval``."""
    lengths = df.groupBy(run).agg((F.max(step) + 1).cast("bigint").alias("_iters"))
    wanted = F.when(F.col("_iters") < interval, F.greatest(F.lit(1).cast("bigint"), F.expr("_iters div 20"))).otherwise(F.lit(interval).cast("bigint"))
    return join_null_safe(df, lengths.select(run, wanted.alias(out)), [run])


def logged_steps(df: DataFrame, interval: int, run: str = "run_id", step: str = "iter") -> DataFrame:
    """Rows that are logged under the adjusted interval."""
    adjusted = adjust_log_interval(df, interval, run, step)
    return every_n(adjusted, F.col("log_interval"), step)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of two timestamps in seconds, as DOUBLE."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1e6)


def step_dt(df: DataFrame, run: str = "run_id", step: str = "iter", ts: str = "ts", out: str = "dt", bits: int = SCAN_BITS, dense: bool = False) -> DataFrame:
    """Add the seconds since the previous iteration of the run; NULL for its first.

    ``dense`` says that iterations have no gaps, as :func:`corpusflow.operators.scan.number_rows`
    gives them: then one exchange suffices, as the last row of a bucket of iterations is
    sent to the next bucket as well.
    """
    if dense:
        bucket = lambda step: F.shiftright(step.cast("bigint"), bits)
        rows = df.withColumns({"_bucket": bucket(F.col(step)), "_carried": F.lit(False)})
        carried = rows.where((F.col(step) + 1) % (1 << bits) == 0).withColumns({"_bucket": F.col("_bucket") + 1, "_carried": F.lit(True)})
        # null runs are a group of windows like any other
        along = Window.partitionBy(run, "_bucket").orderBy(step)
        before = F.lag(F.struct(F.col(ts).alias("ts"), F.col(step).alias("step"))).over(along)
        timed = rows.unionByName(carried).repartition(run, "_bucket").withColumn("_before", before)
        gap = F.raise_error(F.concat(F.lit("step_dt: no single row before iteration "), F.col(step).cast("string")))
        known = F.when(F.col(step) == 0, F.col("_before").isNull()).otherwise(F.coalesce(F.col("_before.step") == F.col(step) - 1, F.lit(False)))
        checked = timed.where(~F.col("_carried")).withColumn(out, F.when(known, seconds_between(F.col(ts), F.col("_before.ts"))).otherwise(gap))
        return checked.drop("_bucket", "_carried", "_before")
    latest = F.struct(F.col(step).alias("step"), F.col(ts).alias("ts"))
    scanned = exclusive_scan(df, latest, step, by=[run], out="_prev", how="max", bits=bits)
    return scanned.withColumn(out, seconds_between(F.col(ts), F.col("_prev.ts"))).drop("_prev")


# Rows that one window of a moving average holds at most.
EMA_ROWS = 4096
# Largest exponent by which weights inside a segment may differ; doubles end near 700.
EMA_RANGE = 600.0


def ema_segment(log_keep: float) -> int:
    """Rows of a segment whose weights, ``exp(log_keep)`` per row, stay within doubles; 1 if two rows already do not."""
    return max(1, min(EMA_ROWS, int(EMA_RANGE / -log_keep)))


def ema(
    df: DataFrame,
    value: str = "loss",
    alpha: float = 0.1,
    run: str = "run_id",
    step: str = "iter",
    out: str = "ema",
    initial: str | None = None,
    bits: int = SCAN_BITS,
) -> DataFrame:
    """Add the moving average: the first value, then ``(1 - alpha)·old + alpha·new``.

    A run is cut into segments.  Inside one the recurrence has a closed form that a running
    sum gives; a segment as a whole is again one step of such a recurrence, so the ends of
    segments are carried on the same way, level by level.  Nothing is cut off: a NaN or
    infinite value stays in the average for good.  No window holds more than
    ``EMA_ROWS`` rows, however long the run and whatever ``alpha``.  Missing values are
    skipped and get NULL.  ``initial`` names a column with the average before the first row.
    """
    if not 0.0 < alpha < 1.0:
        raise ValueError("alpha must lie between 0 and 1")
    keep = 1.0 - alpha
    present = F.when(F.col(value).isNull(), 0).otherwise(1).cast("bigint")
    ranked = exclusive_scan(df, present, step, by=[run], out="_rank", bits=bits)
    start = F.lit(None).cast("double") if initial is None else F.col(initial)
    fresh = F.col(value) if initial is None else F.coalesce(keep * start + alpha * F.col(value), F.col(value))
    added = F.when(F.col("_rank") == 0, fresh).otherwise(alpha * F.col(value))
    known = ranked.where(F.col(value).isNotNull()).select(run, step, "_rank", added.alias("_e"))
    longest = known.agg(F.max("_rank")).first()[0]
    done = _carried(known.drop(step), run, math.log1p(-alpha), longest or 0, bits)
    places = ranked.withColumn("_at", F.when(F.col(value).isNotNull(), F.col("_rank")))
    joined = places.join(done.select(run, F.col("_rank").alias("_at"), "_c"), [run, "_at"], "left")
    return joined.select(*df.columns, F.col("_c").alias(out))


def _carried(rows: DataFrame, run: str, log_keep: float, longest: int, bits: int) -> DataFrame:
    """``run, _rank, _c`` with ``_c = exp(log_keep)·before + _e`` along ``_rank`` 0, 1, 2…"""
    size = ema_segment(log_keep)
    if size == 1:
        # weights beyond the row before vanish; what is not finite never does
        odd = F.when(F.isnan("_e") | (F.abs("_e") == float("inf")), F.col("_e")).otherwise(F.lit(0.0))
        bad = exclusive_scan(rows, odd, "_rank", by=[run], out="_bad", bits=bits, bounds=(0, longest))
        before = rows.select(run, (F.col("_rank") + 1).alias("_rank"), F.col("_e").alias("_d"))
        joined = bad.join(before, [run, "_rank"], "left")
        return joined.select(run, "_rank", (F.col("_e") + F.coalesce(math.exp(log_keep) * F.col("_d"), F.lit(0.0)) + F.col("_bad")).alias("_c"))
    cut = rows.withColumns({"_seg": F.expr(f"_rank div {size}"), "_i": (F.col("_rank") % size).cast("double")})
    inside = Window.partitionBy(run, "_seg").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    weight = F.exp(F.col("_i") * log_keep)
    local = cut.withColumn("_c", weight * F.sum(F.col("_e") / weight).over(inside))
    if longest < size:
        return local.select(run, "_rank", "_c")
    # the last row of a whole segment holds its end; the last segment carries on to nothing
    ends = local.where(F.col("_i") == size - 1).select(run, F.col("_seg").alias("_rank"), F.col("_c").alias("_e"))
    carried = _carried(ends, run, log_keep * size, longest // size, bits).select(run, (F.col("_rank") + 1).alias("_seg"), F.col("_c").alias("_carry"))
    joined = local.join(carried, [run, "_seg"], "left")
    total = F.col("_c") + F.coalesce(F.exp((F.col("_i") + 1) * log_keep) * F.col("_carry"), F.lit(0.0))
    return joined.select(run, "_rank", total.alias("_c"))


def best_so_far(
    df: DataFrame,
    value: str = "val",
    run: str = "run_id",
    step: str = "iter",
    always: bool = False,
    bits: int = SCAN_BITS,
) -> DataFrame:
    """Add ``best`` (smallest earlier loss) and ``save`` (this one is better, or ``always``; never at iteration 0).

    A missing validation loss counts as infinity.
    """
    scanned = exclusive_scan(df, value, step, by=[run], out="best", how="min", bits=bits)
    best = F.coalesce(F.col("best"), F.lit(NO_BEST))
    improved = F.coalesce(F.col(value), F.lit(float("inf"))) < best
    return scanned.withColumns({"best": best, "save": (F.col(step) > 0) & (improved | F.lit(always))})


def mean_loss(df: DataFrame, by: Sequence[str] = ("split",), loss: str = "loss") -> DataFrame:
    """Mean evaluation loss of each split."""
    return df.groupBy(*by).agg(F.avg(loss).alias("loss"))


def timer_summary(df: DataFrame, timers: Sequence[str] = ("dt", "dtf", "dtb")) -> DataFrame:
    """Add ``<timer>_tot`` and ``<timer>_avg`` for timers that hold one value per micro-step."""
    made = {}
    for name in timers:
        made[f"{name}_tot"] = array_total(name)
        made[f"{name}_avg"] = array_mean(name)
    return df.withColumns(made)


def timer_totals(df: DataFrame, by: Sequence[str] = ("run_id",), timers: Sequence[str] = ("dt", "dtf", "dtb")) -> DataFrame:
    """Sum and mean of the micro-step timers over whole runs."""
    made = []
    for name in timers:
        total = F.sum(array_total(name))
        made += [total.alias(f"{name}_tot"), (total / F.nullif(F.sum(array_count(name)), F.lit(0))).alias(f"{name}_avg")]
    return df.groupBy(*by).agg(*made)


def average_metrics(df: DataFrame, by: Sequence[str] = (), sep: str = "/") -> DataFrame:
    """``(by…, key, value)``: mean of every metric, nested names as ``a/b``, missing values skipped.

    The means are taken column by column in one pass and turned into rows afterwards.
    Array metrics are averaged over all their elements.
    """
    flat = flatten_struct(df, sep)
    means = []
    for field in flat.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in by:
            continue
        if isinstance(field.dataType, T.ArrayType):
            counted = F.nullif(F.sum(array_count(column)), F.lit(0))
            means.append((field.name, F.sum(array_total(column)) / counted))
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            means.append((field.name, F.avg(column.cast("double"))))
    wide = flat.groupBy(*[f"`{b}`" for b in by]).agg(*[m.alias(name) for name, m in means])
    entries = F.array(*[F.struct(F.lit(name).alias("key"), F.col(f"`{name}`").alias("value")) for name, _ in means])
    return wide.select(*[f"`{b}`" for b in by], F.inline(entries)).where(F.col("value").isNotNull())


def histogram(df: DataFrame, value: str, bins: int = 64, by: Sequence[str] = ()) -> DataFrame:
    """``(by…, bin, low, high, cnt)``: equal-width bins over the range of each group; empty bins are left out.

    ``low`` and ``high`` are the range of the group.  Both passes are partial aggregations.
    """
    present = df.where(F.col(value).isNotNull())
    low, high = F.min(value).alias("low"), F.max(value).alias("high")
    if by:
        ranged = join_null_safe(present, present.groupBy(*by).agg(low, high), list(by))
    else:
        ends = present.agg(low, high).first()
        ranged = present.withColumns({name: F.lit(ends[name]).cast("double") for name in ("low", "high")})
    number = bin_number(F.col(value), F.col("low"), F.col("high"), bins)
    return ranged.groupBy(*by, number.alias("bin"), "low", "high").agg(F.count("*").alias("cnt"))


def epoch_iters(totals: DataFrame, tokens_per_iter: int) -> DataFrame:
    """Add ``iters``: iterations that read every token of a split once."""
    return totals.withColumn("iters", F.col("tokens") / F.lit(float(tokens_per_iter)))


def metrics_long(
    df: DataFrame,
    groups: dict[str, Sequence[str]],
    keys: Sequence[str] = ("run_id", "iter"),
    bins: int = 64,
) -> DataFrame:
    """``(keys…, grp, key, value)``: one row per metric, grouped as Training, Timing, Loss…

    An array metric ``a`` is a histogram: its range as ``a/low`` and ``a/high``, and the counts of
    its ``bins`` equal bins as ``a/0``, ``a/1``…; all are NULL for an array without numbers.
    """
    named = {}
    for grp, names in groups.items():
        for name in names:
            if isinstance(df.schema[name].dataType, T.ArrayType):
                made = f"_{name}_bins"
                df = df.withColumn(made, array_histogram(name, bins))
                named |= {f"{grp}/{name}/{end}": F.col(f"{made}.{end}") for end in ("low", "high")}
                named |= {f"{grp}/{name}/{b}": F.col(f"{made}.counts")[b].cast("double") for b in range(bins)}
            else:
                named[f"{grp}/{name}"] = F.col(name).cast("double")
    wide = df.select(*keys, *[c.alias(n) for n, c in named.items()])
    long = wide.unpivot([F.col(k) for k in keys], [F.col(f"`{n}`") for n in named], "name", "value")
    parts = F.split("name", "/", 2)
    return long.select(*keys, parts[0].alias("grp"), parts[1].alias("key"), "value")
