"""Next-token statistics from counts: fitting, probabilities, sampling, loss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpusflow.functions.hashing import hash_uniform
from corpusflow.functions.lists import crop_context, list_parts, row_stretches
from corpusflow.operators.scan import SCAN_BITS
from corpusflow.scratch import stored
from corpusflow.ship import ship_package

# Fixed value: ids are 16 bit, so a context of up to three of them packs into a BIGINT.
ID_SPAN = 65536
MAX_ORDER = 4
# Up to so many bits an n-gram indexes a table of counts (16 MiB at most) instead of being sorted.
DENSE_BITS = 21
# Distinct n-grams that a task adds up before it hands them on.
HELD_GRAMS = 1 << 20


def pack_context(ids: Column, size: int) -> Column:
    """The last ``size`` ids of an array as one BIGINT; 0 for an empty context."""
    packed = F.lit(0).cast("bigint")
    for back in range(size, 0, -1):
        packed = packed * ID_SPAN + F.element_at(ids, -back).cast("bigint")
    return packed


def context_key(ids: Column, size: int) -> Column:
    """The last ``size`` ids as the ``ctx`` of counts: one number while they fit, else an array."""
    return pack_context(ids, size) if size < MAX_ORDER else F.slice(ids, -size, size)


def _words(n: int) -> list[str]:
    """Columns of an n-gram packed into 64-bit numbers of four ids each, the last one full."""
    return [f"_w{i}" for i in range(-(-n // MAX_ORDER))]


def _packed(ids: Sequence[np.ndarray]) -> np.ndarray:
    """The ids of n-grams, one array for each place in them, as rows of those numbers."""
    words = []
    for end in range(len(ids), 0, -MAX_ORDER):
        word = np.zeros(len(ids[0]), np.uint64)
        for column in ids[max(end - MAX_ORDER, 0) : end]:
            word <<= np.uint64(16)
            word |= column.astype(np.uint64)
        words.insert(0, word)
    return np.stack(words)


def _gram_counts(rows: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """Partial counts of the n-grams of every row, packed: ``(by…, _w0…, cnt)``.

    A stretch of rows is counted at a time, and a task adds up what it has counted while that is
    not more than ``HELD_GRAMS`` n-grams: a worker's memory follows neither table nor batch.
    """
    ship_package(rows.sparkSession)
    fields = [rows.schema[name] for name in by]
    result = T.StructType([*fields, *[T.StructField(name, T.LongType()) for name in [*_words(n), "cnt"]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple[np.ndarray, np.ndarray]]] = {}
        size, kinds = 0, []

        def merge() -> int:
            for key, parts in held.items():
                held[key] = [_added(parts)]
            return sum(len(counts) for [(_, counts)] in held.values())

        def handed_on() -> Iterator[pa.RecordBatch]:
            for key, [(words, counts)] in held.items():
                columns = [pa.array([k] * len(counts), type=kind) for k, kind in zip(key, kinds)]
                columns += [pa.array(word.view(np.int64)) for word in words]
                yield pa.record_batch([*columns, pa.array(counts)], names=result.fieldNames())
            held.clear()

        for batch in batches:
            kinds = [batch.column(i).type for i in range(len(by))]
            lists = batch.column(len(by))
            lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
            for low, high in row_stretches(lengths):
                keys = [*zip(*[batch.column(i).slice(low, high - low).to_pylist() for i in range(len(by))])]
                for key, found in _stretch_counts(lists.slice(low, high - low), n, keys):
                    held.setdefault(key, []).append(found)
                    size += len(found[1])
                if size > HELD_GRAMS:
                    size = merge()
                    if size > HELD_GRAMS // 2:
                        yield from handed_on()
                        size = 0
        merge()
        yield from handed_on()

    return rows.select(*by, "ids").mapInArrow(run, result)


def _stretch_counts(lists: pa.Array, n: int, keys: list[tuple]) -> Iterator[tuple[tuple, tuple[np.ndarray, np.ndarray]]]:
    """For each key of the rows, or one empty key: the packed n-grams inside its rows, and how often each occurs."""
    values, ends = list_parts(lists)
    if len(values) < n:
        return
    if values.min() < 0 or values.max() >= ID_SPAN:
        raise ValueError(f"n-grams need ids from 0 to {ID_SPAN - 1}")
    starts = np.concatenate([[0], ends[:-1]])
    # an n-gram is known by its last id; the first n - 1 ids of a row end none
    whole = np.ones(len(values), dtype=bool)
    for i in range(n - 1):
        whole[(starts + i)[starts + i < ends]] = False
    whole = whole[n - 1 :]
    groups: dict[tuple, list[int]] = {}
    for row, key in enumerate(keys):
        groups.setdefault(key, []).append(row)
    if len(groups) < 2:
        yield next(iter(groups), ()), _count_grams(values, np.flatnonzero(whole), n)
        return
    owner = np.repeat(np.arange(len(ends)), ends - starts)[n - 1 :]
    for key, members in groups.items():
        mine = np.zeros(len(ends), dtype=bool)
        mine[members] = True
        yield key, _count_grams(values, np.flatnonzero(whole & mine[owner]), n)


def _count_grams(values: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams that begin at ``places``, packed, and how often each occurs.

    With the ids in use numbered anew, an n-gram mostly fits one 64-bit number, and counting is
    counting equal numbers.  Where it does not, its first ids are numbered, then those numbers
    and the next two ids again, up to its length.
    """
    used = np.flatnonzero(np.bincount(values))
    bits = max(int(len(used) - 1).bit_length(), 1)
    if bits * n > 64:
        first, counts = _count_long(values, places, n)
        return _packed([values[first + i] for i in range(n)]), counts
    numbers = np.zeros(int(used[-1]) + 1, np.uint64)
    numbers[used] = np.arange(len(used), dtype=np.uint64)
    plain, grams = numbers[values], np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        grams <<= np.uint64(bits)
        grams |= plain[i : len(grams) + i]
    grams = grams[places]
    if bits * n <= DENSE_BITS:
        table = np.bincount(grams.astype(np.int64))
        found = np.flatnonzero(table)
        counts, found = table[found], found.astype(np.uint64)
    else:
        found, counts = np.unique(grams, return_counts=True)
    mask = np.uint64((1 << bits) - 1)
    return _packed([used[(found >> np.uint64(bits * (n - 1 - i))) & mask] for i in range(n)]), counts.astype(np.int64)


def _count_long(values: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct n-gram that begins at one of ``places``, and how often it occurs."""
    [numbers] = _packed([values[places + i] for i in range(MAX_ORDER)])
    for i in range(MAX_ORDER, n, 2):
        numbers = np.unique(numbers, return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
        numbers |= values[places + i].astype(np.uint64) << np.uint64(16)
        if i + 1 < n:
            numbers |= values[places + i + 1].astype(np.uint64)
    _, first, counts = np.unique(numbers, return_index=True, return_counts=True)
    return places[first], counts.astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the same n-grams added up."""
    if len(parts) == 1:
        return parts[0]
    words, counts = np.concatenate([w for w, _ in parts], axis=1), np.concatenate([c for _, c in parts])
    if not len(counts):
        return words, counts
    order = np.lexsort(words)
    words = words[:, order]
    starts = np.flatnonzero(np.append(True, (words[:, 1:] != words[:, :-1]).any(axis=0)))
    return words[:, starts], np.add.reduceat(counts[order], starts)


def _total_counts(counts: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """``(by…, ctx, id, cnt)`` of partial counts: n-grams are exchanged as numbers and unpacked at the end."""
    names = _words(n)
    total = counts.groupBy(*by, *names).agg(F.sum("cnt").alias("cnt"))

    def id_at(back: int) -> Column:
        word = F.shiftrightunsigned(names[-1 - back // MAX_ORDER], 16 * (back % MAX_ORDER))
        return word.bitwiseAND(F.lit(ID_SPAN - 1).cast("bigint")).cast("int")

    context = F.shiftrightunsigned(names[0], 16) if n <= MAX_ORDER else F.array(*[id_at(back) for back in range(n - 1, 0, -1)])
    return total.select(*by, context.alias("ctx"), id_at(0).alias("id"), "cnt")


def preceding_ids(edges: DataFrame, size: int, order: str = "doc_id", by: Sequence[str] = ("split",), bits: int = SCAN_BITS) -> DataFrame:
    """Add ``before``: the last ``size`` ids of all rows before this one, from ``edges(by…, order, tail)``.

    ``tail`` holds the last ``size`` ids of a row, all of a shorter one, and is not empty, so
    the ``size`` rows before suffice.  Rows are joined inside buckets of the order key, and
    the ends of buckets the same way, as in :func:`corpusflow.operators.scan.exclusive_scan`.
    """
    low, high = edges.agg(F.min(order), F.max(order)).first()
    return _preceding(edges, size, order, tuple(by), bits, low or 0, high or 0)


def _preceding(edges: DataFrame, size: int, order: str, by: tuple[str, ...], bits: int, low: int, high: int) -> DataFrame:
    def inside(keys: Sequence[str]) -> Column:
        along = Window.partitionBy(*keys).orderBy(order)
        joined = crop_context(F.flatten(F.collect_list("tail").over(along.rowsBetween(-size, -1))), size)
        twice = F.lag(order).over(along) == F.col(order)
        return F.when(twice, F.raise_error(F.lit(f"n-grams: {order} is not unique"))).otherwise(joined)

    if high - low < 1 << bits:
        return edges.withColumn("before", inside(by))
    bucket = f"{order}_hi"
    keys = [*by, bucket]
    rows = edges.withColumn(bucket, F.shiftright(F.col(order).cast("bigint"), bits)).repartition(*keys).withColumn("before", inside(keys))
    both = lambda a, b: crop_context(F.concat(a, b), size)
    ends = rows.groupBy(*keys).agg(F.max_by(both(F.col("before"), F.col("tail")), order).alias("tail"))
    outer = _preceding(ends, size, bucket, by, bits, low >> bits, high >> bits).select(*keys, F.col("before").alias("_outer"))
    return rows.join(outer, keys).withColumn("before", both(F.col("_outer"), F.col("before"))).drop("_outer", bucket)


def count_ngrams(
    rows: DataFrame,
    n: int = 2,
    by: Sequence[str] = (),
    order: str = "doc_id",
    split: str = "split",
    edges: DataFrame | None = None,
    bits: int = SCAN_BITS,
) -> DataFrame:
    """``(by…, ctx, id, cnt)`` of the documents ``rows(split, order, ids)`` in order, n-grams of any length.

    Ids are counted where they are.  What spans documents comes from a summary of each,
    its first and last ``n - 1`` ids: joined in order, over short and empty documents, they
    give the ids before every document.  ``edges(by…, split, order, head, tail)`` may be given
    where it can be had without encoding whole documents.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    keys = list(dict.fromkeys([*by, split]))
    counts = _gram_counts(rows.select(*keys, "ids"), n, by)
    if n > 1:
        edge = n - 1
        if edges is None:
            edges = rows.select(*keys, order, F.slice("ids", 1, edge).alias("head"), crop_context("ids", edge).alias("tail"))
        held = edges.where(F.size("tail") > 0).select(*keys, order, "head", "tail")
        carried = preceding_ids(held, edge, order, keys, bits).where(F.size("before") > 0)
        spanning = carried.select(*keys, F.concat("before", "head").alias("ids")).where(F.size("ids") >= n)
        counts = counts.unionByName(_gram_counts(spanning, n, by))
    return _total_counts(counts, n, by)


def fit_ngram(pages: DataFrame, n: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """``(by…, ctx, id, cnt)``: how often ``id`` follows the ``n - 1`` ids of ``ctx``.

    Counting starts inside the tasks, so a frequent context never travels token by token.
    N-grams across a page border come from the outermost ids of each page alone: two
    short rows per page meet under the number of the border, whole pages stay in place.
    A page of fewer than ``n - 1`` ids before another one fails the job: the context would
    reach back beyond it.
    """
    if not 1 <= n <= MAX_ORDER:
        raise ValueError(f"n must lie between 1 and {MAX_ORDER}")
    keys = list(dict.fromkeys([*by, "split"]))
    counts = _gram_counts(pages.select(*keys, "ids"), n, by)
    if n > 1:
        edge = n - 1
        short = F.raise_error(F.lit(f"{n}-grams need pages of {edge} ids or more"))
        # the start of a page closes the border before it, its end opens the border behind it
        sides = F.array(
            F.struct(F.col("page").alias("border"), F.lit(1).alias("side"), F.slice("ids", 1, edge).alias("part")),
            F.struct(
                (F.col("page") + 1).alias("border"),
                F.lit(0).alias("side"),
                crop_context("ids", edge).alias("part"),
            ),
        )
        borders = (
            pages.select(*keys, F.inline(sides))
            .groupBy(*keys, "border")
            .agg(F.array_sort(F.collect_list(F.struct("side", "part"))).alias("parts"))
            .where(F.size("parts") == 2)
            .select(*keys, F.when(F.size(F.col("parts.part")[0]) < edge, short).otherwise(F.flatten(F.col("parts.part"))).alias("ids"))
        )
        counts = counts.unionByName(_gram_counts(borders, n, by))
    return _total_counts(counts, n, by)


def top_k_ties(df: DataFrame, k: int, by: str | Sequence[str] = "ctx", score: str = "cnt") -> DataFrame:
    """Rows whose score is not below the k-th largest of their group; ties stay."""
    by = [by] if isinstance(by, str) else list(by)
    place = F.rank().over(Window.partitionBy(*by).orderBy(F.desc(score)))
    return df.withColumn("_rank", place).where(F.col("_rank") <= k).drop("_rank")


def next_probs(table: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Add ``p``: softmax of the log-counts at ``temperature`` within each context.

    A context has at most one row per id, so the windows are bounded by the vocabulary.
    """
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    context = Window.partitionBy("ctx")
    score = F.ln("cnt") / temperature
    weight = F.exp(F.col("_score") - F.max("_score").over(context))
    weighted = table.withColumn("_score", score).withColumn("_weight", weight)
    return weighted.withColumn("p", F.col("_weight") / F.sum("_weight").over(context)).drop("_score", "_weight")


def top_k_probs(table: DataFrame, k: int, temperature: float = 1.0) -> DataFrame:
    """Cut every context to its top ``k`` (ties kept), then normalise."""
    return next_probs(top_k_ties(table, k), temperature)


def cumulative_choices(probs: DataFrame) -> DataFrame:
    """``(ctx, choices)``: one row per context, its ids with cumulative probabilities.

    Drawing then needs one row per prompt instead of one per prompt and candidate.
    """
    ordered = Window.partitionBy("ctx").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    summed = probs.select("ctx", F.struct("id", F.sum("p").over(ordered).alias("upto")).alias("choice"))
    return summed.groupBy("ctx").agg(F.array_sort(F.collect_list("choice")).alias("choices"))


def pick(choices: Column, uniform: Column) -> Column:
    """First id whose cumulative probability exceeds ``uniform``, found by bisection."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(ID_SPAN.bit_length() - 1, -1, -1)])

    def farther(at: Column, step: Column) -> Column:
        below = (at + step <= F.size(choices)) & (F.get(choices, at + step - 1)["upto"] <= uniform)
        return F.when(below, at + step).otherwise(at)

    place = F.aggregate(steps, F.lit(0), farther)
    return F.when(F.size(choices) > 0, F.get(choices, F.least(place, F.size(choices) - 1))["id"])


def sample_next(prompts: DataFrame, probs: DataFrame, seed: int, key: str = "key", step: int = 0) -> DataFrame:
    """Add ``next``: one draw per prompt from the distribution of its ``ctx``.

    A context that was never seen gives NULL.  The draw depends on seed, key and step
    only.  Many prompts may share one context: Spark broadcasts the choices where they
    are small, and splits the hot partition of the sort-merge join where they are not.
    """
    uniform = hash_uniform(F.lit(seed), F.col(key), F.lit(step))
    joined = prompts.join(cumulative_choices(probs), "ctx", "left")
    return joined.withColumn("next", pick(F.col("choices"), uniform)).drop("choices")


def continue_prompts(
    prompts: DataFrame,
    table: DataFrame,
    steps: int,
    n: int = 2,
    top_k: int | None = 200,
    temperature: float = 0.8,
    seed: int = 1337,
    key: str = "key",
    store_every: int = 8,
    samples: int | None = None,
) -> DataFrame:
    """Extend ``ids`` of every prompt by up to ``steps`` drawn tokens.

    The last ``n - 1`` ids and what was drawn travel through the steps, the prompts do not: they
    take the drawn ids once, at the end.  A prompt ends early at a context the table does
    not know.  The growing plan is cut every few steps by storing its state.
    With ``samples``, every prompt is continued that many times, each with draws of its
    own, and a column ``sample`` tells them apart.
    """
    if samples is not None:
        if samples < 1:
            raise ValueError("at least one sample")
        prompts = prompts.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    draw = [F.lit(seed), F.col(key)] + ([] if samples is None else [F.col("sample")])
    probs = next_probs(table, temperature) if top_k is None else top_k_probs(table, top_k, temperature)
    choices = stored(cumulative_choices(probs), "choices")
    prompts = stored(prompts.withColumn("_row", F.monotonically_increasing_id()), "prompts")
    names = ["_row", key] + ([] if samples is None else ["sample"])
    tail = F.when(F.size("ids") >= n - 1, F.slice("ids", F.size("ids") - (n - 2), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>"))
    current = prompts.select(*names, tail.alias("_tail"), F.array().cast("array<int>").alias("_drawn"))
    for step in range(steps):
        uniform = hash_uniform(*draw, F.lit(step))
        # a null tail has ended: its context is null and meets nothing
        context = F.when(F.col("_tail").isNotNull(), context_key(F.col("_tail"), n - 1) if n > 1 else F.lit(0).cast("bigint"))
        met = current.withColumn("ctx", context).join(choices, "ctx", "left").withColumn("_token", pick(F.col("choices"), uniform))
        moved = crop_context(F.concat("_tail", F.array("_token")), n - 1) if n > 1 else F.col("_tail")
        current = met.select(
            *names,
            F.when(F.col("_token").isNotNull(), moved).alias("_tail"),
            F.when(F.col("_token").isNull(), F.col("_drawn")).otherwise(F.concat("_drawn", F.array("_token"))).alias("_drawn"),
        )
        if (step + 1) % store_every == 0 and step + 1 < steps:
            current = stored(current, "drawn")
    longer = prompts.join(current.select("_row", "_drawn"), "_row")
    return longer.withColumn("ids", F.concat("ids", "_drawn")).select(*[c for c in prompts.columns if c not in ("ids", "_row")], "ids")


def cross_entropy(
    pairs: DataFrame,
    table: DataFrame,
    vocab_size: int,
    by: Sequence[str] = ("split",),
    ignore: int = -1,
) -> DataFrame:
    """Mean negative log-probability of ``pairs`` under add-one smoothed counts.

    ``pairs`` are counted rows ``(by…, ctx, id, cnt)``: equal pairs are weighted, not
    repeated.  Targets equal to ``ignore`` are left out.
    """
    used = pairs.where(F.col("id") != ignore)
    totals = table.groupBy("ctx").agg(F.sum("cnt").alias("_total"))
    scored = used.join(table.select("ctx", "id", F.col("cnt").alias("_seen")), ["ctx", "id"], "left").join(
        totals, "ctx", "left"
    )
    p = (F.coalesce("_seen", F.lit(0)) + 1.0) / (F.coalesce("_total", F.lit(0)) + float(vocab_size))
    return scored.groupBy(*by).agg(
        (F.sum(-F.ln(p) * F.col("cnt")) / F.sum("cnt")).alias("loss"), F.sum("cnt").alias("targets")
    )


def estimate_loss(blocks: DataFrame, table: DataFrame, vocab_size: int, n: int = 2) -> DataFrame:
    """``(split, iters, loss)``: mean over the iterations of the mean loss of their blocks.

    ``blocks(split, iter, x, y)`` are drawn blocks.  A target is scored with the ``n - 1`` ids
    before it, all within its block.  Equal targets of an iteration are counted in the tasks
    and scored once.
    """
    ids = F.concat(F.slice("x", 1, 1), "y").alias("ids")
    pairs = _gram_counts(blocks.select("split", "iter", ids), n, ["split", "iter"])
    pairs = _total_counts(pairs, n, ["split", "iter"])
    losses = cross_entropy(pairs, table, vocab_size, by=("split", "iter"))
    return losses.groupBy("split").agg(F.count("*").alias("iters"), F.avg("loss").alias("loss"))
