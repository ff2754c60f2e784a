"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies.  Of all rates with
``sum(rate * size) = target`` in each source and ``0 <= rate <= limit``, the ones nearest to
one in relative entropy are ``min(limit, exp(lambda * size / mean))`` with one ``lambda`` per
source.  Newton steps on the dual find it, each a sum over the corpus; a bracket around the
root keeps a step from leaving it.  A source is done when its words come within half a word of
the target, or a billionth of it; all sources step together, so the slowest one sets the
number of rounds.  After ``STEPS`` rounds the rates stand as they are, and what is missing is left to
the settling of whole copies below.  As the rate depends on source and size only, the sums
run over counts by ``(source, size)``.

Rates become whole copies without drift: cells of equal size round their copies along
descending sizes so that the running error stays below half a copy, and what then is left
of a source's words is settled from the largest documents that fit to smaller ones.  Which
documents of a cell get the additional copy follows a hash of the id.

Only DataFrame functions are used.  Null texts have size 0, null sources are a source of
their own and come last.  Documents of size 0 take nothing.  Repeated rows are documents of
their own; rows equal in id and text are told apart by nothing, so it makes no difference
which of them gets a copy.  Very long texts are counted whole.  Columns of the input may have any
names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import SPACE_RUN, free_names
from corpusflow.scratch import stored

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
STEPS = 60
CLOSE = 1e-9
HALF_WORD = 0.5
SETTLINGS = 6
SLICES = 1 << 12


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    empty = (F.element_at(pieces, 1) == "").cast("int") + F.when(F.size(pieces) > 1, (F.element_at(pieces, -1) == "").cast("int")).otherwise(0)
    return (F.size(pieces) - empty).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size, target``: shares by weight, none above ``limit`` times its size.

    With ``r = limit * size / weight``, sources with small ``r`` are the ones that stop.
    In that order, ``level`` is what a unit of weight gets if a source and all before it stop
    short; the first source whose ``r`` reaches its level sets the level for the rest.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("weight", F.element_at(given, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    cap = F.col("source_size").cast("double") * limit
    order = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("open", cap / F.col("weight") >= F.col("level"))
    first = F.max(F.when(F.col("open"), F.col("level"))).over(Window.partitionBy())  # later ones are lower
    return levels.select("source", "source_size", F.least(cap, F.coalesce(first * F.col("weight"), cap)).alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, limit: int = LIMIT, steps: int = STEPS) -> DataFrame:
    """``source, mean, tilt, full`` per source, for ``cells(source, size, n)`` and targets.

    ``full`` marks sources that take ``limit`` times all they have.
    """
    counts = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    state = counts.join(targets, counts.source.eqNullSafe(targets.source)).select(
        counts.source,
        (F.col("words") / F.col("docs")).alias("mean"),
        "target",
        (F.col("target") >= F.col("words") * limit * (1 - CLOSE)).alias("full"),
        F.lit(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(False).alias("done"),
    )
    state = stored(state, "tilts")
    for _ in range(steps):
        if state.where(~F.col("done") & ~F.col("full") & (F.col("target") > 0)).isEmpty():
            break
        state = stored(_newton(cells, state, limit), "tilts")
    return state.select("source", "mean", "tilt", "full", "target")


def _rate(limit: int) -> Column:
    raised = F.col("tilt") * F.col("size") / F.col("mean")
    return F.when(F.col("full"), F.lit(float(limit))).otherwise(F.when(raised >= F.log(F.lit(float(limit))), F.lit(float(limit))).otherwise(F.exp(raised)))


def _newton(cells: DataFrame, state: DataFrame, limit: int) -> DataFrame:
    """One step for every source on the logarithm of the words taken."""
    rows = cells.where("size > 0").join(state.where(~F.col("done") & ~F.col("full") & (F.col("target") > 0)).withColumnRenamed("source", "_s"), cells.source.eqNullSafe(F.col("_s")))
    rate, words = _rate(limit), F.col("size") * F.col("n")
    slope = F.when(rate < limit, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)
    whole = lambda c, name: F.sum(c.cast("decimal(38,6)")).cast("double").alias(name)  # noqa: E731  the same in any order
    sums = rows.groupBy("source").agg(whole(words * rate, "taken"), whole(slope, "slope")).withColumnRenamed("source", "_s")
    off = F.log(F.col("taken") / F.col("target"))
    low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
    step = F.col("tilt") - off * F.col("taken") / F.col("slope")
    within = F.col("slope").isNotNull() & (F.col("slope") > 0) & (low.isNull() | (step > low)) & (high.isNull() | (step < high)) & (F.abs(step - F.col("tilt")) < 50)
    aside = F.when(low.isNull(), F.col("tilt") * 2 - 1).when(high.isNull(), F.col("tilt") * 2 + 1).otherwise((low + high) / 2)
    near = (F.abs(off) < CLOSE) | (F.abs(F.col("taken") - F.col("target")) < HALF_WORD)
    joined = state.join(sums, state.source.eqNullSafe(F.col("_s")), "left")
    met = F.col("taken").isNotNull()
    stay = lambda name, new: F.when(met, new).otherwise(F.col(name)).alias(name)
    return joined.select(
        state.source, "mean", "target", "full",
        stay("tilt", F.when(near, F.col("tilt")).when(within, step).otherwise(aside)),
        stay("low", low), stay("high", high), stay("done", near),
    )


def cell_copies(cells: DataFrame, rates: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source, size, n, copies`` with whole copies for each cell, near the targets."""
    named = rates.withColumnRenamed("source", "_s")
    rated = cells.where("size > 0").join(named, cells.source.eqNullSafe(F.col("_s"))).select(
        cells.source, "size", "n", "target", (F.col("n") * F.when(F.col("target") > 0, _rate(limit)).otherwise(0.0)).alias("want")
    )
    along = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    part = rated.withColumn("rest", F.col("want") - F.floor("want"))
    run = F.sum("rest").over(along)
    extra = F.floor(run + 0.5) - F.floor(run - F.col("rest") + 0.5)
    out = part.withColumn("copies", F.least(F.col("n") * limit, F.floor("want") + extra)).select("source", "size", "n", "target", "copies")
    for _ in range(SETTLINGS):
        out = stored(out, "copies")
        left = out.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("off")).withColumnRenamed("source", "_s")
        rows = out.join(left, out.source.eqNullSafe(F.col("_s")))
        room = F.when(F.col("off") > 0, F.col("n") * limit - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") <= F.abs("off")) & (room > 0)
        best = rows.where(fits).groupBy("source").agg(F.max("size").alias("_size")).withColumnRenamed("source", "_b")
        add = F.least(room, F.floor(F.abs(F.col("off")) / F.col("size"))) * F.signum("off").cast("long")
        hit = F.coalesce(F.col("size") == F.col("_size"), F.lit(False))
        out = rows.join(best, rows.source.eqNullSafe(F.col("_b")), "left").select(
            rows.source, "size", "n", "target", F.when(hit, F.col("copies") + add).otherwise(F.col("copies")).alias("copies")
        )
    return stored(out, "copies").select("source", "size", "n", "copies")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, copies, taken`` for every row of ``docs(doc_id, text, source)``."""
    rows = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")), "sizes"
    )
    cells = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = stored(source_targets(cells.select("source", (F.col("size") * F.col("n")).alias("size")), weights, limit), "targets")
    copies = cell_copies(cells, tilts(cells, targets, limit), limit)
    return _dealt(rows, copies, targets)


def _dealt(rows: DataFrame, copies: DataFrame, targets: DataFrame) -> DataFrame:
    """Copies of a cell over its documents: the same for all, and one more for the first by hash.

    A document's place in its cell is its place in a slice of the hash plus all rows in the
    slices before, so that no cell is sorted as a whole.
    """
    order = F.xxhash64("doc_id", "text_key")
    placed = rows.withColumn("order", order).withColumn("slice", F.pmod(F.shiftrightunsigned(order, 20), F.lit(SLICES)))
    filled = placed.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("m"))
    ahead = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.withColumn("before", F.coalesce(F.sum("m").over(ahead), F.lit(0)))
    plan = starts.join(copies, starts.source.eqNullSafe(copies.source) & (starts["size"] == copies["size"]), "left").select(
        starts.source.alias("_s"),
        starts["size"].alias("_size"),
        starts["slice"].alias("_slice"),
        "before",
        F.coalesce(F.floor(F.col("copies") / F.col("n")), F.lit(0)).alias("each"),
        F.coalesce(F.col("copies") % F.col("n"), F.lit(0)).alias("more"),
    )
    inside = Window.partitionBy("source", "size", "slice").orderBy("order", "doc_id", "text_key")
    ranked = placed.withColumn("place", F.row_number().over(inside))
    same = ranked.source.eqNullSafe(F.col("_s")) & (ranked["size"] == F.col("_size")) & (ranked["slice"] == F.col("_slice"))
    dealt = ranked.join(plan, same).withColumn("copies", (F.col("each") + (F.col("before") + F.col("place") <= F.col("more")).cast("long")).cast("long"))
    goals = targets.withColumnRenamed("source", "_t")
    return dealt.drop("_s").join(goals, dealt.source.eqNullSafe(F.col("_t"))).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The documents that the mix takes, with ``copies``: a row stands for that many in the mix.

    Rows equal in id, text and source become one row with all their copies.  A column
    ``copies`` of the input is replaced.
    """
    found = mixed(docs, weights, limit).where("copies > 0")
    totals = found.groupBy("doc_id", "text_key", "source").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    rest = docs.drop("copies")
    of_id, of_text, of_source, key = free_names(rest, "of_id", "of_text", "of_source", "text_key")
    keys = totals.select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_text), F.col("source").alias(of_source), "copies")
    marked = rest.withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key, "source"])
    same = marked["doc_id"].cast("long").eqNullSafe(F.col(of_id)) & (marked[key] == F.col(of_text)) & marked["source"].eqNullSafe(F.col(of_source))
    return marked.join(keys, same).select(*[marked[f"`{c}`"] for c in rest.columns], "copies")
