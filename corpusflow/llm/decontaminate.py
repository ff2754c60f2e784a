"""Benchmark passages in documents, by a prefix-filtered join of shingles.

An item is cut into windows of ``window`` words (an item of fewer is one window), a window
into shingles of ``shingle`` words.  A document holds a window only if it holds all of its
shingles, so one of them is enough to look for: the rarest in the corpus.  That is the
prefix which a containment of one leaves.  A hit on it fixes where the window would start;
the window must lie inside the text, and its words are then compared exactly.

One pass over the corpus keeps the positions at which any benchmark shingle occurs, with
the words around; frequencies, candidates and comparisons come from these rows alone.
Every document also keeps one row that carries its length.

Only DataFrame functions are used.  Null and wordless texts have no words, no hits and are
clean.  An item without words has no window; one without ``item_id`` marks words but cannot
be listed.  Repeated documents are judged row by row, repeated items count once.  An empty
benchmark leaves every document clean.  Very long texts are cut into pieces of ``PIECE`` words
with the words around, so the work is proportional to their length.  Columns beside those
named may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import BROADCAST_ROWS, free_names, plain_words, sent_whole
from corpusflow.scratch import stored

WINDOW = 10
SHINGLE = 5
PIECE = 64


def _runs(words: Column, size: int) -> Column:
    """``(q, pos, h)`` of every run of ``size`` words, positions from 1."""
    each = lambda i: F.struct(F.lit(size).alias("q"), i.alias("pos"), F.xxhash64(F.slice(words, i, F.lit(size))).alias("h"))
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), each)).otherwise(
        F.array().cast("array<struct<q:int,pos:int,h:bigint>>")
    )


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, words, len`` for every window of every item."""
    rows = items.select(F.col("item_id"), plain_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.lit(window), F.size("w"))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("i")
    return rows.select("item_id", "w", length.alias("len"), starts).select("item_id", F.array_join(F.slice("w", F.col("i"), F.col("len")), " ").alias("words"), "len").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs(doc_id, text)``.

    Up to ``limit`` shingles of the benchmark are sent to the texts; beyond it hashes and
    positions of the corpus are shuffled to them, and the words around fetched for matches.
    """
    return judged(docs, items, window, shingle, limit).drop("text_key")


def judged(docs: DataFrame, items: DataFrame, window: int, shingle: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of :func:`contamination` with ``text_key``, a hash of the text."""
    windows = stored(benchmark_windows(items, window), "windows")
    texts = windows.select("words", "len").distinct()
    sizes = [r.q for r in texts.select(F.least("len", F.lit(shingle)).alias("q")).distinct().collect()]
    parts = texts.withColumn("w", F.split("words", " "))
    runs = None
    for q in sizes:  # at most ``shingle`` different sizes
        own = parts.where(F.least("len", F.lit(shingle)) == q).select("words", "len", F.explode(_runs(F.col("w"), q)).alias("x")).select("words", "len", "x.q", "x.pos", "x.h")
        runs = own if runs is None else runs.unionByName(own)
    length_row = docs.sparkSession.range(1).select(F.lit(0).alias("q"), F.lit(0).cast("long").alias("h"))
    if runs is None:
        wanted = length_row
    else:
        runs = stored(runs, "runs")
        wanted = runs.select("q", "h").distinct().unionByName(length_row)
    hits = stored(_hits(docs, stored(wanted, "wanted"), sizes, window, limit), "hits")
    lengths = hits.where("q = 0").select("rid", "doc_id", "text_key", F.col("pos").cast("long").alias("n_words"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    if runs is None:
        zero = F.lit(0).cast("long")
        return lengths.select("doc_id", "text_key", "n_words", zero.alias("n_hit"), zero.alias("n_items"), nothing.alias("items_sha256"), F.lit(False).alias("contaminated"))
    found = stored(_occurrences(hits, runs), "occurrences")
    covered = found.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")).select("rid", _covered(F.col("spans")).alias("n_hit"))
    listed = found.select("rid", "words").distinct().join(windows.select("words", F.col("item_id").cast("string").alias("item")), "words")
    listed = listed.groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("ids"))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return lengths.join(covered, "rid", "left").join(listed, "rid", "left").select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _pieces(docs: DataFrame, reach: int, window: int) -> DataFrame:
    """``rid, doc_id, text_key, n, first, begin, w``: the words of every text, ``PIECE`` places at a time.

    ``first`` is the piece's first place; ``w`` holds the words from ``begin`` on that a
    window around any of its places can take.
    """
    words = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.xxhash64("text").alias("text_key"), plain_words(F.col("text")).alias("all"))
    count = F.greatest(F.lit(1), F.ceil(F.size("all") / PIECE).cast("int"))

    def piece(k: Column) -> Column:
        first = k * PIECE + 1
        begin = F.greatest(F.lit(1), first - reach)
        return F.struct(first.alias("first"), begin.alias("begin"), F.slice("all", begin, first - begin + PIECE + window).alias("w"))

    pieces = F.transform(F.sequence(F.lit(0), count - 1), piece)
    return words.select("rid", "doc_id", "text_key", F.size("all").alias("n"), F.explode(pieces).alias("p")).select("rid", "doc_id", "text_key", "n", "p.*")


def _hits(docs: DataFrame, wanted: DataFrame, sizes: list[int], window: int, limit: int) -> DataFrame:
    """Where any wanted shingle occurs, with the words a window around it could take."""
    reach = window - min(sizes, default=0)
    pieces = _pieces(docs, reach, window)
    inside = F.struct(F.lit(0).alias("q"), F.col("n").alias("pos"), F.lit(0).cast("long").alias("h"))
    places = F.when(F.col("first") == 1, F.array(inside)).otherwise(F.array().cast("array<struct<q:int,pos:int,h:bigint>>"))

    def runs(q: int) -> Column:
        each = lambda pos: F.struct(F.lit(q).alias("q"), pos.alias("pos"), F.xxhash64(F.slice("w", pos - F.col("begin") + 1, F.lit(q))).alias("h"))
        last = F.least(F.col("first") + (PIECE - 1), F.col("n") - (q - 1))
        return F.when(last >= F.col("first"), F.transform(F.sequence(F.col("first"), last), each)).otherwise(F.array().cast("array<struct<q:int,pos:int,h:bigint>>"))

    found = F.explode(F.concat(places, *[runs(q) for q in sizes])).alias("x")
    sent = sent_whole(wanted, limit)
    if sent is not wanted:
        rows = pieces.select("rid", "doc_id", "text_key", "n", "begin", "w", found).select("*", "x.q", "x.pos", "x.h").join(sent, ["q", "h"])
    else:
        pieces = stored(pieces, "pieces")
        matched = pieces.select("rid", "first", found).select("rid", "first", "x.q", "x.pos", "x.h").join(wanted, ["q", "h"])
        rows = matched.join(pieces, ["rid", "first"])
    start = F.greatest(F.lit(1), F.col("pos") - reach)
    around = F.when(F.col("q") > 0, F.array_join(F.slice("w", start - F.col("begin") + 1, F.col("pos") + window - start), " "))
    return rows.select("rid", "doc_id", "text_key", "q", "pos", "h", start.alias("begin"), around.alias("around"), "n")


def _occurrences(hits: DataFrame, runs: DataFrame) -> DataFrame:
    """``rid, words, start, end`` of every window that occurs."""
    matched = hits.where("q > 0")
    counts = matched.groupBy("q", "h").agg(F.count(F.lit(1)).alias("df"))
    # windows of which some shingle never occurs are out; of the rest the rarest shingle is the prefix
    ranked = runs.join(counts, ["q", "h"], "left").groupBy("words", "len").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "q", "pos")).alias("p")
    )
    prefix = ranked.where("p.df > 0").select("words", "len", "p.q", "p.h", F.col("p.pos").alias("at"))
    start = F.col("pos") - F.col("at") + 1
    inside = (start >= 1) & (start + F.col("len") - 1 <= F.col("n")) & (start >= F.col("begin"))
    piece = F.array_join(F.slice(F.split("around", " "), start - F.col("begin") + 1, F.col("len")), " ")
    rows = matched.join(prefix, ["q", "h"]).where(inside).where(piece == F.col("words"))
    return rows.select("rid", "words", start.alias("start"), (start + F.col("len") - 1).alias("end"))


def _covered(spans: Column) -> Column:
    """Number of positions in the union of sorted spans."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("last"))
    add = lambda s, x: F.struct(
        (s.n + F.greatest(F.lit(0), x.end - F.greatest(s.last, x.start - 1))).cast("long").alias("n"), F.greatest(s.last, x.end).alias("last")
    )
    return F.aggregate(spans, first, add, lambda s: s.n)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; the columns stay.

    Rows go one by one, by their own text: others of the same id, or without id, stay.
    """
    found = judged(docs.select("doc_id", "text"), items, window, shingle)
    of_id, of_text, key = free_names(docs, "of_id", "of_text", "text_key")
    bad = stored(found.where("contaminated").select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_text)).distinct(), "contaminated")
    marked = docs.withColumn(key, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(bad[of_id]) & (marked[key] == bad[of_text])
    return marked.join(sent_whole(bad), same, "left_anti").select(*[f"`{c}`" for c in docs.columns])
