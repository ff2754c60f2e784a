"""Robust multivariate outliers among text statistics.

Statistics of a text are brought to scales on which clean texts look normal.  For every
language and source, the minimum covariance determinant looks for the ``SHARE`` of the
vectors with the tightest covariance: concentration steps start from the coordinate-wise
median and from the plain mean, each step takes the vectors nearest to the last estimate,
and the start with the smaller determinant wins.  Vectors whose squared Mahalanobis distance
exceeds the chi-square quantile ``QUANTILE`` are rejected.

A group below ``LEAST`` texts takes the estimate of its language, a language below that the
one of the corpus; where even that is too small nothing is rejected by distance.  Every
variance has a floor, so that a statistic which is constant in a group rejects nobody for
a trifle.

Vectors are whole numbers of 1/1024, their sums exact, and the share of nearest vectors is
cut at a step of a fixed scale of distances, ties included: the estimates are the same
under any partitioning, and no group is ever sorted.

Only DataFrame functions are used.  Null texts have no words and fail the base rules; null
languages and sources are groups of their own.  Repeated rows count as often as they occur.
Very long texts are counted whole.  Columns beside the four that are read may have any names.
An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import let, sent_whole, space_words
from corpusflow.scratch import stored

GRID = 1024
SHARE = 0.75
STEPS = 4
QUANTILE = 1 - 1e-9
LEAST = 100
BINS = 64
LEVELS = 3

#: Smallest standard deviation of each transformed statistic.
FLOORS = {"length": 0.5, "word_length": 0.08, "symbols": 0.06, "dup_lines": 0.08, "repeats": 0.15}
NAMES = list(FLOORS)
P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def repeated_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.struct(F.xxhash64(F.slice(words, i, F.lit(3))).alias("h"), i.alias("i")))

    def places(s: Column) -> Column:
        twice = lambda k: F.coalesce(F.get(s, k - 1)["h"] == s[k]["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == s[k]["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice), lambda k: s[k]["i"]))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    add = lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a["last"])).cast("long").alias("n"), i.alias("last"))
    covered = F.aggregate(let(F.sort_array(windows), places), start, add, lambda a: a.n)
    return F.when(F.size(words) >= 4, covered).otherwise(F.lit(0).cast("long"))


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")
    )
    rows = docs.select(
        *keep,
        let(space_words(text), counts).alias("c"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    rows = rows.select(*keep, "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    """Transformed statistics in whole numbers of 1/GRID."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "length": F.log(words),
        "word_length": F.log1p(F.col("word_chars") / words),
        "symbols": F.sqrt(F.col("n_symbols") / words),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / words),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }
    return [F.round(values[name] * GRID).cast("long").alias(f"q{i}") for i, name in enumerate(NAMES)]


def chi_square_cdf(x: float, k: int) -> float:
    """Chi-square distribution, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 2_000):
        term *= z / (a + n)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, k) < p else (low, middle)
    return (low + high) / 2


def consistency(share: float, k: int) -> float:
    """Factor that makes the covariance of the nearest ``share`` of normal vectors whole."""
    return share / chi_square_cdf(chi_square_quantile(share, k), k + 2) if share < 1 else 1.0


def _inverted(groups: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n, m*, i*_*, logdet`` from means ``m*`` and covariances ``s*_*``, floors added.

    Cholesky factor, its inverse, and the inverse of the covariance, column by column.
    """
    out = groups
    for i, j in PAIRS:
        floor = (FLOORS[NAMES[i]] * GRID) ** 2 if i == j else 0.0
        value = F.col(f"s{i}_{j}") + floor
        for k in range(j):
            value = value - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l{j}_{j}"))
    for j in range(P):
        out = out.withColumn(f"v{j}_{j}", 1 / F.col(f"l{j}_{j}"))
        for i in range(j + 1, P):
            value = F.col(f"l{i}_{j}") * F.col(f"v{j}_{j}")
            for k in range(j + 1, i):
                value = value + F.col(f"l{i}_{k}") * F.col(f"v{k}_{j}")
            out = out.withColumn(f"v{i}_{j}", -value / F.col(f"l{i}_{i}"))
    inverse = [sum((F.col(f"v{k}_{i}") * F.col(f"v{k}_{j}") for k in range(i, P)), F.lit(0.0)).alias(f"i{i}_{j}") for i, j in PAIRS]
    logdet = sum((F.log(F.col(f"l{i}_{i}")) for i in range(P)), F.lit(0.0)).alias("logdet")
    return out.select(*keys, "n", *[f"m{i}" for i in range(P)], *inverse, logdet)


def _moments(rows: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """``keys, n, m*, s*_*``: exact sums, covariances multiplied by ``scale``."""
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[exact(F.col(f"q{i}")).cast("double").alias(f"a{i}") for i in range(P)],
        *[exact(F.col(f"q{i}") * F.col(f"q{j}")).cast("double").alias(f"b{i}_{j}") for i, j in PAIRS],
    )
    means = [(F.col(f"a{i}") / F.col("n")).alias(f"m{i}") for i in range(P)]
    spreads = [((F.col(f"b{i}_{j}") - F.col(f"a{i}") * F.col(f"a{j}") / F.col("n")) / F.col("n") * scale).alias(f"s{i}_{j}") for i, j in PAIRS]
    return sums.select(*keys, "n", *means, *spreads)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of ``q*`` from ``m*`` under ``i*_*``."""
    off = [F.col(f"q{i}") - F.col(f"m{i}") for i in range(P)]
    return sum((F.col(f"i{i}_{j}") * off[i] * off[j] * (1.0 if i == j else 2.0) for i, j in PAIRS), F.lit(0.0))


def robust_estimates(vectors: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """``g, n, m*, i*_*`` for every group of ``vectors(g, q*)``; ``n`` is the group's size."""
    sizes = stored(vectors.groupBy("g").agg(F.count(F.lit(1)).alias("size"), *[F.percentile(f"q{i}", [0.25, 0.5, 0.75]).alias(f"p{i}") for i in range(P)]), "sizes")
    middle = sizes.select(
        "g",
        F.lit(0).alias("start"),
        F.col("size").alias("n"),
        *[F.col(f"p{i}")[1].alias(f"m{i}") for i in range(P)],
        *[(F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, 2.0) if i == j else F.lit(0.0)).alias(f"s{i}_{j}") for i, j in PAIRS],
    )
    plain = _moments(vectors, ["g"], 1.0).withColumn("start", F.lit(1))
    now = stored(_inverted(middle.unionByName(plain), ["g", "start"]), "estimates")
    for _ in range(steps):
        # a row for each group and start: rows meet it where they are and are counted before they travel
        near = vectors.join(sent_whole(now.drop("n")), "g").withColumn("bin", F.floor(F.log1p(squared_distance()) * BINS).cast("int"))
        along = Window.partitionBy("g", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = near.groupBy("g", "start", "bin").agg(F.count(F.lit(1)).alias("k")).withColumn("run", F.sum("k").over(along))
        cut = bins.join(sent_whole(sizes.select("g", "size")), "g").where(F.col("run") >= F.ceil(F.col("size") * share)).groupBy("g", "start").agg(F.min("bin").alias("cut"))
        core = near.join(sent_whole(stored(cut, "cut")), ["g", "start"]).where("bin <= cut")
        now = stored(_inverted(_moments(core, ["g", "start"], consistency(share, P)), ["g", "start"]), "estimates")
    tightest = now.groupBy("g").agg(F.min(F.struct("logdet", "start")).alias("best")).select("g", F.col("best.start").alias("start"))
    return now.join(tightest, ["g", "start"]).drop("start", "logdet", "n").join(sizes.select("g", F.col("size").alias("n")), "g")


def outliers(docs: DataFrame, share: float = SHARE, quantile: float = QUANTILE, least: int = LEAST) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``kept`` and ``distance`` for every row of ``docs(doc_id, text, lang, source)``.

    ``distance`` is the squared Mahalanobis distance, null where no estimate applies.
    """
    group = lambda level, *names: F.to_json(F.struct(F.lit(level).alias("level"), *names))
    rows = text_statistics(docs, ["doc_id", "lang", "source"])
    rows = stored(rows.select("*", *_vector(), group(0, "lang", "source").alias("g0"), group(1, "lang").alias("g1"), group(2).alias("g2")), "statistics")
    q = [f"q{i}" for i in range(P)]
    sound = rows.where(~F.col("base_failed"))
    # a whole group has few different small numbers next to its rows; equal vectors stay separate rows
    vectors = sound.select(F.explode(F.array("g0", "g1", "g2")).alias("g"), *q)
    found = stored(robust_estimates(vectors, share).where(F.col("n") >= least), "found")
    chosen = rows.select("g0", "g1", "g2").distinct()
    for level in range(LEVELS):
        known = found.select(F.col("g").alias(f"g{level}"), F.lit(True).alias(f"k{level}"))
        chosen = chosen.join(known, f"g{level}", "left")
    pick = F.when(F.col("k0"), F.col("g0")).when(F.col("k1"), F.col("g1")).when(F.col("k2"), F.col("g2"))
    chosen = stored(chosen.select("g0", pick.alias("g")).where("g IS NOT NULL").join(found.drop("n"), "g").drop("g"), "chosen")
    limit = chi_square_quantile(quantile, P)
    judged = rows.join(sent_whole(chosen), "g0", "left").withColumn("distance", squared_distance())
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))).alias("kept"),
        "distance",
    )
