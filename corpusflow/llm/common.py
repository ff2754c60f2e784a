"""Column helpers and small plans that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_WORD_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Rows up to which a key table is sent to every executor; a larger one is shuffled instead.
BROADCAST_ROWS = 500_000


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores added where ``df`` has a column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered_columns(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0, c1, …``: functions over Arrow batches do not take names with dots."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of one byte a character take the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces between runs of separators; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def space_words(text: Column) -> Column:
    return split_words(text, SPACE_RUN)


def plain_words(text: Column) -> Column:
    """Runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII."""
    return split_words(lower_ascii(text), NON_WORD_RUN)


def sent_whole(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The table marked for broadcast if it has ``limit`` rows at most; otherwise as it is.

    The rows of a join are the same either way.  Give it a stored table, as it is counted.
    """
    return F.broadcast(table) if len(table.select(F.lit(1)).head(limit + 1)) <= limit else table


def connected(links: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the component's smallest node.

    Alternating large and small stars: each round hangs a node's larger neighbours, then
    its smaller ones, on the smallest neighbour.  Minima are formed by partial aggregation
    and joined back, so that a node with very many neighbours is split like any skewed join.
    Only two numbers per round reach the driver.
    """
    edges = stored(_turned(links).distinct(), "links")
    before = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle within {rounds} rounds")


def _turned(links: DataFrame) -> DataFrame:
    """Links from the larger node ``a`` to the smaller ``b``; loops go."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = _turned(edges)
    lowest = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _turned(hung.unionByName(lowest.select("a", F.col("m").alias("b")))).distinct()
