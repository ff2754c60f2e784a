"""Near copies by 64-bit fingerprints and covering bit masks.

A fingerprint holds, bit by bit, the majority of a text's shingle hashes.  Two texts link
if their fingerprints differ in ``radius`` bits at most.  Candidates come from covering
masks: every bit position carries a non-zero vector of ``radius + 1`` bits, and table ``v``
keeps the positions whose vector has an odd product with ``v``.  ``radius`` differing
positions span at most ``radius`` dimensions, so some non-zero ``v`` is orthogonal to all of
them: every linked pair agrees in at least one of the ``2^(radius+1) - 1`` tables.

Buckets hold distinct fingerprints only.  One that is larger than ``bucket`` is divided
again by a second family of masks over the positions on which its members still may
differ, which covers in the same way; each division about halves these positions, so the
buckets end up small whatever the data.  No pairs leave a bucket, only one link for each
member to the first member of its component there.

Null, empty and wordless texts have fingerprint zero and link like any other.  Repeated
rows and equal texts share a fingerprint.  A row without ``doc_id`` gets the component of
the rows it links to; a component of such rows only has no id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import connected, free_names
from corpusflow.scratch import stored

BITS = 64
SEED = 42
BUCKET = 256
DIVISIONS = 8


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    runs = zip(*(words[i:] for i in range(shingle)), strict=False)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_key, fingerprint`` of every row; ``text_key`` tells different texts of one id apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_key", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, text_key long, fingerprint long")


def covering_masks(radius: int, division: int = 0) -> list[int]:
    """Bit masks, as signed 64-bit numbers, of which one at least misses any ``radius`` positions.

    Each division deals the vectors to the positions in another order.
    """
    count = 2 ** (radius + 1) - 1
    dealt = np.random.default_rng(1_000 + division).permutation(np.arange(BITS) % count) + 1
    masks = []
    for v in range(1, count + 1):
        kept = [i for i in range(BITS) if (int(dealt[i]) & v).bit_count() % 2]
        masks.append(int(np.array(sum(1 << i for i in kept), np.uint64).view(np.int64)))
    return masks


def near_links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints within chains of ``radius`` bits."""
    rows = fps.select("fingerprint", F.lit(0).cast("long").alias("path"))
    links = None
    for division in range(DIVISIONS):
        tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(covering_masks(radius, division))])
        keyed = rows.select("fingerprint", "path", F.explode(tables).alias("x")).select(
            "fingerprint", F.xxhash64("path", "x.t", "x.key").alias("path")
        )
        sizes = keyed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = stored(keyed.join(sizes, "path"), "buckets")
        small = shared if division == DIVISIONS - 1 else shared.where(F.col("n") <= bucket)
        found = small.select("path", "fingerprint").repartition("path").sortWithinPartitions("path", "fingerprint").mapInArrow(_bucket_links(radius), "a long, b long")
        links = found if links is None else links.unionByName(found)
        rows = shared.where(F.col("n") > bucket).select("fingerprint", "path")
        if rows.isEmpty():
            break
    return links.distinct()


def _bucket_links(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, value = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            path = np.concatenate([path, batch.column(0).to_numpy()])
            value = np.concatenate([value, batch.column(1).to_numpy()])
            if len(path):
                whole = int(np.searchsorted(path, path[-1]))  # the last bucket may go on in the next batch
                yield from _linked(path[:whole], value[:whole], radius)
                path, value = path[whole:], value[whole:]
        yield from _linked(path, value, radius)

    return work


def _linked(path: np.ndarray, value: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """One link per member to the first of its component, for whole buckets in order."""
    n = len(path)
    if n < 2:
        return
    last = np.searchsorted(path, path, side="right") - 1
    first, second = [], []
    here, step = np.arange(n), 1
    while True:
        here = here[here + step <= last[here]]
        if not len(here):
            break
        close = here[np.bitwise_count((value[here] ^ value[here + step]).view(np.uint64)) <= radius]
        first.append(close)
        second.append(close + step)
        step += 1
    a, b = np.concatenate(first or [here]), np.concatenate(second or [here])
    lead = np.arange(n)
    while len(a):
        low = np.minimum(lead[a], lead[b])
        before = lead.copy()
        np.minimum.at(lead, a, low)
        np.minimum.at(lead, b, low)
        lead = lead[lead]
        if np.array_equal(before, lead):
            break
    hung = np.flatnonzero(lead != np.arange(n))
    if len(hung):
        yield pa.RecordBatch.from_arrays([pa.array(value[hung]), pa.array(value[lead[hung]])], ["a", "b"])


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, text_key, fingerprint (hex), component_id, root`` for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, ``root`` the
    component's smallest fingerprint.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "nodes")
    roots = connected(near_links(nodes, radius, bucket)).withColumnRenamed("node", "fingerprint")
    rooted = stored(nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.select("fingerprint", "root").join(lowest, "root")
    return rows.join(labels, "fingerprint").select(
        "doc_id",
        "text_key",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
        "root",
    )


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest ``doc_id``, then text key.

    The columns stay.  A row without ``doc_id`` stays only if its whole component has none.
    """
    found = simhash_components(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    of_id, of_text, key = free_names(docs, "of_id", "of_text", "text_key")
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias(of_id), F.col("k.text_key").alias(of_text)).distinct()
    marked = docs.withColumn(key, F.xxhash64("text"))
    rest = marked.join(kept, marked["doc_id"].eqNullSafe(kept[of_id]) & (marked[key] == kept[of_text]), "left_semi")
    return rest.dropDuplicates(["doc_id", key]).select(*[f"`{c}`" for c in docs.columns])
