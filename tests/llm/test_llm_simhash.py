from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm.common import connected
from corpusflow.llm.simhash import covering_masks, drop_near_copies, near_links, simhash_components
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, docs_frame, fingerprint, near_pairs, prose, roots


def test_masks_cover_every_pair_of_the_radius():
    rng = np.random.default_rng(5)
    for division in range(3):
        masks = [m & (2**64 - 1) for m in covering_masks(3, division)]
        assert len(masks) == 15 and all(20 < m.bit_count() < 45 for m in masks)
        for _ in range(2_000):
            differing = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(not m & differing for m in masks)


@pytest.mark.parametrize("bucket", [4, 256])
def test_links_are_complete_with_buckets_divided(spark, bucket):
    ship_package(spark)
    rng = np.random.default_rng(7)
    values = {int(v) for v in rng.integers(-(2**63), 2**63 - 1, 60)}
    middle = int(rng.integers(0, 2**62))
    while len(values) < 360:  # one dense cloud, every point up to nine bits from its middle
        values.add(middle ^ sum(1 << int(b) for b in rng.choice(60, int(rng.integers(0, 10)), replace=False)))
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {r.node: r.root for r in connected(near_links(frame, 3, bucket)).collect()}
    want = roots(len(values), near_pairs([v & (2**64 - 1) for v in values]))
    assert [found.get(v, v) for v in values] == [values[r] for r in want]


def test_chains_settle_on_the_smallest_node(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_components_equal_brute_force_on_awkward_rows(spark):
    ship_package(spark)
    rows = awkward_rows()
    base = prose(20, 400).split()
    for k in range(12):  # near copies with a few words changed
        near = list(base)
        for p in range(k):
            near[37 * p % 400] = f"x{k}y{p}"
        rows.append((50 + k, " ".join(near), "en", "a"))
    got = simhash_components(docs_frame(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    prints = [fingerprint(t) for _, t, _, _ in rows]
    root = roots(len(rows), near_pairs(prints))
    smallest = {}
    for (i, *_), r in zip(rows, root, strict=True):
        smallest[r] = min(x for x in (smallest.get(r), i) if x is not None) if i is not None or smallest.get(r) is not None else None
    want = sorted(((i, f"{p:016x}", smallest[r]) for (i, *_), p, r in zip(rows, prints, root, strict=True)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_one_row_of_each_group_stays(spark):
    ship_package(spark)
    docs = docs_frame(spark, awkward_rows())
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    groups = simhash_components(docs).select("root").distinct().count()
    assert kept.count() == groups
    ids = [r.doc_id for r in kept.where(F.col("text") == awkward_rows()[0][1]).collect()]
    assert ids == [1]


def test_an_empty_table_has_no_rows(spark):
    ship_package(spark)
    assert simhash_components(docs_frame(spark, [])).count() == 0
    assert drop_near_copies(docs_frame(spark, [])).count() == 0
