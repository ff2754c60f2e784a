from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.lists import crop_context
from corpusflow.operators import ngram


def make_pages(spark, stream, size, split="train"):
    rows = [(split, i // size, stream[i : i + size]) for i in range(0, len(stream), size)]
    return spark.createDataFrame(rows, "split string, page bigint, ids array<int>").repartition(3)


@pytest.fixture(scope="module")
def stream():
    draw = random.Random(6)
    return [draw.choice([0, 1, 1, 1, 2, 65535]) for _ in range(101)]


def counted(stream, n):
    def pack(ids):
        out = 0
        for i in ids:
            out = out * 65536 + i
        return out

    return Counter((pack(stream[i : i + n - 1]), stream[i + n - 1]) for i in range(len(stream) - n + 1))


@pytest.mark.parametrize("n", [1, 2, 3, 4])
@pytest.mark.parametrize("size", [4, 10, 200])
def test_counts_across_page_borders(spark, stream, n, size):
    table = ngram.fit_ngram(make_pages(spark, stream, size), n)
    assert {(r.ctx, r.id): r.cnt for r in table.collect()} == counted(stream, n)


def test_counts_per_split(spark, stream):
    pages = make_pages(spark, stream, 7).unionByName(make_pages(spark, stream[:20], 7, "val"))
    table = ngram.fit_ngram(pages, 2, by=["split"]).collect()
    assert {(r.ctx, r.id): r.cnt for r in table if r.split == "val"} == counted(stream[:20], 2)
    both = ngram.fit_ngram(pages, 2).collect()
    assert {(r.ctx, r.id): r.cnt for r in both} == counted(stream, 2) + counted(stream[:20], 2)
    with pytest.raises(ValueError):
        ngram.fit_ngram(pages, 5)


TABLE = [(0, 1, 8), (0, 2, 4), (0, 3, 4), (0, 4, 1), (1, 0, 5)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TABLE, "ctx bigint, id int, cnt bigint")


def test_top_k_keeps_ties(table):
    assert {r.id for r in ngram.top_k_ties(table, 2).where("ctx = 0").collect()} == {1, 2, 3}
    assert ngram.top_k_ties(table, 100).count() == len(TABLE)


def test_probabilities(table):
    for temperature in (1.0, 0.5, 0.01, 50.0):
        got = {(r.ctx, r.id): r.p for r in ngram.next_probs(table, temperature).collect()}
        for ctx in (0, 1):
            logits = {i: math.log(c) / temperature for x, i, c in TABLE if x == ctx}
            top = max(logits.values())
            total = sum(math.exp(v - top) for v in logits.values())
            for i, v in logits.items():
                assert got[ctx, i] == pytest.approx(math.exp(v - top) / total, abs=1e-12)
    cut = {r.id: r.p for r in ngram.top_k_probs(table, 2).where("ctx = 0").collect()}
    assert cut == pytest.approx({1: 0.5, 2: 0.25, 3: 0.25})
    with pytest.raises(ValueError):
        ngram.next_probs(table, 0)


def test_draws_follow_the_distribution_and_repeat(spark, table):
    prompts = spark.range(4000).select(F.col("id").alias("key"), F.lit(0).cast("bigint").alias("ctx"))
    drawn = ngram.sample_next(prompts, ngram.next_probs(table), seed=3)
    counts = Counter(r.next for r in drawn.collect())
    for i, c in ((1, 8), (2, 4), (3, 4), (4, 1)):
        assert counts[i] / 4000 == pytest.approx(c / 17, abs=0.03)
    again = ngram.sample_next(prompts.repartition(5), ngram.next_probs(table), seed=3)
    assert sorted(again.collect()) == sorted(drawn.collect())
    unknown = ngram.sample_next(prompts.where("key < 3").withColumn("ctx", F.lit(99).cast("bigint")), ngram.next_probs(table), seed=3)
    assert [r.next for r in unknown.collect()] == [None] * 3


def test_certain_continuation_and_early_end(spark):
    certain = spark.createDataFrame([(0, 1, 3), (1, 2, 3), (2, 0, 3), (0, 5, 1), (7, 8, 1)], "ctx bigint, id int, cnt bigint")
    prompts = spark.createDataFrame([("a", [0]), ("b", [9, 2]), ("c", [7]), ("d", [])], "key string, ids array<int>")
    longer = {r.key: r.ids for r in ngram.continue_prompts(prompts, certain, steps=11, top_k=1, store_every=4).collect()}
    assert longer == {
        "a": [0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1, 2],
        "b": [9, 2, 0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1],
        "c": [7, 8],
        "d": [],
    }


def test_samples_of_one_prompt_differ_and_repeat(spark):
    even = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1)], "ctx bigint, id int, cnt bigint")
    prompts = spark.createDataFrame([("a", [0]), ("b", [1])], "key string, ids array<int>")
    draw = lambda: {(r.key, r.sample): tuple(r.ids) for r in ngram.continue_prompts(prompts, even, steps=12, samples=4).collect()}
    found = draw()
    assert len(found) == 8 and len(set(found.values())) == 8 and draw() == found
    with pytest.raises(ValueError):
        ngram.continue_prompts(prompts, even, steps=1, samples=0)


def test_continuation_with_longer_context(spark, stream):
    table = ngram.fit_ngram(make_pages(spark, stream, 10), 3)
    prompts = spark.createDataFrame([(i, [1, i % 3]) for i in range(12)] + [(99, [1])], "key int, ids array<int>")
    seen = counted(stream, 3)
    for row in ngram.continue_prompts(prompts, table, steps=5, n=3, seed=2).collect():
        if row.key == 99:
            assert row.ids == [1]
        for a, b, c in zip(row.ids, row.ids[1:], row.ids[2:]):
            assert seen[a * 65536 + b, c] > 0


def test_cross_entropy_by_hand(spark, table):
    pairs = spark.createDataFrame(
        [("val", 0, 1, 2), ("val", 0, 9, 1), ("val", 5, 1, 1), ("val", 0, -1, 7), ("train", 1, 0, 4)],
        "split string, ctx bigint, id int, cnt bigint",
    )
    got = {r.split: (r.loss, r.targets) for r in ngram.cross_entropy(pairs, table, vocab_size=10).collect()}
    want = (2 * -math.log(9 / 27) - math.log(1 / 27) - math.log(1 / 10)) / 4
    assert got["val"] == (pytest.approx(want), 4)
    assert got["train"] == (pytest.approx(-math.log(6 / 15)), 4)


def test_crop_context(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(crop_context("ids", 2)).collect()] == [[2, 3], [1], []]


def test_bisection_finds_the_first_choice_above(spark):
    sums = [0.1, 0.1, 0.25, 0.5, 0.5, 0.9, 1.0 - 1e-12]
    rows = [(u / 40, [(i, s) for i, s in enumerate(sums)]) for u in range(40)] + [(0.5, [(7, 0.2)]), (0.1, [])]
    frame = spark.createDataFrame(rows, "u double, choices array<struct<id:int,upto:double>>")
    for row in frame.withColumn("id", ngram.pick(F.col("choices"), F.col("u"))).collect():
        above = [c.id for c in row.choices if c.upto > row.u]
        assert row.id == (above[0] if above else row.choices[-1].id if row.choices else None)


def tuples(stream, n):
    return Counter((tuple(stream[i : i + n - 1]), stream[i + n - 1]) for i in range(len(stream) - n + 1))


def unpacked(ctx, n):
    return tuple(ctx) if isinstance(ctx, list) else tuple(ctx >> 16 * i & 0xFFFF for i in range(n - 2, -1, -1))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9])
@pytest.mark.parametrize("bits", [2, 16])
def test_counts_over_short_and_empty_documents(spark, n, bits):
    draw = random.Random(n)
    docs = {split: [[draw.choice([0, 1, 1, 2, 65535]) for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 5, 30]))] for _ in range(40)] for split in ("train", "val")}
    rows = [(split, 3 * i - 50, ids) for split, lists in docs.items() for i, ids in enumerate(lists)]
    frame = spark.createDataFrame(rows, "split string, doc_id bigint, ids array<int>").repartition(3)
    found = ngram.count_ngrams(frame, n, by=["split"], bits=bits).collect()
    for split, lists in docs.items():
        got = {(unpacked(r.ctx, n), r.id): r.cnt for r in found if r.split == split}
        assert got == tuples([i for ids in lists for i in ids], n)


def test_documents_need_numbers_of_their_own(spark):
    frame = spark.createDataFrame([("train", 1, [1, 2]), ("train", 1, [3])], "split string, doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="not unique"):
        ngram.count_ngrams(frame, 2).collect()
    assert ngram.count_ngrams(frame.where("false"), 6).count() == 0


def test_longer_contexts_continue(spark):
    stream = [1, 2, 3, 4, 5, 6] * 20
    frame = spark.createDataFrame([("train", 0, stream)], "split string, doc_id bigint, ids array<int>")
    table = ngram.count_ngrams(frame, 6)
    prompts = spark.createDataFrame([("a", [9, 9, 1, 2, 3, 4, 5]), ("b", [1, 2]), ("b", [2, 3, 4, 5, 6])], "key string, ids array<int>")
    longer = sorted(r.ids for r in ngram.continue_prompts(prompts, table, steps=4, n=6, store_every=3).collect())
    assert longer == [[1, 2], [2, 3, 4, 5, 6, 1, 2, 3, 4], [9, 9, 1, 2, 3, 4, 5, 6, 1, 2, 3]]


def test_estimated_loss_is_the_mean_of_batch_means(spark):
    table = spark.createDataFrame([(0, 1, 3), (1, 0, 1)], "ctx bigint, id int, cnt bigint")
    blocks = [("val", 0, [0, 1], [1, 0]), ("val", 0, [0, 0], [0, 1]), ("val", 1, [5, 1], [1, 0]), ("train", 0, [0], [1])]
    frame = spark.createDataFrame(blocks, "split string, iter int, x array<int>, y array<int>")
    got = {r.split: (r.iters, r.loss) for r in ngram.estimate_loss(frame, table, 4).collect()}
    p = {(0, 1): 4 / 7, (1, 0): 2 / 5, (0, 0): 1 / 7, (5, 1): 1 / 4}
    first = [p[0, 1], p[1, 0], p[0, 0], p[0, 1]]
    batches = [-sum(map(math.log, first)) / 4, -(math.log(p[5, 1]) + math.log(p[1, 0])) / 2]
    assert got["val"] == (2, pytest.approx(sum(batches) / 2)) and got["train"] == (1, pytest.approx(-math.log(4 / 7)))


@pytest.mark.parametrize("n", [3, 4, 6, 9])
def test_counts_of_many_different_ids(spark, n):
    """Too many ids for a table of counts; from six on, for one number an n-gram too."""
    draw = random.Random(n)
    lists = [[draw.randrange(65536) for _ in range(40)] * 2 for _ in range(100)]
    frame = spark.createDataFrame([("train", i, ids) for i, ids in enumerate(lists)], "split string, doc_id bigint, ids array<int>").repartition(3)
    got = {(unpacked(r.ctx, n), r.id): r.cnt for r in ngram.count_ngrams(frame, n).collect()}
    assert got == tuples([i for ids in lists for i in ids], n)


@pytest.mark.parametrize("n", [2, 6])
@pytest.mark.parametrize("held", [10, 1 << 20])
def test_a_task_adds_up_its_batches(spark, monkeypatch, n, held):
    monkeypatch.setattr(ngram, "HELD_GRAMS", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        ids = list(range(20)) * 2
        frame = spark.createDataFrame([(f"s{i % 2}", ids) for i in range(30)], "split string, ids array<int>").coalesce(1)
        parts = ngram._gram_counts(frame, n, ["split"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.cnt for r in parts) == 30 * (len(ids) - n + 1)
    assert len(parts) == 2 * 20 if held > 10 else len(parts) > 2 * 20
