from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from corpusflow.llm.common import BROADCAST_ROWS
from corpusflow.llm.decontaminate import contamination, drop_contaminated
from corpusflow.llm.entropy_mix import mix_documents
from corpusflow.llm.outliers import outliers
from corpusflow.llm.secret_scan import redact_secrets
from corpusflow.llm.sentence_spans import remove_repeated_spans
from corpusflow.llm.simhash import drop_near_copies
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, benchmark_hits, docs_frame, prose

ITEM = prose(30, 40)
LONG = prose(33, 700)
SHORT = "Just four odd Words"


def rows():
    body = prose(31, 300)
    words = ITEM.split()
    return [
        *awkward_rows(),
        (60, body + " " + ITEM + " " + body, "en", "a"),
        (61, body + " " + " ".join(words[3:13]).upper().replace(" ", " - ") + " tail", "en", "a"),
        (62, body + " " + " ".join(words[3:12]), "en", "a"),  # nine words are no window
        (63, "x " + SHORT + ", y " + SHORT, "en", "a"),
        (64, "four odd Words", "en", "a"),
        (65, "a a a a a a a a a a a a a", "en", "a"),
    ]


def items(spark, more=()):
    values = [(1, ITEM), (2, SHORT), (3, None), (4, ""), (5, "a a a a a a a a a a a"), (6, SHORT), (6, SHORT), (7, "lone"), *more]
    return values, spark.createDataFrame(values, "item_id long, text string")


def test_contamination_equals_brute_force(spark):
    values, bench = items(spark)
    got = contamination(docs_frame(spark, rows()), bench).collect()
    want = benchmark_hits([(i, t) for i, t, _, _ in rows()], values)
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_contaminated_documents_go(spark):
    _, bench = items(spark)
    docs = docs_frame(spark, rows())
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {60, 61, 63, 65} and {1, 2, 3, 62, 64, None} <= ids


def test_empty_tables(spark):
    _, bench = items(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs_frame(spark, []), bench).count() == 0
    clean = contamination(docs_frame(spark, rows()), none).collect()
    assert len(clean) == len(rows()) and not any(r.contaminated or r.n_hit or r.n_items for r in clean)


def odd_names(spark, rows):
    """Documents with columns of the names that operators might use inside."""
    names = ["_id", "_key", "_source", "_text_key", "text_key", "OF_ID", "of_text", "of_source", "_bad", "_spans", "spans", "copies", "rid", "a.b", "n_words"]
    docs = docs_frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])


@pytest.mark.parametrize("limit", [BROADCAST_ROWS, 1])
def test_large_benchmarks_give_the_same_rows(spark, limit):
    rows = [(i, t) for i, t, _, _ in awkward_rows()] + [(40, " ".join(LONG.split()[400:600])), (41, prose(60, 9_000) + " " + " ".join(LONG.split()[100:117]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, LONG), (2, "one"), (3, "漢字"), (4, prose(3, 60))]
    got = contamination(docs, spark.createDataFrame(items, "item_id long, text string"), limit=limit).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(benchmark_hits(rows, items), key=str)


def test_rows_are_judged_by_their_own_text(spark):
    clean, bad = prose(50, 40), prose(51, 30) + " " + prose(52, 20)
    rows = [(None, clean, "en", "a"), (None, bad, "en", "a"), (5, clean, "en", "b"), (5, bad, None, None), (6, None, "en", "a"), (6, bad, "en", "a"), (None, None, None, None)]
    docs = odd_names(spark, rows)
    out = drop_contaminated(docs, spark.createDataFrame([(1, prose(52, 20))], "item_id long, text string"))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, docs.where(F.col("text").isNull() | (F.col("text") == clean)).collect()), key=str)


def test_other_stages_keep_columns_of_any_name(spark):
    ship_package(spark)
    docs = odd_names(spark, [*awkward_rows(), *[(100 + i, prose(100 + i, 60), "en", "ab"[i % 2]) for i in range(30)]])
    whole = {tuple(r) for r in docs.collect()}
    near = drop_near_copies(docs)
    assert near.columns == docs.columns and {tuple(r) for r in near.collect()} <= whole
    mix = mix_documents(docs)
    assert sorted(mix.columns) == sorted(docs.columns)
    rest = [c for c in docs.columns if c != "copies"]
    quoted = [f"`{c}`" for c in rest]
    assert {tuple(r) for r in mix.select(quoted).collect()} <= {tuple(r) for r in docs.select(quoted).collect()} and mix.count() >= 20
    assert redact_secrets(docs).columns == docs.columns and redact_secrets(docs).count() == docs.count()
    cut = remove_repeated_spans(docs)
    assert cut.columns == [*[c for c in docs.columns if c != "n_words"], "n_sentences", "n_removed", "n_words", "n_words_removed"] and cut.count() == docs.count()
    assert outliers(docs).count() == docs.count()


def test_long_texts_take_time_in_proportion(spark):
    items = spark.createDataFrame([(1, prose(70, 60))], "item_id long, text string")

    def seconds(words):
        docs = spark.createDataFrame([(1, prose(71, 1_000) + " " + " ".join(f"w{i}" for i in range(words)) + " " + prose(70, 60))], "doc_id long, text string")
        begin = time.time()
        assert contamination(docs, items).first().n_hit >= 60
        return time.time() - begin

    seconds(1_000)
    least = seconds(1_000)
    assert seconds(240_000) - least < 5 * max(2.0, seconds(60_000) - least)
