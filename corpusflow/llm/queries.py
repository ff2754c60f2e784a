"""The queries of these operators: one per operator, over whole tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import oracles
from corpusflow.llm.common import let, space_words
from corpusflow.llm.conversation_repair import conversation_report, damaged, repair_conversations
from corpusflow.llm.decontaminate import contamination
from corpusflow.llm.entropy_mix import mixed
from corpusflow.llm.language_svm import identify, train_languages
from corpusflow.llm.outliers import outliers
from corpusflow.llm.periodic_runs import periodic_runs, planted, run_digests
from corpusflow.llm.quality_trees import score_quality, train_quality
from corpusflow.llm.secret_scan import scan_secrets
from corpusflow.llm.sentence_spans import remove_repeated_spans
from corpusflow.llm.simhash import simhash_components
from corpusflow.llm.toxicity import score_toxicity, train_toxicity
from corpusflow.llm.url_filter import GRID, judge_urls
from corpusflow.llm.warc_chain import page_records, read_archive, write_archive
from corpusflow.plans.registry import Query
from corpusflow.scratch import scratch_path
from corpusflow.ship import ship_package
from corpusflow.sources.tables import read_table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return fn


def fold(modulus: int) -> Column:
    """Remainder that decides which documents are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@query
def op1_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers(read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))


@query
def op2_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated_spans(read_table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return found.select("doc_id", "n_sentences", "n_removed", "n_words", "n_words_removed", F.sha2(text, 256).alias("kept_sha256"))


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(read_table(spark, folder, "documents").select("doc_id", "text"), shingle=3, radius=3)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return contamination(docs, read_table(spark, folder, "benchmark").select("item_id", "text"))


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(read_table(spark, folder, "documents").select("doc_id", "text"))


@query
def op6_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "quality")
    forest = train_quality(docs, labels.where(fold(5) != 0))
    return score_quality(docs, forest, ["doc_id"]).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_language_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = train_languages(docs.where(fold(4) != 2).select("text", "lang"))
    return identify(docs, model, ["doc_id"]).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op8_warc_chain(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(read_table(spark, folder, "pages").select("page_id", "url", "html"), path, least_bytes=0)
    return page_records(read_archive(spark, path, whole=True))


@query
def op9_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(read_table(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic")
    model = train_toxicity(docs, labels.where(fold(4) != 2))
    found = score_toxicity(docs, model, ["doc_id"])
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted", "n_hits")


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    words = let(space_words(F.col("text")), lambda w: F.array_join(planted(w, F.col("doc_id")), " "))
    return run_digests(periodic_runs(docs.select("doc_id", words.alias("text"))))


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = judge_urls(read_table(spark, folder, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict", (F.col("score") * GRID).cast("long").alias("score_steps"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    summary, _ = repair_conversations(damaged(rows))
    return conversation_report(rows, summary)
