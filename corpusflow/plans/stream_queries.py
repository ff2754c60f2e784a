"""Queries that run as streams over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.functions.chars import collect_vocab
from corpusflow.operators.encode import CharEncoder
from corpusflow.operators.pages import token_totals
from corpusflow.operators.vocab import build_vocab
from corpusflow.plans.registry import query
from corpusflow.plans.runlog_queries import LOG, _EMA
from corpusflow.scratch import scratch_path
from corpusflow.sources.tables import read_table
from corpusflow.streaming.run_metrics import read_stream_metrics, stream_run_metrics
from corpusflow.streaming.tokenize import stream_tokenize


@query(f"""
    WITH {LOG}
    SELECT run_id, iter, event_id, round(dt, 6) AS dt, {_EMA.format('loss * pi()')} AS ema FROM timed
""")
def stream_ema(spark: SparkSession, folder: str) -> DataFrame:
    """Three thirds of the log arrive one after the other; the stream is stopped and resumed in between."""
    events = read_table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("value") * F.pi()).alias("loss")
    )
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "run-metrics")
    at = F.unix_micros("ts")
    for part in range(3):
        first, last = low + (high - low) * part // 3, low + (high - low) * (part + 1) // 3
        arriving = events.where((at >= first) & ((at < last) if part < 2 else (at <= high)))
        arriving.write.mode("append").parquet(inbox)
        stream_run_metrics(spark.readStream.schema(events.schema).parquet(inbox), out).awaitTermination()
    return read_stream_metrics(spark, out).select(
        "run_id", "iter", "event_id", F.round("dt", 6).alias("dt"), F.round("ema", 6).alias("ema")
    )


@query("SELECT lang AS split, CAST(sum(length(text)) AS BIGINT) AS tokens FROM documents GROUP BY lang")
def stream_token_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Documents encoded as a stream; totals of the tokens written."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("split"))
    encoder, out = CharEncoder(collect_vocab(build_vocab(docs))), scratch_path(spark, "stream-tokens")
    # as a pattern, because a stream takes a folder or a pattern but no single file
    source = f"{folder.rstrip('/')}/documents[.]parquet"
    arriving = spark.readStream.schema(read_table(spark, folder, "documents").schema).parquet(source)
    stream_tokenize(arriving.select("doc_id", "text", F.col("lang").alias("split")), encoder, out).awaitTermination()
    return token_totals(spark.read.parquet(f"{out}/tokens"), F.size("ids"))
