from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from corpusflow.functions.subword import byte_ranks
from corpusflow.operators.encode import SubwordEncoder
from corpusflow.streaming.run_metrics import RunMetricsSink, read_stream_metrics, stream_run_metrics
from corpusflow.streaming.tokenize import stream_tokenize

SCHEMA = "run_id bigint, ts timestamp, event_id bigint, loss double"
START = dt.datetime(2024, 1, 1)


def events(n, seed=8):
    draw = random.Random(seed)
    return [(draw.choice([1, 1, 1, 2]), START + dt.timedelta(seconds=i // 2), i, draw.random()) for i in range(n)]


def feed(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    stream_run_metrics(stream, str(tmp_path / "out")).awaitTermination()


def check(spark, tmp_path, rows):
    got = read_stream_metrics(spark, str(tmp_path / "out")).toPandas().sort_values(["run_id", "iter"])
    want = pd.DataFrame(rows, columns=["run_id", "ts", "event_id", "loss"]).sort_values(["run_id", "ts", "event_id"])
    grouped = want.groupby("run_id")
    assert got["event_id"].tolist() == want["event_id"].tolist()
    assert got["iter"].tolist() == grouped.cumcount().tolist()
    assert got["ema"].tolist() == pytest.approx(grouped["loss"].transform(lambda s: s.ewm(alpha=0.1, adjust=False).mean()).tolist())
    seconds = grouped["ts"].diff().dt.total_seconds()
    assert got["dt"].fillna(-1).tolist() == seconds.fillna(-1).tolist()


def test_batches_continue_each_other_and_late_rows_are_set_aside(spark, tmp_path):
    rows = events(60)
    feed(spark, tmp_path, rows[:25])
    feed(spark, tmp_path, rows[25:40])
    late = [(1, START, 1000, 5.0), (1, START + dt.timedelta(seconds=1), 1001, 5.0)]
    new_run = [(3, START, 2000, 0.5)]
    feed(spark, tmp_path, rows[40:] + late + new_run)
    check(spark, tmp_path, rows + new_run)
    assert {r.event_id for r in spark.read.parquet(str(tmp_path / "out" / "late")).collect()} == {1000, 1001}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = events(40)
    sink = RunMetricsSink(str(tmp_path / "out"))
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:20], rows[20:]))
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)
    check(spark, tmp_path, rows)


def test_tokenize_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(i, "text é" * i) for i in range(20)], "doc_id bigint, text string")
    docs.repartition(4).write.parquet(str(tmp_path / "in"))
    encoder = SubwordEncoder(byte_ranks())
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_tokenize(stream, encoder, str(tmp_path / "out")).awaitTermination()
    got = {r.doc_id: r.ids for r in spark.read.parquet(str(tmp_path / "out" / "tokens")).collect()}
    assert got == {r.doc_id: r.ids for r in encoder.encode(docs).collect()}
