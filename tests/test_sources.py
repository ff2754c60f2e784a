from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.subword import byte_ranks
from corpusflow.operators.vocab import build_vocab, oov_chars, oov_rows, token_long
from corpusflow.scratch import checkpoint_root, qualified, scratch_path, stored
from corpusflow.sinks.tables import write_vocab
from corpusflow.sources.dataset import read_dataset, read_encoder, read_vocab
from corpusflow.sources.tables import spread
from corpusflow.sources.text import read_text_corpus, read_text_lines, sum_first_field


def test_text_files_are_rows_with_unix_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("x\r\ny\rz\n\n😀".encode())
    (tmp_path / "b.txt").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: r.text for r in read_text_corpus(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == "x\ny\nz\n\n😀"
    assert got.get("b.txt", "") == ""


def test_first_field_sums(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1.5 name\n  2\tother\n\n-1\n")
    (tmp_path / "b.txt").write_text("10")
    got = {r.file.rsplit("/", 1)[1]: r.total for r in sum_first_field(spark, str(tmp_path / "*.txt")).collect()}
    assert got == {"a.txt": 2.5, "b.txt": 10.0}


def test_dataset_layouts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    rows.withColumn("split", F.when(F.col("id") == 1, "train").otherwise("val")).write.partitionBy("split").parquet(str(tmp_path / "folders"))
    got = {(r.split, r.text) for r in read_dataset(spark, "folders", str(tmp_path)).collect()}
    assert got == {("train", "a"), ("val", "b")}

    (tmp_path / "files").mkdir()
    for name in ("train-00000-of-00002", "train-00001-of-00002", "test"):
        (tmp_path / "files" / f"{name}.json").write_text('{"text": "%s"}\n' % name)
    got = {(r.split, r.text) for r in read_dataset(spark, "files", str(tmp_path), "json", "text string").collect()}
    assert got == {("train", "train-00000-of-00002"), ("train", "train-00001-of-00002"), ("test", "test")}

    (tmp_path / "one.csv").write_text("hello\n")
    assert tuple(read_dataset(spark, "one", str(tmp_path), "csv", "text string").first()) == ("train", "hello")


def test_stored_vocabulary_decides_the_encoder(spark, tmp_path):
    path = str(tmp_path / "vocab")
    df = spark.createDataFrame([(1, "cab")], "doc_id int, text string")
    assert read_vocab(spark, path) is None
    with pytest.raises(ValueError):
        read_encoder(spark, path)
    assert read_encoder(spark, path, byte_ranks()).encode(df).first().ids == [99, 97, 98, 256]
    write_vocab(build_vocab(df), path)
    assert read_encoder(spark, path, byte_ranks()).encode(df).first().ids == [2, 0, 1]


def test_scratch(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark).rstrip("/"))
    assert stored(spark.range(5), "five").count() == 5
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 10, 1, 64), "id").rdd.getNumPartitions() == 64


def test_lines_of_cut_files_are_the_whole_text(spark, tmp_path):
    long = "aé漢😀 " * 3_000
    files = {"a": f"x\r\ny\rz\n{long}\n\nend", "b": f"{long}\n{long}\n", "c": "one", "d": "\n", "e": "\r\n" * 2_000, "f": "q\r"}
    for name, text in files.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = read_text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 50
        rows = sorted(lines.collect(), key=lambda r: r.place)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = {r.path: r.text for r in read_text_corpus(spark, str(tmp_path)).collect()}
    assert len(whole) == len(files)
    for path, text in whole.items():
        assert "".join(r.text for r in rows if r.path == path) == text


def test_vocabularies_with_odd_rows_are_joined_once(spark):
    docs = spark.createDataFrame([(1, "abé"), (2, None), (3, ""), (4, "zz")], "doc_id bigint, text string")
    assert [r.ch for r in build_vocab(docs).orderBy("id").collect()] == ["a", "b", "z", "é"]
    odd = spark.createDataFrame([(0, "a"), (0, "a"), (1, "bé"), (2, None), (3, "é")], "id int, ch string")
    assert {(r.ch, r.cnt) for r in oov_chars(docs, odd).collect()} == {("b", 1), ("z", 2)}
    assert {(r.doc_id, tuple(r.chars)) for r in oov_rows(docs, odd).collect()} == {(1, ("b",)), (4, ("z",))}
    assert sorted((r.doc_id, r.pos, r.id) for r in token_long(docs, odd).collect()) == [(1, 0, 0), (1, 2, 3)]


def test_paths_without_scheme_belong_to_the_session(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and qualified(spark, f"file://{tmp_path}").startswith("file:")
