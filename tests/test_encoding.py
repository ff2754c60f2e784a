from __future__ import annotations

import base64

import duckdb
import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusflow.functions import subword
from corpusflow.functions.chars import char_len, collect_vocab, explode_chars
from corpusflow.functions.lists import row_stretches
from corpusflow.operators.encode import CharEncoder, SubwordEncoder, decode_ids, encode_chars, pick_encoder
from corpusflow.operators.rows import map_rows
from corpusflow.operators.vocab import build_vocab, char_freq, corpus_stats, oov_chars, oov_rows, token_long, vocab_size
from corpusflow.plans import corpus_queries, registry

TEXTS = ["", "a", "aé😀b\nc", "é", "x<|endoftext|>y", "tab\there", "zz"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, extra int")


@pytest.fixture(scope="module")
def alphabet():
    return sorted(set("".join(TEXTS)))


def test_vocabulary_is_sorted_by_code_point(docs, alphabet):
    rows = build_vocab(docs).orderBy("id").collect()
    assert [r.ch for r in rows] == alphabet
    assert [r.id for r in rows] == list(range(len(alphabet)))
    assert vocab_size(docs).first()[0] == len(alphabet)


def test_counts(docs, alphabet):
    joined = "".join(TEXTS)
    assert {r.ch: r.cnt for r in char_freq(docs).collect()} == {c: joined.count(c) for c in alphabet}
    stats = corpus_stats(docs).first()
    assert (stats.documents, stats.chars, stats.vocab_size) == (len(TEXTS), len(joined), len(alphabet))
    assert [r[0] for r in docs.orderBy("doc_id").select(char_len("text")).collect()] == [len(t) for t in TEXTS]


def test_long_form_and_explode(docs, alphabet):
    long = {(r.doc_id, r.pos): r.id for r in token_long(docs, build_vocab(docs)).collect()}
    assert long == {(d, p): alphabet.index(c) for d, t in enumerate(TEXTS) for p, c in enumerate(t)}
    assert explode_chars(docs).count() == sum(map(len, TEXTS))


def test_encode_keeps_other_columns_and_decodes_back(docs, alphabet):
    vocab = build_vocab(docs)
    coded = encode_chars(docs, vocab)
    assert coded.columns == ["doc_id", "extra", "ids", "len"]
    for row in coded.collect():
        assert row.ids == [alphabet.index(c) for c in TEXTS[row.doc_id]]
        assert row.len == len(row.ids)
    back = decode_ids(coded, vocab).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(TEXTS))


def test_encode_null_and_empty_table(spark, docs):
    known = collect_vocab(build_vocab(docs))
    nulls = spark.createDataFrame([(1, None), (2, "a")], "doc_id bigint, text string")
    assert [r.ids for r in CharEncoder(known).encode(nulls).orderBy("doc_id").collect()] == [None, [known["a"]]]
    assert CharEncoder(known).encode(nulls.where("doc_id > 5")).count() == 0


def test_unknown_characters(spark):
    known = {"a": 0, "c": 1}
    df = spark.createDataFrame([(1, "abc😀"), (2, "cc"), (3, "")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="outside the vocabulary"):
        encode_chars(df, known).collect()
    dropped = {r.doc_id: (r.ids, r.len) for r in encode_chars(df, known, oov="drop").collect()}
    assert dropped == {1: ([0, 1], 2), 2: ([1, 1], 2), 3: ([], 0)}
    marked = {r.doc_id: r.ids for r in encode_chars(df, known, oov="unk", unk=9).collect()}
    assert marked == {1: [0, 9, 1, 9], 2: [1, 1], 3: []}
    vocab = spark.createDataFrame([(0, "a"), (1, "c")], "id int, ch string")
    assert {r.ch: r.cnt for r in oov_chars(df, vocab).collect()} == {"b": 1, "😀": 1}
    assert {r.doc_id: r.chars for r in oov_rows(df, vocab).collect()} == {1: ["b", "😀"]}
    with pytest.raises(Exception, match="outside the vocabulary"):
        decode_ids(spark.createDataFrame([(1, [5])], "doc_id int, ids array<int>"), known).collect()


def test_byte_ranks(docs):
    ranks = subword.byte_ranks()
    coded = subword.encode_subword(docs, ranks)
    assert coded.columns == ["doc_id", "extra", "ids", "len"]
    for row in coded.collect():
        assert row.ids == [*TEXTS[row.doc_id].encode(), 256]
        assert row.len == len(row.ids)
    assert {r.doc_id: r.text for r in subword.decode_subword(coded, ranks).collect()} == dict(enumerate(TEXTS))
    plain = subword.encode_subword(docs, ranks, eot=False)
    assert {r.doc_id: r.text for r in subword.decode_subword(plain, ranks).collect()} == dict(enumerate(TEXTS))


def test_merges_from_a_ranks_file(spark, tmp_path):
    table = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for t, i in table.items()) + b"\n")
    ranks = subword.read_ranks(str(path))
    assert (ranks.eot, ranks.size) == (258, 259)
    df = spark.createDataFrame([("the then",), ("moth",), (None,)], "text string")
    assert [r.ids for r in SubwordEncoder(ranks).encode(df).collect()] == [
        [257, 32, 257, ord("n"), 258],
        [ord("m"), ord("o"), 256, 258],
        None,
    ]


def test_marker_in_prompt_and_in_corpus(docs):
    ranks = subword.byte_ranks()
    row = subword.encode_prompt(docs, ranks).where("doc_id = 4").first()
    assert row.ids == [ord("x"), 256, ord("y")]
    row = subword.encode_subword(docs, ranks, eot=False).where("doc_id = 4").first()
    assert row.ids == list(b"x<|endoftext|>y")


def test_encoder_runs_once_per_text(docs):
    plan = subword.encode_subword(docs, subword.byte_ranks())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pick_encoder(docs):
    assert pick_encoder(build_vocab(docs), None).size > 5
    assert pick_encoder(None, subword.byte_ranks()).size == 257
    with pytest.raises(ValueError):
        pick_encoder(None, None)


def test_map_rows_adds_and_removes_columns(docs):
    mapped = map_rows(docs, lambda r: {"up": r["text"].upper(), "n": len(r["text"])}, "up string, n int", ["text"])
    assert mapped.columns == ["doc_id", "extra", "up", "n"]
    assert {r.doc_id: (r.up, r.n) for r in mapped.collect()} == {i: (t.upper(), len(t)) for i, t in enumerate(TEXTS)}
    replaced = map_rows(docs, lambda r: {"text": r["text"] * 2}, "text string")
    assert {r.doc_id: r.text for r in replaced.collect()} == {i: t * 2 for i, t in enumerate(TEXTS)}


def test_results_do_not_depend_on_partitioning(docs):
    vocab = build_vocab(docs)
    one = encode_chars(docs.coalesce(1), vocab).orderBy("doc_id").collect()
    many = encode_chars(docs.repartition(7, F.rand(1)), vocab).orderBy("doc_id").collect()
    assert one == many


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, *row) for i, row in enumerate([("aé😀", "fr"), ("", "en"), ("b", "en"), (None, "de")] * 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_token_totals_count_subword_ids(spark, corpus):
    """Every byte is an id and every document ends with one more; characters are not what is counted."""
    assert sum(r.tokens for r in entry.queries()["token_totals"](spark, corpus).collect()) == 5 * (8 + 1 + 2)


def test_an_epoch_is_the_whole_subword_corpus(spark, corpus):
    [epoch] = entry.queries()["epoch_iters"](spark, corpus).collect()
    assert (epoch.split, epoch.tokens, epoch.iters) == ("train", 40, round(40 / 491520, 6))


def merged(text, table):
    """Ids of a text by plain byte-pair merging; a piece that is a token needs none."""
    for piece in regex.findall(subword.WORD_PATTERN, text):
        parts = [bytes([b]) for b in piece.encode()] if piece.encode() not in table else [piece.encode()]
        while pairs := [(table[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in table]:
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        yield from (table[part] for part in parts)


def test_an_epoch_is_counted_in_merged_ids(spark, tmp_path):
    """Against plain merging and the SQL; with single bytes for ranks no pair is ever merged."""
    texts = [
        "the other mathematicians' theorems weren't unforgettable", "  two  blanks\n\n\tand\u00a0\u2003more \r\n x ", "zzzzzqqqqaaaa 1234567²",
        "Überraschungsmoment été 😀😀 日本語", "x<|endoftext|>'s 's'll", " ", "", None, "the other mathematicians' theorems weren't unforgettable",
    ]
    rows = [*enumerate(texts), (None, "no key")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ranks = subword.read_ranks(corpus_queries.RANKS_PATH)
    want = sum(len([*merged(text, ranks.table)]) + 1 for _, text in rows if text is not None)
    [epoch] = entry.queries()["epoch_iters"](spark, str(tmp_path)).collect()
    assert (epoch.split, epoch.tokens, epoch.iters) == ("train", want, round(want / 491520, 6))
    assert want < sum(len(text.encode()) + 1 for _, text in rows if text is not None)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert con.execute(entry.oracle_sql()["epoch_iters"]).fetchall() == [tuple(epoch)]


def test_workers_get_small_batches(spark, corpus):
    """Unless the session names another size."""
    setting = registry.BATCH_SETTING
    for given, want in ((None, registry.BATCH_BYTES), (1 << 20, 1 << 20)):
        spark.conf.unset(setting) if given is None else spark.conf.set(setting, str(given))
        assert entry.queries()["vocab_size"](spark, corpus).first().vocab_size == 4
        assert int(spark.conf.get(setting).removesuffix("b")) == want
    spark.conf.unset(setting)


def test_long_texts_in_one_batch(spark):
    """Batches of several stretches, a text longer than one among them."""
    texts = ["ab" * 300_000, None, "", "é😀" * 800_000, "b", "aé" * 200_000, "x" * 10, None]
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    known = {"a": 0, "b": 1, "é": 2, "😀": 3}
    assert len([*row_stretches([len(t or "") for t in texts])]) > 2
    coded = {r.doc_id: r.ids for r in CharEncoder(known, "drop").encode(frame).collect()}
    assert coded == {i: None if t is None else [known[c] for c in t if c in known] for i, t in enumerate(texts)}
    back = decode_ids(CharEncoder({**known, "x": 4}).encode(frame), {**known, "x": 4})
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
    ranks = subword.byte_ranks()
    pieces = subword.encode_subword(frame, ranks)
    assert {r.doc_id: r.len for r in pieces.collect()} == {i: None if t is None else len(t.encode()) + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in subword.decode_subword(pieces, ranks).collect()} == dict(enumerate(texts))
