from __future__ import annotations

import json
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.chars import collect_vocab
from corpusflow.operators.encode import CharEncoder
from corpusflow.operators.pages import contiguous_shards, in_order, page_pieces, token_offsets, token_pages, token_totals
from corpusflow.operators.sampling import sample_blocks, sample_documents, split_sizes
from corpusflow.operators.splits import split_contiguous, split_random
from corpusflow.operators.vocab import build_vocab
from corpusflow.plans.char_corpus import char_pages
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from corpusflow.sources.tokenfile import PartsWriter, TokenFileReader, pages_per_file, read_token_files, sample_token_files, write_token_files

P = 8
# shorter than a page, exactly a page, across three pages, an empty document between two others
SIZES = {"train": [3, 8, 0, 20, 1, 0, 0, 7, 8, 30], "val": [5, 0, 4]}


@pytest.fixture(scope="module")
def documents():
    draw = random.Random(4)
    return [
        (split, 10 * i - 40, [draw.randint(0, 65535) for _ in range(n)])
        for split, sizes in SIZES.items()
        for i, n in enumerate(sizes)
    ]


@pytest.fixture(scope="module")
def streams(documents):
    return {s: [t for split, _, ids in documents if split == s for t in ids] for s in SIZES}


@pytest.fixture(scope="module")
def coded(spark, documents):
    df = spark.createDataFrame(documents, "split string, doc_id bigint, ids array<int>")
    return df.withColumn("len", F.size("ids")).repartition(4)


def joined(pages):
    got = {}
    for row in sorted(pages.collect(), key=lambda r: (r.split, r.page)):
        got.setdefault(row.split, []).append(row.ids)
    return got


@pytest.mark.parametrize("bits", [2, 16])
def test_pages_are_the_concatenated_documents(coded, streams, bits):
    pages = token_pages(coded, P, bits=bits)
    for split, lists in joined(pages).items():
        assert [t for ids in lists for t in ids] == streams[split]
        assert all(len(ids) == P for ids in lists[:-1]) and 1 <= len(lists[-1]) <= P
    assert {r.split: r.tokens for r in token_totals(coded).collect()} == {s: len(t) for s, t in streams.items()}


def test_offsets(coded, documents):
    want, place = {}, {}
    for split, doc, ids in documents:
        want[split, doc] = place.get(split, 0)
        place[split] = want[split, doc] + len(ids)
    assert {(r.split, r.doc_id): r.start for r in token_offsets(coded, bits=3).collect()} == want


def test_shards_match_array_split(coded, documents):
    for n in (1, 3, 4, 16):
        got = {(r.split, r.doc_id): r.shard for r in contiguous_shards(coded, n, bits=2).collect()}
        for split in SIZES:
            keys = [d for s, d, _ in documents if s == split]
            for shard, part in enumerate(np.array_split(keys, n)):
                assert all(got[split, int(k)] == shard for k in part)


@pytest.mark.parametrize("layout", ["parts", "single"])
def test_token_files_round_trip(spark, coded, streams, tmp_path, layout):
    path = str(tmp_path / "store")
    pages = token_pages(coded, P)
    write_token_files(pages, path, page_size=P, layout=layout, file_pages=2)
    back = read_token_files(spark, path, page_size=P, task_tokens=2 * P)
    assert joined(back) == joined(pages)
    other = read_token_files(spark, path, page_size=5, task_tokens=10)
    assert {s: [t for ids in lists for t in ids] for s, lists in joined(other).items()} == streams
    only = read_token_files(spark, path, page_size=P).where("split = 'val'")
    assert {r.split for r in only.collect()} == {"val"}
    some = back.where(F.col("page").isin(0, 1, 4, 5, 6, 99))
    assert {(r.split, r.page): r.ids for r in some.collect()} == {
        (r.split, r.page): r.ids for r in pages.collect() if r.page in (0, 1, 4, 5, 6)
    }
    train = back.where("split = 'train'")
    for d in sample_blocks(train, iters=3, batch=2, block=11, page_size=P).collect():
        assert d.x == streams["train"][d.start : d.start + 11]


def test_only_wanted_pages_are_read(tmp_path):
    np.arange(100, dtype="<u2").tofile(tmp_path / "train.bin")
    for task_tokens, tasks in ((8, 5), (1000, 1)):
        reader = TokenFileReader(str(tmp_path), 4, task_tokens)
        assert list(reader.pushFilters([In(("page",), (1, 2, 3, 4, 9, 24, 25, 90)), GreaterThan(("page",), 2)])) == [GreaterThan(("page",), 2)]
        parts = reader.partitions()
        assert sum(n for part in parts for run in part.runs for _, _, n in run.pieces) == 6 * 4
        got = [i for part in parts for batch in reader.read(part) for ids in batch.column("ids").to_pylist() for i in ids]
        assert got == [*range(4, 20), *range(36, 40), *range(96, 100)]
        assert len(parts) <= tasks


def test_flat_file_is_what_numpy_expects(spark, coded, streams, tmp_path):
    write_token_files(token_pages(coded, P), str(tmp_path / "flat"), page_size=P, layout="single")
    for split, ids in streams.items():
        assert np.fromfile(tmp_path / "flat" / f"{split}.bin", dtype="<u2").tolist() == ids
    write_token_files(token_pages(coded, P), str(tmp_path / "parts"), page_size=P, file_pages=3)
    manifest = json.loads((tmp_path / "parts" / "manifest.json").read_text())
    for split, ids in streams.items():
        files = [f for f in manifest["files"] if f["split"] == split]
        raw = b"".join((tmp_path / "parts" / f["file"]).read_bytes() for f in files)
        assert np.frombuffer(raw, dtype="<u2").tolist() == ids
        assert manifest["totals"][split] == len(ids)


def test_pages_per_file():
    assert pages_per_file(10**9, 1024, 8) == 65536
    assert pages_per_file(1024 * 100, 1024, 8) == 13
    assert pages_per_file(0, 1024, 8) == 1


def test_overwrite_leaves_only_the_new_files(spark, coded, tmp_path):
    path = tmp_path / "store"
    pages = token_pages(coded, P)
    write_token_files(pages, str(path), page_size=P)
    with pytest.raises(Exception, match="already holds"):
        write_token_files(pages, str(path), page_size=P)
    write_token_files(pages.where("split = 'val'"), str(path), page_size=P, mode="overwrite")
    listed = {f["file"] for f in json.loads((path / "manifest.json").read_text())["files"]}
    assert {str(f.relative_to(path)) for f in path.rglob("*.bin")} == listed
    assert {r.split for r in read_token_files(spark, str(path), page_size=P).collect()} == {"val"}


@pytest.mark.parametrize("layout", ["parts", "single"])
@pytest.mark.parametrize("bad", [70_000, -1])
def test_ids_must_fit_16_bits(spark, tmp_path, layout, bad):
    pages = spark.createDataFrame([("train", 0, [1, bad])], "split string, page bigint, ids array<int>")
    with pytest.raises(Exception, match="does not fit"):
        write_token_files(pages, str(tmp_path / "t"), page_size=P, layout=layout)
    assert not [f for f in Path(tmp_path).rglob("*") if f.is_file()]


@pytest.mark.parametrize("layout", ["parts", "single"])
def test_missing_page_fails(spark, tmp_path, layout):
    rows = [("train", 0, [1] * P), ("train", 2, [2] * P)]
    pages = spark.createDataFrame(rows, "split string, page bigint, ids array<int>")
    with pytest.raises(Exception, match="missing"):
        write_token_files(pages, str(tmp_path / "t"), page_size=P, layout=layout)


def test_foreign_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    np.arange(10, dtype="<u2").tofile(tmp_path / "a" / "train.bin")
    assert joined(read_token_files(spark, str(tmp_path), page_size=4)) == {"train": [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]}
    (tmp_path / "b").mkdir()
    np.arange(3, dtype="<u2").tofile(tmp_path / "b" / "train.bin")
    with pytest.raises(Exception, match="two token files"):
        read_token_files(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_token_files(spark, str(tmp_path / "none")).collect()


CUTS = [([10], 0.9), ([1, 9], 0.9), ([0, 5, 5, 0], 0.5), ([11], 0.9), ([9], 0.9), ([0], 0.9), ([], 0.9), ([1], 0.9)]
CUTS += [([30, 0, 0, 30, 7], f) for f in (0.0, 0.3, 0.9, 1.0)]


@pytest.mark.parametrize(("lengths", "fraction"), CUTS)
def test_split_contiguous(spark, lengths, fraction):
    draw = random.Random(5)
    texts = ["".join(draw.choice("aé😀b") for _ in range(n)) for n in lengths]
    df = spark.createDataFrame([(i * 7, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, extra string")
    got = split_contiguous(df, fraction, bits=3).orderBy("doc_id", "split").collect()
    whole = "".join(texts)
    cut = int(len(whole) * fraction)
    parts = {s: "".join(r.text for r in got if r.split == s) for s in ("train", "val")}
    assert parts == {"train": whole[:cut], "val": whole[cut:]}
    assert all(r.extra == "x" for r in got)
    assert {r.doc_id for r in got} == {i * 7 for i in range(len(texts))}


def test_small_corpus_split_sizes():
    # published sizes of the small character corpus
    assert (int(1_115_394 * 0.9), 1_115_394 - int(1_115_394 * 0.9)) == (1_003_854, 111_540)


def test_split_random_is_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    one = {r.doc_id: r.split for r in split_random(df, 0.1, seed=1).collect()}
    two = {r.doc_id: r.split for r in split_random(df.repartition(13), 0.1, seed=1).collect()}
    assert one == two
    assert 400 < sum(s == "val" for s in one.values()) < 600
    assert one != {r.doc_id: r.split for r in split_random(df, 0.1, seed=2).collect()}


def test_sample_blocks_against_slicing(coded, streams):
    pages = token_pages(coded, P)
    assert split_sizes(pages) == {s: len(t) for s, t in streams.items()}
    train = pages.where("split = 'train'")
    for block in (1, 7, 8, 20):
        draws = sample_blocks(train, iters=10, batch=6, block=block, page_size=P).collect()
        assert len({(d.iter, d.row) for d in draws}) == len(draws) == 60
        for d in draws:
            assert 0 <= d.start < len(streams["train"]) - block
            assert d.x == streams["train"][d.start : d.start + block]
            assert d.y == streams["train"][d.start + 1 : d.start + 1 + block]
    again = sample_blocks(train.repartition(9), iters=10, batch=6, block=20, page_size=P)
    assert sorted(again.collect()) == sorted(draws)


def test_sample_needs_more_tokens_than_a_block(coded, streams):
    pages = token_pages(coded, P).where("split = 'val'")
    n = len(streams["val"])
    assert {d.start for d in sample_blocks(pages, 3, 3, block=n - 1, page_size=P).collect()} == {0}
    with pytest.raises(ValueError, match="not more than a block"):
        sample_blocks(pages, 1, 1, block=n, page_size=P)


def test_char_pages_decode_to_the_text(spark):
    texts = ["aé😀b\nc", "", "x" * 50, "end"]
    df = spark.createDataFrame([("train", i, t) for i, t in enumerate(texts)], "split string, doc_id bigint, text string")
    known = collect_vocab(build_vocab(df))
    back = {i: c for c, i in known.items()}
    pages = joined(char_pages(df, P, CharEncoder(known)))
    assert "".join(back[i] for ids in pages["train"] for i in ids) == "".join(texts)


def test_rows_travel_once_and_pieces_remain_at_ends(spark, coded, streams):
    offsets = token_offsets(coded)
    placed = in_order(coded.select("split", "doc_id", "ids"), offsets)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "Join" not in plan.split("rangepartitioning")[0]
    cut = page_pieces(placed.coalesce(1), P).collect()
    whole = [r for r in cut if r.at is None]
    assert len(whole) == sum(len(s) // P for s in streams.values()) and all(len(r.ids) == P for r in whole)
    assert len(cut) - len(whole) <= len(streams)
    # in any order of rows the pieces are the right ones
    for rows in (cut, page_pieces(placed.orderBy(F.rand(3)), P).collect()):
        for split, ids in streams.items():
            got = dict(p for r in rows if r.split == split for p in enumerate(r.ids, r.page * P + (r.at or 0)))
            assert [got[i] for i in range(len(ids))] == ids and len(got) == len(ids)


@pytest.mark.parametrize("size", [3, P, 2 * P])
def test_a_task_may_have_nothing_to_hand_on(spark, size):
    """Less than a page in its first batch, or nothing held after its last."""
    docs = spark.createDataFrame([("train", 1, list(range(size)), size)], "split string, doc_id bigint, ids array<int>, len int")
    assert sum(joined(token_pages(docs, P))["train"], []) == list(range(size))


@pytest.mark.parametrize("layout", ["parts", "single"])
def test_pages_are_written_where_they_lie(spark, coded, streams, tmp_path, layout):
    path = str(tmp_path / "store")
    write_token_files(token_pages(coded, P), path, page_size=P, layout=layout, in_stretches=True)
    assert {s: [t for ids in lists for t in ids] for s, lists in joined(read_token_files(spark, path, page_size=P)).items()} == streams
    drawn = sample_token_files(spark, path, iters=5, batch=3, block=7, tasks=4).collect()
    assert len(drawn) == 5 * 3 * len(streams)
    for d in drawn:
        assert d.x == streams[d.split][d.start : d.start + 7] and d.y == streams[d.split][d.start + 1 : d.start + 8]
    same = sample_blocks(token_pages(coded, P), iters=5, batch=3, block=7, page_size=P).collect()
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, same))


def test_ranges_of_pages_are_read(spark, tmp_path):
    np.arange(1000, dtype="<u2").tofile(tmp_path / "train.bin")

    def pages(*filters):
        reader = TokenFileReader(str(tmp_path), 4, 40)
        assert [f for f in reader.pushFilters(list(filters)) if isinstance(f, (EqualTo, In))] == []
        return sorted({run.first_page + k for part in reader.partitions() for run in part.runs for k in range(-(-sum(n for *_, n in run.pieces) // 4))})

    assert pages(GreaterThan(("page",), 3), LessThanOrEqual(("page",), 9)) == list(range(4, 10))
    assert pages(GreaterThanOrEqual(("page",), 240), GreaterThan(("page",), 5)) == list(range(240, 250))
    assert pages(LessThan(("page",), 2), EqualTo(("split",), "train")) == [0, 1]
    assert pages(LessThan(("page",), 0)) == [] and pages(GreaterThan(("page",), 900)) == []
    assert pages() == list(range(250))
    back = read_token_files(spark, str(tmp_path), page_size=4).where("page BETWEEN 7 AND 9 AND page <> 8")
    assert {r.page: r.ids for r in back.collect()} == {7: [28, 29, 30, 31], 9: [36, 37, 38, 39]}


def test_scattered_pages_are_dealt_out(tmp_path):
    np.zeros(80_000, dtype="<u2").tofile(tmp_path / "train.bin")
    reader = TokenFileReader(str(tmp_path), 4, 1 << 24)
    list(reader.pushFilters([In(("page",), tuple(range(0, 20_000, 10)))]))
    parts = reader.partitions()
    assert len(parts) >= 30 and sum(len(p.runs) for p in parts) == 2_000


@pytest.mark.parametrize("block", [1, 7, 25])
def test_blocks_come_from_drawn_documents_alone(spark, block):
    draw = random.Random(block)
    texts = {s: ["".join(draw.choice("abé😀") for _ in range(draw.choice([0, 1, 3, 9, 60]))) for _ in range(60)] for s in ("x", "y")}
    rows = [(s, 5 * i, t) for s, ts in texts.items() for i, t in enumerate(ts)]
    docs = spark.createDataFrame(rows, "split string, doc_id bigint, text string").repartition(3)
    encoder, encoded = CharEncoder({c: i for i, c in enumerate("abé😀")}), []

    def encode(df):
        encoded.extend((r.split, r.doc_id) for r in df.collect())
        return encoder.encode(df)

    got = sample_documents(docs, encode, iters=3, batch=2, block=block, seed=4, bits=3).collect()
    assert len(got) == 12
    touched = set()
    for d in got:
        whole = "".join(texts[d.split])
        assert ["abé😀"[i] for i in d.x] == list(whole[d.start : d.start + block])
        assert ["abé😀"[i] for i in d.y] == list(whole[d.start + 1 : d.start + block + 1])
        at = 0
        for i, t in enumerate(texts[d.split]):
            if t and at <= d.start + block and at + len(t) > d.start:
                touched.add((d.split, 5 * i))
            at += len(t)
    assert len(encoded) == len(set(encoded)) and set(encoded) == touched and len(touched) < len(rows)


def batch(split, page, ids):
    return pa.record_batch({"split": [split] * len(ids), "page": pa.array(range(page, page + len(ids)), pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))})


def test_repeated_and_failed_tasks_leave_nothing(tmp_path):
    root = tmp_path / "store"
    writer = PartsWriter(f"file://{root}", 2, False)
    first = writer.write(iter([batch("train", 0, [[1, 2], [3, 4]])]))
    again = writer.write(iter([batch("train", 0, [[1, 2], [3, 4]])]))  # the first attempt's message is lost
    second = writer.write(iter([batch("train", 2, [[5]]), batch("val", 0, [[6]])]))
    with pytest.raises(ValueError, match="does not fit"):
        writer.write(iter([batch("val", 1, [[7, 8]]), batch("val", 2, [[70_000]])]))
    assert len(list(root.rglob("*.bin"))) == 5 and first.files != again.files
    writer.commit([again, second, None])
    listed = json.loads((root / "manifest.json").read_text())["files"]
    assert {str(f.relative_to(root)) for f in root.rglob("*.bin")} == {f["file"] for f in listed}
    assert b"".join((root / f["file"]).read_bytes() for f in listed if f["split"] == "train") == np.arange(1, 6, dtype="<u2").tobytes()


def test_cut_files_are_not_committed(tmp_path):
    writer = PartsWriter(f"file://{tmp_path}", 2, False)
    message = writer.write(iter([batch("train", 0, [[1, 2], [3, 4]])]))
    (tmp_path / message.files[0][1]).write_bytes(b"\0\0")
    with pytest.raises(ValueError, match="holds 2 bytes"):
        writer.commit([message])
    assert not (tmp_path / "manifest.json").exists()
    writer.abort([message])
    assert not list(tmp_path.rglob("*.bin"))
