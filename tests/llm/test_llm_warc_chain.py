from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from compare import sql_result
from corpusflow.llm import oracles, queries
from corpusflow.llm.warc_chain import chain_ends, chain_entries, page_records, read_archive, scan_chunk, write_archive
from corpusflow.scratch import scratch_path
from corpusflow.ship import ship_package

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 7\r\n\r\nfooled!\r\n\r\n"


def pages():
    rows = [(i, f"http://x/{i}", f"<p>page {i}</p>" * (1 + i % 7)) for i in range(40)]
    rows += [(50, "http://x/ y\r\nz", FAKE * 3), (51, None, None), (52, "u", ""), (53, "u", "<p>page 3</p>" * 4), (54, "u", "<p>page 3</p>" * 4)]
    rows += [(3, "u", "<p>page 3</p>" * 4), (None, "u", "no id"), (60, "u", "é漢\r\n\r\nWARC/1.0\r\n\r\n" * 400), (61, "u", "x" * 300_000 + FAKE), (62, "u", FAKE[:60])]
    return rows


def expected(rows, least):
    firsts = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        firsts[payload] = min(x for x in (i, firsts.get(payload)) if x is not None) if i is not None or firsts.get(payload) is not None else None
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = len(payload) >= least and firsts[payload] != i
        out.append((i, len(payload), digest, "revisit" if again else "response", firsts[payload] if again else None, True))
    return sorted(out, key=str)


@pytest.mark.parametrize(("chunk", "least", "parts"), [(4 << 20, 0, 1), (700, 0, 2), (97, 20, 1)])
def test_archives_read_back_whole(spark, chunk, least, parts):
    ship_package(spark)
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(parts)
    path = scratch_path(spark, "warc")
    write_archive(frame.withColumn("again", F.lit(1)).withColumn("_d", F.lit("x")).select("page_id", "url", "html"), path, least)
    got = page_records(read_archive(spark, path, chunk)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(pages(), least)


def test_magic_in_payloads_is_a_candidate_but_not_reached():
    record = b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % len(FAKE) + FAKE.encode() + b"\r\n\r\n"
    data = record * 3
    found = dict(scan_chunk(data, 0, len(data), len(data)))
    assert len(found) == 6 and found[0] == len(data)
    assert [found[i * len(record)] for i in range(3)] == [len(data)] * 3
    inner = [e for a, e in found.items() if a % len(record)]
    assert inner == [-1] * 3 and scan_chunk(b"", 0, 0, 0) == [] and scan_chunk(b"WARC/1.0\r\nx", 0, 11, 11) == []


def test_a_broken_chain_keeps_what_comes_before(spark, tmp_path):
    ship_package(spark)
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 5 + b"rubbish" + record)
    (tmp_path / "b.warc").write_bytes(record[:-6])
    (tmp_path / "c.warc").write_bytes(b"no archive")
    (tmp_path / "d.warc").write_bytes(b"")
    found = read_archive(spark, f"file://{tmp_path}", 100).collect()
    assert sorted((r.path[-6:], r.offset) for r in found) == [("a.warc", i * len(record)) for i in range(5)]


def test_an_empty_table(spark):
    ship_package(spark)
    path = scratch_path(spark, "warc")
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert page_records(read_archive(spark, path)).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_agree_with_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, folder).collect()
    want = sql_result(folder, oracles.ORACLES[name])
    assert sorted(got[0].asDict()) == sorted(want.columns)
    plain = lambda v: None if v is None or v != v else v if isinstance(v, (str, bool)) else int(v)
    rows = [tuple(None if str(x) in ("<NA>", "nan") else plain(x) for x in r) for r in want[list(got[0].asDict())].itertuples(index=False)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("chunk", [4 << 20, 50_000, 700])
def test_headers_of_any_length(spark, chunk):
    ship_package(spark)
    rows = pages() + [(70, "http://x/" + "y" * 70_000, "long url"), (71, "http://x/" + "é" * 200_000, "<p>longer</p>"), (72, "u", "behind"), (73, "u", "WARC/1.0\r\na: " + "b" * 200_000)]
    path = scratch_path(spark, "warc")
    write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    found = read_archive(spark, path, chunk, whole=True)
    assert sorted((tuple(r) for r in page_records(found).collect()), key=str) == expected(rows, 0)
    targets = {r.record_id: r.target for r in found.collect()}
    assert targets["<urn:page:70>"] == rows[-4][1] and targets["<urn:page:71>"] == rows[-3][1]


def test_broken_chains_are_told(spark, tmp_path):
    ship_package(spark)
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    files = {"a": (record * 5 + b"rubbish" + record, 5 * len(record)), "b": (record[:-6], 0), "c": (b"no archive", 0), "d": (b"", 0), "e": (record * 4, 4 * len(record))}
    for name, (data, _) in files.items():
        (tmp_path / f"{name}.warc").write_bytes(data)
    path = f"file://{tmp_path}"
    entries = chain_entries(spark, path, 100)
    got = {r.path[-6]: (r.size, r.end) for r in chain_ends(spark, path, entries, 100).collect()}
    assert got == {name: (len(data), end) for name, (data, end) in files.items() if data}
    with pytest.raises(ValueError, match="breaks at byte"):
        read_archive(spark, path, 100, whole=True)


def test_headers_inside_headers_are_read_once():
    data = b"WARC/1.0\r\nx: " * 100_000
    assert scan_chunk(data, 0, len(data), len(data)) == []
    data += b"\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert len(scan_chunk(data, 0, len(data), len(data))) == 100_000
