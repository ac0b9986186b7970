"""Archives against the pages they were written from."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import duckdb
import pyarrow.fs as pafs
import pytest

from textmill.llm import queries, warc
from textmill.session import new_folder

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, payload string, key string"


def wanted(rows, least=0):
    most = {}
    for page_id, html in rows:
        if page_id is not None:
            most[html or ""] = max(most.get(html or "", page_id), page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        lead = most.get(html or "") if len(data) >= least else None
        other = lead is not None and page_id != lead
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if other else "response", lead if other else None))
    return sorted(out, key=str)


def test_query_equals_brute_force_and_sql(spark):
    pages = duckdb.sql(f"select page_id, html from '{FOLDER}/pages.parquet'").fetchall()
    df = queries.queries()["op11_warc"](spark, FOLDER)
    got = sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == wanted(pages)
    with duckdb.connect() as db:
        db.execute(f"create view pages as select * from '{FOLDER}/pages.parquet'")
        assert sorted(db.sql(warc.SQL).fetchall(), key=str) == got


def sample(spark):
    draw = random.Random(5)
    said = ["", None, "é" * 5000, "x\r\n\r\nWARC/1.1\r\n" * 40, "<p>same</p>", "tiny", "a" * 70_001]
    rows = [(i, f"http://a/{i}\r\nX: 1", draw.choice(said) if i % 3 else f"<p>{i}</p>" * draw.randrange(400), "p", "k") for i in range(200)]
    rows += [(None, None, "<p>same</p>", "p", "k"), (None, "u", "alone", "p", "k"), (7, "u", rows[7][2], "p", "k")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("chunk,least", [(1 << 18, 0), (1000, 0), (7, 9000), (64, 5)])
def test_round_trip_in_chunks(spark, chunk, least):
    rows, table = sample(spark)
    archives = warc.write_archives(table, new_folder(spark, "warc-test"), least, chunk_bytes=chunk, file_bytes=20_000)
    chunks = warc.read_chunks(spark, archives, chunk).collect()
    ends = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in chunks if r.last), key=str)
    assert ends == wanted([r[:1] + r[2:3] for r in rows], least)
    assert archives.count() >= 4 and sum(r.records for r in archives.collect()) == len(rows)
    assert all(len(r.payload) <= chunk for r in chunks)
    texts = {}
    for r in sorted(chunks, key=lambda r: r.chunk_no):
        if r.record_type == "response" and r.page_id not in (None, 7):
            texts[r.page_id] = texts.get(r.page_id, b"") + r.payload
            # Bytes and digest go up to the end of each chunk.
            assert r.payload_bytes == len(texts[r.page_id])
            if chunk > 500:
                assert r.payload_digest == base64.b32encode(hashlib.sha1(texts[r.page_id]).digest()).decode()
    said = {r[0]: (r[2] or "").encode() for r in rows}
    assert texts and all(said[i] == t for i, t in texts.items())
    assert all("\r" not in r.uri and "\n" not in r.uri for r in chunks)


def test_archives_are_warc(spark):
    _, table = sample(spark)
    path = warc.write_archives(table, new_folder(spark, "warc-test")).first().file
    store, inner = pafs.FileSystem.from_uri(path)
    data = gzip.decompress(open(inner, "rb").read())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")
    assert b"HTTP/1.1 200 OK\r\n" in data and b"WARC-Profile: http://netpreservefoundation.org" in data


def test_broken_archives_are_errors(spark):
    _, table = sample(spark)
    path = warc.write_archives(table.repartition(1), new_folder(spark, "warc-test")).first().file
    data = gzip.decompress(open(pafs.FileSystem.from_uri(path)[1], "rb").read())
    assert list(warc.records(iter([data]), 100)) == list(warc.records(iter(data[i : i + 1] for i in range(len(data))), 100))
    with pytest.raises(ValueError):
        list(warc.records(iter([data[:-3000]]), 100))
    with pytest.raises(ValueError):
        list(warc.records(iter([data.replace(b"aaaa", b"aaab")]), 100))


def test_hot_payload_and_no_rows(spark):
    rows = [(i, "u", "hot" if i % 2 else f"cold {i // 8}", "p", "k") for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    for share in (0.0, 0.1, 1.0):
        named = warc.roles(table.withColumn("payload", table.html.cast("binary")).withColumn("key", table.html.cast("binary")).selectExpr("page_id", "url", "payload", "key", "octet_length(html) as size"), 0, share)
        assert {r.page_id: r.refers_to for r in named.collect()} == {
            i: (399 if i % 2 else i // 8 * 8 + 6) if i not in (399, i // 8 * 8 + 6) else None for i in range(400)
        }
    assert warc.read_back(table.limit(0)).collect() == []
