"""Runs of repeated words against a plain search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from textmill.llm import periodic, queries

FOLDER = "/root/testdata/sf0.001"


def runs_by_hand(words, least=6, times=4):
    """Every maximal stretch for every period; a stretch whose period is a multiple of a lesser one is left out."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, m, q) for (s, m), q in found.items())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(words):
    runs = runs_by_hand(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_brute_force(spark):
    rows = queries.queries()["op12_periodic"](spark, FOLDER).collect()
    texts = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{FOLDER}/documents.parquet'").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    with_runs = 0
    for r in rows:
        words = planted(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))
        if len(words) > 3000 and zlib.crc32(str(r.doc_id).encode()) % 10:
            continue  # the plain search is too slow on these
        got = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert got == digest(words), r.doc_id
        with_runs += r.n_runs > 0
    assert with_runs >= 10


@pytest.mark.parametrize("seed", range(6))
def test_random_words(spark, seed):
    draw = random.Random(seed)
    texts = []
    for i in range(150):
        words = [draw.choice("ab" if i % 3 else "abcde") for _ in range(draw.randrange(0, 90))]
        for _ in range(draw.randrange(4)):
            unit = [draw.choice("abcdé") for _ in range(draw.randrange(1, 12))]
            at = draw.randrange(len(words) + 1)
            words[at:at] = (unit * 9)[: draw.randrange(len(unit), 9 * len(unit) + 1)]
        texts.append(words)
    joined = [draw.choice([" ", "\n", " \t"]).join(words) for words in texts]
    table = spark.createDataFrame(list(enumerate(joined)), "doc_id long, text string")
    least, times = (6, 4) if seed % 2 else (1, 3)
    for r in periodic.repeated_runs(table, least, times).collect():
        want = runs_by_hand(texts[r.doc_id], least, times)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(texts[r.doc_id])
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r.collapsed == " ".join(w for i, w in enumerate(texts[r.doc_id]) if i not in gone)


def test_odd_rows(spark):
    said = [(1, None, 0), (None, "a " * 8, 0), (2, "", 0), (2, " \n", 0), (3, "x y " * 200_000, 0), (3, "a b " * 6, 0), (4, "q" * 300_000, 0)]
    table = spark.createDataFrame(said, "doc_id long, text string, runs long")
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in periodic.repeated_runs(table).collect())
    assert got == sorted([
        ("1", 0, [], 0), ("None", 8, [(0, 8, 1)], 1), ("2", 0, [], 0), ("2", 0, [], 0), ("3", 400_000, [(0, 400_000, 2)], 3),
        ("3", 6, [(0, 6, 1)], 3), ("4", 1, [], 300_000),
    ])
    digests = periodic.run_digests(periodic.repeated_runs(table))
    assert digests.where("n_runs = 0 and (start is not null or runs_sha256 is null)").count() == 0
    assert periodic.repeated_runs(table.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.repeated_runs(table, times=2)
