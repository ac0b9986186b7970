"""Runs of repeated words, by a dictionary of basic factors.

A basic factor is a stretch of words whose length is a power of two. The factors of one length get numbers, equal
for equal factors; the numbers of twice the length come from pairs of them. Where a factor occurs again inside
the window of twice its length that begins with it, its successors there form an arithmetic progression whose
difference is a period. A progression that goes on from word to word with one difference is a proposal; as the
factor is at least as long as the period, the proposal extends to the whole run on both sides, and no shorter
period is possible. Lengths give the same run several times, so proposals are made distinct.

Only factors that occur twice in their text are carried on to the next length, so plain prose is done after a
few of them.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import columns, map_batches, text_bytes

# Words of the texts whose factors are numbered together; a longer text is on its own.
BLOCK = 1 << 18
RUNS = "array<struct<start:long,length:long,period:long>>"
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words of one text and for no others; the end of each word's text."""
    numbers: list[int] = []
    for words in texts:
        numbered = defaultdict(count(len(numbers)).__next__)
        numbers.extend(map(numbered.__getitem__, words))
    ends = np.cumsum(np.array([len(words) for words in texts], dtype=np.int64))
    return np.array(numbers, dtype=np.int64), np.repeat(ends, np.diff(ends, prepend=0))


def renumber(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors at the places ``at`` (ascending) with ``keys``: those that occur twice.

    Gives their places, their new numbers and how far on each occurs next (0: nowhere), by ascending place.
    """
    order = np.argsort(keys, kind="stable")
    place, key = at[order], keys[order]
    same = key[1:] == key[:-1]
    gap = np.zeros(len(at), dtype=np.int64)
    gap[:-1][same] = (place[1:] - place[:-1])[same]
    again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    number = np.cumsum(np.concatenate([[True], ~same]))
    back = np.argsort(place[again])
    return place[again][back], number[again][back], gap[again][back]


def runs_of(numbers: np.ndarray, ends: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs in ascending order; starts count over all texts."""
    found = [np.empty((0, 3), dtype=np.int64)]
    at, length = np.arange(len(numbers)), 1
    name = np.full(len(numbers), -1, dtype=np.int64)
    keys = numbers
    while len(at):
        at, number, gap = renumber(at, keys)
        near = np.flatnonzero((gap > 0) & (gap <= length))
        if len(near):
            place, period = at[near], gap[near]
            new = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(period) != 0)])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(near)]]) - 1
            start, step = place[first], period[first]
            size = place[last] - start + step + length
            whole = (size >= least) & (size >= times * step)
            found.append(np.column_stack([start, size, step])[whole])
        name.fill(-1)
        name[at] = number
        # The next length: a factor here and one right behind it, both of which occur twice.
        fits = at + 2 * length <= ends[at] if len(at) else np.empty(0, dtype=bool)
        at = at[fits]
        behind = name[at + length]
        at, behind = at[behind >= 0], behind[behind >= 0]
        keys = name[at] * (len(numbers) + 2) + behind
        length *= 2
    return np.unique(np.concatenate(found), axis=0)


def dropped(size: int, runs: np.ndarray) -> np.ndarray:
    """Marks the words that stand in a run behind its first period."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_runs(docs: DataFrame, least: int = 6, times: int = 4, prepare: Prepare | None = None) -> DataFrame:
    """doc_id, n_words, runs and collapsed of each row of ``docs`` (doc_id, text).

    ``runs``: array of (start, length, period) by start, then period: each stretch of at least ``least`` words and
    ``times`` its least period that no neighbouring word extends. ``collapsed``: the words that no run holds behind
    its first period, joined by one space. ``times`` is 3 at least: a shorter run need not show at a factor as long
    as its period. Words end at ASCII white space.

    Null, empty and blank texts have no words, no runs and an empty collapsed text; a null doc_id stays; repeated
    rows are texts of their own; other columns are ignored; no rows give no rows. Of runs that begin together the
    lesser period comes first. A text is one cell and is worked on whole; memory grows with the longest text.
    ``prepare`` changes the words of a text, given doc_id and words, before the search. No shuffle.
    """
    if times < 3:
        raise ValueError("runs of less than three periods are not searched for")

    def block(texts: list[list[bytes]]) -> list[tuple]:
        numbers, ends = word_numbers(texts)
        runs = runs_of(numbers, ends, least, times)
        gone = dropped(len(numbers), runs)
        out, at = [], 0
        first = np.searchsorted(runs[:, 0], np.cumsum([0] + [len(t) for t in texts]))
        for i, words in enumerate(texts):
            mine = runs[first[i] : first[i + 1]]
            if len(mine):
                left = b" ".join([w for w, out_ in zip(words, gone[at : at + len(words)].tolist(), strict=True) if not out_])
                listed = [{"start": s - at, "length": n, "period": p} for s, n, p in mine.tolist()]
            else:
                left, listed = b" ".join(words), []
            out.append((len(words), listed, left))
            at += len(words)
        return out

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id")
        out: list[tuple] = []
        waiting: list[list[bytes]] = []
        held = 0
        for doc_id, data in zip(ids.to_pylist(), text_bytes(batch.column("text")), strict=True):
            words = data.split()  # of bytes: at ASCII white space only
            waiting.append(prepare(doc_id, words) if prepare else words)
            held += len(waiting[-1])
            if held >= BLOCK:
                out += block(waiting)
                waiting, held = [], 0
        out += block(waiting)
        n_words, runs, left = zip(*out, strict=True)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        made = [pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([ids, *made], ["doc_id", "n_words", "runs", "collapsed"])

    rows = columns(docs, doc_id="long", text="string")
    return map_batches(rows, work, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of all documents, chosen by doc_id, with a tail made periodic; a null doc_id never is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a : a + p]
    return words[:a] + (head * ((n - a) // p + 1))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`repeated_runs`: the longest run (ties: first start, then least period)."""
    best = F.element_at(F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.sign(b["length"] - a["length"]))
                                     .when(a["start"] != b["start"], F.sign(a["start"] - b["start"]))
                                     .otherwise(F.sign(a["period"] - b["period"])).cast("int")), 1)
    best = F.when(F.size("runs") > 0, best)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
