"""Removal of repeated byte strings by interval expansion on Burrows-Wheeler transforms.

Every string of ``least`` bytes is named by its anchor, the ``GRAM`` bytes in it with the least hash (the first on
ties). Equal strings have equal anchors, so strings are dealt out by anchor: neighbouring strings of a text with
the same anchor form one segment, and an anchor's distinct segments meet in one bucket of bounded size. There the
segments' suffixes are sorted and their Burrows-Wheeler transform is expanded backwards, breadth first: intervals
of suffixes that share 0, 1, 2, .. bytes in turn close the borders between suffixes that share no more. After
``least`` steps the borders still open are those between suffixes that share ``least`` bytes; longer common
prefixes are never derived. An anchor whose segments are too large for a bucket is split by how far its strings
reach to the left and by the bytes they then have in common, again and again down to single strings if need be.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.stage import materialize
from textmill.llm.rows import columns, map_batches, text_bytes

GRAM = 32
BLOCK = 1 << 20  # bytes whose hashes are held at once
_LOW = np.uint64((1 << 22) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on."""
    h = (data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    span = 1
    while span < GRAM:
        h = h[:-span] * np.uint64(0x94D049BB133111EB + 2 * span) + h[span:]
        h ^= h >> np.uint64(31)
        span *= 2
    return h * np.uint64(0x9E3779B97F4A7C15)


def segments(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(anchor, first byte, bytes, anchor's place in it) of the segments of the texts that lie in ``data``."""
    counts = np.maximum(lengths - least + 1, 0)
    if not counts.sum():
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    hashes = gram_hashes(data)
    key = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    wide, span = least - GRAM + 1, 1
    while 2 * span <= wide:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < wide:
        key = np.minimum(key[: len(key) - (wide - span)], key[wide - span :])
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    anchor = (key[at] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1)]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    first = at[new]
    return hashes[anchor[new]].view(np.int64), first, at[last] - first + least, anchor[new] - first


# The longest segment is twice the least string less one gram, and has to fit the fields of ten bits below.
LONGEST = (1023 + GRAM) // 2


# ``place``: a segment's first byte in its text, its size and where its anchor is in it, in one number.
def first_of(p: str = "place") -> Column:
    return F.shiftright(F.col(p), 20)


def size_of(p: str = "place") -> Column:
    return F.shiftright(F.col(p), 10).bitwiseAND(F.lit(1023).cast("long"))


def anchor_of(p: str = "place") -> Column:
    return F.col(p).bitwiseAND(F.lit(1023).cast("long"))


def text_segments(rows: DataFrame, least: int) -> DataFrame:
    """(anchor, seg, key, doc_id, place) of all segments of ``rows`` (doc_id, key, text); ``seg`` hashes its bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[list[np.ndarray]] = []

        def block(pieces: list[tuple[int, int, bytes]]) -> None:
            lengths = np.array([len(p) for _, _, p in pieces])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            joined = b"".join(p for _, _, p in pieces)
            anchor, first, size, inner = segments(np.frombuffer(joined, dtype=np.uint8), starts, lengths, least)
            owner = np.searchsorted(starts, first, side="right") - 1
            view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
            spans = zip(first.tolist(), (first + size).tolist(), strict=True)
            seg = np.array([digest(view[a:b]) for a, b in spans], dtype=np.uint64).view(np.int64)
            base = np.array([b for _, b, _ in pieces])[owner] - starts[owner]
            rows = np.array([i for i, _, _ in pieces])[owner]
            found.append([rows, anchor, seg, ((first + base) << 20) + (size << 10) + inner])

        waiting: list[tuple[int, int, bytes]] = []
        held = 0
        for i, data in enumerate(text_bytes(batch.column("text"))):
            # A long text goes in pieces that overlap by a string less one byte, so each string is in one of them.
            for a in range(0, max(len(data) - least + 1, 0), BLOCK):
                waiting.append((i, a, data[a : a + BLOCK + least - 1]))
                held += len(waiting[-1][2])
                if held >= BLOCK:
                    block(waiting)
                    waiting, held = [], 0
        if waiting:
            block(waiting)
        rows, anchor, seg, where = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        take = pa.array(rows.astype(np.int64))
        columns_ = [pa.array(anchor), pa.array(seg), batch.column("key").take(take), batch.column("doc_id").take(take), pa.array(where)]
        return pa.RecordBatch.from_arrays(columns_, ["anchor", "seg", "key", "doc_id", "place"])

    return map_batches(rows, work, "anchor long, seg long, key binary, doc_id long, place long")


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``symbols`` ordered by at least the ``depth`` symbols from each on, by prefix doubling."""
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    h = min(63 // bits, depth)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(h, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(h):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key)
    ranked = key[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n + 1, dtype=np.int64)  # the first slot of a position's group, from 1; past the end: 0
    rank[n] = 0
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(1, n + 1), 0))
    while h < depth:
        alone = fresh & np.concatenate([fresh[1:], [True]])
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        at = order[open_]
        key = rank[at] * (n + 1) + rank[np.minimum(at + h, n)]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_] = at
        fresh[open_] = np.concatenate([[True], key[1:] != key[:-1]])
        # A group's first slot is fresh, so the greatest fresh slot so far is the group's own.
        rank[at] = np.maximum.accumulate(np.where(fresh[open_], open_ + 1, 0))
        h *= 2
    return order


def open_borders(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each slot of ``order``: whether its suffix and the one before share at least ``depth`` symbols.

    Works through the intervals of suffixes that begin with a common string w, by increasing length of w: put
    before w, each symbol in the interval's part of the transform gives the interval of a longer string. If the
    border behind that is open, its two suffixes share exactly the length of w: it is closed, and only then does
    the longer interval lead on.
    """
    n = len(symbols)
    transform = symbols[order - 1]  # position 0 is preceded by the last symbol, a separator
    step = np.empty(n, dtype=np.int64)  # where a symbol of the transform stands among the suffixes it begins
    step[np.argsort(transform, kind="stable")] = np.arange(n)
    begins = symbols[order]
    still = np.ones(n + 1, dtype=bool)
    still[0] = still[n] = False
    owner = np.zeros(n, dtype=np.int64)
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(depth):
        sizes = high - low + 1
        total = int(sizes.sum())
        if not total:
            break
        inside = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(total)
        to = step[inside]
        owner[to] = np.repeat(np.arange(len(low)), sizes)
        to.sort()
        whose, letter = owner[to], begins[to]
        cut = np.flatnonzero((np.diff(to) != 1) | (np.diff(whose) != 0) | (np.diff(letter) != 0))
        low = to[np.concatenate([[0], cut + 1])]
        high = to[np.concatenate([cut, [total - 1]])]
        closes = still[high + 1]
        still[high[closes] + 1] = False
        low, high = low[closes], high[closes]
    return still[:n]


def repeated_starts(parts: list[bytes], least: int) -> list[np.ndarray]:
    """For each part, from which bytes on ``least`` bytes stand that stand elsewhere in the parts too."""
    data = np.frombuffer(b"".join(part + b"\0" for part in parts), dtype=np.uint8)
    lengths = np.array([len(part) for part in parts])
    ends = np.cumsum(lengths + 1) - 1
    seen = np.zeros(256, dtype=bool)
    is_end = np.zeros(len(data), dtype=bool)
    is_end[ends] = True
    seen[data[~is_end]] = True
    symbols = np.where(is_end, 0, np.cumsum(seen)[data]).astype(np.int16)
    order = sorted_suffixes(symbols, least)
    shared = open_borders(symbols, order, least)
    again = np.zeros(len(data), dtype=bool)
    again[order[shared]] = True
    again[order[np.flatnonzero(shared) - 1]] = True
    starts = ends - lengths
    return [np.flatnonzero(again[a : a + max(n - least + 1, 0)]) for a, n in zip(starts, lengths, strict=True)]


def runs(starts: np.ndarray, least: int) -> tuple[list[int], list[int]]:
    """Bytes covered by strings of ``least`` bytes from ``starts`` on, as the first and end of each run."""
    if not len(starts):
        return [], []
    cut = np.flatnonzero(np.diff(starts) > least)
    first = np.concatenate([[0], cut + 1])
    last = np.concatenate([cut, [len(starts) - 1]])
    return starts[first].tolist(), (starts[last] + least).tolist()


def bucket_runs(parts: DataFrame, least: int) -> DataFrame:
    """(anchor, seg, runs) of ``parts`` (bucket, anchor, seg, copies, part); runs are (first, end) in the segment."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "seg"])
        found = []
        data = [bytes(part) for part in group["part"]]
        for part, copies, starts in zip(data, group["copies"], repeated_starts(data, least), strict=True):
            first, end = ([0], [len(part)]) if copies > 1 else runs(starts, least)
            found.append([{"first": a, "end": b} for a, b in zip(first, end, strict=True)])
        return pd.DataFrame({"anchor": group["anchor"].to_numpy(), "seg": group["seg"].to_numpy(), "runs": found})

    return parts.groupBy("bucket").applyInPandas(work, "anchor long, seg long, runs array<struct<first:int,end:int>>")


def cut_parts(rows: DataFrame, distinct: DataFrame, least: int) -> DataFrame:
    """The bytes of the ``distinct`` segments (anchor, seg, copies, key, doc_id, place), out of the texts of ``rows``.

    ``inner``: where the anchor is in the part; ``low`` and ``high``: how far left of it the part's strings reach
    at least and at most; ``offset``: where the part is in the segment ``root_anchor``, ``root_seg``.
    """
    wanted = distinct.groupBy("key", "doc_id").agg(
        F.collect_list(F.struct("anchor", "seg", "copies", "place")).alias("wanted")
    )
    same = F.col("w.key").eqNullSafe(F.col("r.key")) & F.col("w.doc_id").eqNullSafe(F.col("r.doc_id"))
    cut = rows.alias("r").join(wanted.alias("w"), same).select(F.col("r.text").cast("binary").alias("text"), F.inline("wanted"))
    return cut.select(
        F.col("anchor").alias("root_anchor"), F.col("seg").alias("root_seg"), F.lit(0).alias("offset"), "copies",
        "anchor", "seg", anchor_of().cast("int").alias("inner"), F.lit(0).alias("low"), F.lit(least - GRAM).alias("high"),
        F.substring("text", (first_of() + 1).cast("int"), size_of().cast("int")).alias("part"),
    )


def split_parts(large: DataFrame, least: int) -> DataFrame:
    """``large`` parts in two halves by how far their strings reach to the left of the anchor.

    The strings of a half all hold the bytes from its ``low`` left of the anchor to what the farthest reaching has
    on the right, so those bytes are part of its new anchor.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct((middle + 1).alias("low"), F.col("high").alias("high")),
    )
    once = large.dropDuplicates(["root_anchor", "root_seg", "offset", "low"])
    cut = once.select("*", F.explode(halves).alias("half"))
    lo, hi = F.col("half.low"), F.col("half.high")
    begin = F.greatest(F.lit(0), F.col("inner") - hi)
    finish = F.least(F.length("part") - least, F.col("inner") - lo)
    common = F.substring("part", F.col("inner") - lo + 1, F.lit(least) + lo - hi)
    cut = cut.select("*", begin.alias("begin"), finish.alias("finish"), common.alias("common")).where("begin <= finish")
    kept = F.substring("part", F.col("begin") + 1, F.col("finish") - F.col("begin") + least)
    cut = cut.withColumn("kept", kept)
    return cut.select(
        "root_anchor", "root_seg", (F.col("offset") + F.col("begin")).alias("offset"), "copies",
        F.xxhash64("anchor", lo, hi, "common").alias("anchor"), F.xxhash64("kept").alias("seg"),
        (F.col("inner") - F.col("begin")).alias("inner"), lo.alias("low"), hi.alias("high"), F.col("kept").alias("part"),
    )


def shared_runs(parts: DataFrame, least: int, bucket_bytes: int) -> DataFrame:
    """(root_anchor, root_seg, first, end): runs of repeated strings in the segments that ``parts`` come from."""
    found, level = [], parts
    while level is not None:
        unique = level.groupBy("anchor", "seg").agg(
            F.sum("copies").alias("copies"), F.first("part").alias("part")
        ) if found else level.select("anchor", "seg", "copies", "part")
        stats = unique.groupBy("anchor").agg(
            F.count_distinct("seg").alias("many"), F.sum("copies").alias("n"), F.sum(F.length("part")).alias("bytes")
        )
        stats = materialize(stats.where("many > 1 or n > 1"), "stats")
        total = stats.where("many > 1").agg(F.sum(F.least("bytes", F.lit(bucket_bytes)))).first()[0] or 0
        buckets = max(1, -(-total // (bucket_bytes // 2)))
        small = stats.where(F.col("bytes") <= bucket_bytes).where("many > 1").select("anchor")
        large = materialize(stats.where(F.col("bytes") > bucket_bytes).where("many > 1").select("anchor"), "large")
        bucketed = unique.join(small, "anchor", "left_semi").select(
            F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"), "anchor", "seg", "copies", "part"
        )
        whole = F.array(F.struct(F.lit(0).alias("first"), F.length("part").alias("end")))
        lone = unique.join(stats.where("many = 1").select("anchor"), "anchor", "left_semi").select("anchor", "seg", whole.alias("runs"))
        answers = materialize(bucket_runs(bucketed, least).unionByName(lone), "runs")
        roots = level.select("root_anchor", "root_seg", "offset", "anchor", "seg")
        marked = roots.join(answers, ["anchor", "seg"]).select("root_anchor", "root_seg", "offset", F.inline("runs"))
        at = F.col("offset")
        found.append(marked.select("root_anchor", "root_seg", (at + F.col("first")).alias("first"), (at + F.col("end")).alias("end")))
        more = not large.isEmpty()
        level = materialize(split_parts(level.join(large, "anchor", "left_semi"), least), "split") if more else None
    return reduce(DataFrame.unionByName, found)


def repeated_ranges(rows: DataFrame, least: int, bucket_bytes: int) -> DataFrame:
    """(key, first, end): byte ranges of texts (doc_id, key, text) that repeated strings cover; they may overlap."""
    segs = text_segments(rows, least)
    # An anchor that stands once has no repeated string; one with a single distinct segment has no other.
    per = segs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("seg").alias("least"), F.max("seg").alias("most"))
    shared = segs.join(per.where("n > 1"), "anchor").withColumn("mixed", F.col("least") != F.col("most"))
    shared = materialize(shared.drop("n", "least", "most"), "shared")
    alike = shared.where("not mixed").select("key", first_of().alias("first"), (first_of() + size_of()).alias("end"))
    distinct = shared.where("mixed").groupBy("anchor", "seg").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "doc_id", "place")).alias("one")
    )
    parts = materialize(cut_parts(rows, distinct.select("anchor", "seg", "copies", "one.*"), least), "parts")
    runs_ = shared_runs(parts, least, bucket_bytes).withColumnsRenamed({"root_anchor": "anchor", "root_seg": "seg"})
    marked = shared.where("mixed").join(runs_, ["anchor", "seg"])
    return alike.unionByName(
        marked.select("key", (first_of() + F.col("first")).alias("first"), (first_of() + F.col("end")).alias("end"))
    )


def remove_repeats(docs: DataFrame, least: int = 200, bucket_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of ``docs`` (doc_id, text).

    Removes each byte that a string of ``least`` bytes covers which begins anywhere else too, in the same text or
    another; copies of a text are removed all. Null texts are empty; texts under ``least`` bytes lose nothing;
    repeated rows are texts of their own; a null doc_id stays; other columns are ignored; no rows give no rows.
    ``kept``: what remains, as bytes, since a cut may fall inside a character.
    """
    if least < 2 * GRAM:
        raise ValueError(f"strings of less than {2 * GRAM} bytes are not searched for")
    if least > LONGEST:
        raise ValueError(f"strings of more than {LONGEST} bytes do not fit the fields of a segment's place")
    rows = columns(docs, doc_id="long", text="string")
    rows = rows.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    ranges = repeated_ranges(rows.where(F.octet_length("text") >= least), least, bucket_bytes)
    # Copies give the same ranges: they are made one before a text's are gathered.
    ranges = ranges.distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("ranges"))
    joined = rows.join(ranges, "key", "left").select("doc_id", "text", "ranges.first", "ranges.end")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        cells = zip(text_bytes(batch.column("text")), batch.column("first").to_pylist(), batch.column("end").to_pylist(), strict=True)
        for data, firsts, ends in cells:
            kept, at, removed, spans, reached = [], 0, 0, 0, -1
            for a, b in zip(firsts or [], ends or [], strict=True):
                if a > reached:
                    kept.append(data[at:a])
                    spans += 1
                    removed += b - a
                    at = reached = b
                elif b > reached:
                    removed += b - reached
                    at = reached = b
            kept.append(data[at:])
            left = b"".join(kept)
            out.append((len(data), removed, spans, hashlib.sha256(left).hexdigest(), left))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        made = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_batches(joined, work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
