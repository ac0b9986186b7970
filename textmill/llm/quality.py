"""Quality rules by compression bands.

Zstandard's ratio (bytes before over bytes after) is high for repetitive text and near one for text that cannot
be compressed. A short text compresses less, so each length has limits of its own. The ratio of the whole text
catches repetition at any distance; ratios of fixed chunks catch texts of which a large part is out of band
while the whole still looks ordinary.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from textmill.llm.rows import columns, map_batches, texts

# (below so many bytes, least ratio, greatest ratio) of a whole text. Prose of any size lies well inside.
WHOLE_BANDS = (
    (128, 0.0, 3.0), (256, 0.0, 3.0), (512, 1.1, 3.0), (1024, 1.2, 3.0), (4096, 1.3, 3.5), (16384, 1.4, 4.0),
    (65536, 1.4, 4.5), (float("inf"), 1.4, 5.0),
)
SYMBOLS = re.compile(r"[#*$%&|<>]")


@dataclass(frozen=True)
class Bands:
    whole: tuple[tuple[float, float, float], ...] = WHOLE_BANDS
    chunk_bytes: int = 2048
    chunk_least: float = 1.2
    chunk_most: float = 5.0
    bad_chunks: float = 0.25  # the share of full chunks out of band that rejects a text
    level: int = 3


def band_verdict(data: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole, share of full chunks out of band, and whether both are within limits.

    An empty text has ratio 1 and no chunks. Only full chunks count, as a rest has no comparable ratio.
    """
    if not data:
        return 1.0, 0.0, True
    ratio = len(data) / len(compressor.compress(data))
    _, least, most = next(band for band in bands.whole if len(data) < band[0])
    full = len(data) // bands.chunk_bytes
    view, bad = memoryview(data), 0
    for i in range(full):
        chunk = view[i * bands.chunk_bytes : (i + 1) * bands.chunk_bytes]
        bad += not bands.chunk_least <= bands.chunk_bytes / len(compressor.compress(chunk)) <= bands.chunk_most
    share = bad / full if full else 0.0
    return ratio, share, least <= ratio <= most and share <= bands.bad_chunks


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated windows of three words."""
    raw = text.encode().split()  # bytes split at exactly the six ASCII white-space characters
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            repeated += line in seen
            seen.add(line)
    windows = list(zip(raw, raw[1:], raw[2:], strict=False))
    often = {window for window, n in Counter(windows).items() if n > 1}
    covered = reached = 0
    if often:
        for i, window in enumerate(windows):
            if window in often:
                covered += i + 3 - max(i, reached)
                reached = i + 3
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    return len(raw), len(text) - spaces, len(SYMBOLS.findall(text)), repeated, covered


RULES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, bad_chunk_share double"
)


def _judge(bands: Bands):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        out = []
        for text in texts(batch.column("text")):
            counts = text_counts(text)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            ratio, share, fits = band_verdict(text.encode(), bands, compressor)
            out.append((*counts, failed, fits and not failed, ratio, share))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        made = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        names = [field.split()[0] for field in RULES.split(", ")]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    return work


def quality_rules(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the base counts, the ratios and the verdict ``kept``.

    A null or empty text has no words, so it fails the base rule. Repeated rows are judged alike; a null doc_id
    stays null; other columns are ignored; no rows give no rows. One pass without a shuffle.
    """
    return map_batches(columns(docs, doc_id="long", text="string"), _judge(bands or Bands()), RULES)


def keep_good(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    bands = bands or Bands()
    place = docs.columns.index("text")
    judge = _judge(bands)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        narrow = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(place)], ["doc_id", "text"])
        return batch.filter(judge(narrow).column("kept"))

    return map_batches(docs, work, docs.schema)
