"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of tokens, its documents one after the other. Windows of ``window`` sequences are filled
in turn: every queue's deficit grows by its quantum, its target share of a window's tokens, and it serves as
many packets as its deficit covers and carries the rest into the next window. Documents are cut freely, so all
packets have ``grain`` tokens and a queue has served floor(k * quantum / grain) of them after k windows. This
closed form tells every task the deficits at any window without the windows before, so nothing runs in one
place, and deficits carry across windows and partitions alike. When a queue runs dry, the others' shares grow
in proportion; that begins a new phase, and there are at most as many phases as sources.

All tokens in window order are cut into sequences, so only the last one is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from textmill.functions.stage import materialize
from textmill.llm.rows import columns, texts
from textmill.llm.token_ids import id_encoder

CODED = "doc_id long, source string, part int, before long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "source string"
)


def coded_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of each document with the end id, its part of the corpus, and ``before``, the tokens of its source
    that stand before it in this part. Null texts are empty and null sources are one source. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, served, part = id_encoder(tokenizer), {}, TaskContext.get().partitionId()
        end = end_id.to_bytes(2, "little")
        for batch in batches:
            ids, before = [], []
            for source, text in zip(batch.column("source").to_pylist(), texts(batch.column("text")), strict=True):
                coded = encode(text) + end
                ids.append(coded)
                before.append(served.get(source, 0))
                served[source] = before[-1] + len(coded) // 2
            parts = pa.array([part] * batch.num_rows, pa.int32())
            made = [parts, pa.array(before, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), *made], ["doc_id", "source", "part", "before", "ids"]
            )

    rows = columns(docs, doc_id="long", source="string", text="string")
    return rows.mapInArrow(run, CODED)


@dataclass(frozen=True)
class Phase:
    """Windows in which the same queues are served."""

    quantum: tuple[float, ...]  # tokens a window for each source; 0 for dry queues
    low: tuple[int, ...]  # tokens of each source served in the phases before
    high: tuple[int, ...]  # and when this phase is over
    base: int  # tokens of all sources served before


class Mixture:
    """Where the tokens of each source go. ``grain``: tokens of a packet; only a queue's last one is smaller."""

    def __init__(
        self, sources: list[str | None], totals: list[int], weights: list[float], window: int, grain: int = 256
    ):
        self.place = {source: s for s, source in enumerate(sources)}
        self.grain, self.phases = grain, []
        low, base = [0] * len(totals), 0
        while base < sum(totals):
            wet = [n > done for n, done in zip(totals, low, strict=True)]
            live = sum(w for w, more in zip(weights, wet, strict=True) if more)
            quantum = [w / live * window if more else 0.0 for w, more in zip(weights, wet, strict=True)]
            grains = [-(-(n - done) // grain) for n, done in zip(totals, low, strict=True)]
            ends = [int(self.window_of(np.array([g - 1]), q)[0]) for g, q in zip(grains, quantum, strict=True) if q]
            windows = min(ends)
            high = [
                min(n, done + int(np.floor(windows * q / grain)) * grain)
                for n, done, q in zip(totals, low, quantum, strict=True)
            ]
            self.phases.append(Phase(tuple(quantum), tuple(low), tuple(high), base))
            low, base = high, sum(high)

    def window_of(self, grains: np.ndarray, quantum: float) -> np.ndarray:
        """The number of windows after which each grain of a queue has been served."""
        k = np.maximum(1, np.ceil((grains + 1) * (self.grain / quantum))).astype(np.int64)
        while (late := np.floor(k * quantum / self.grain) <= grains).any():
            k[late] += 1
        while (early := (k > 1) & (np.floor((k - 1) * quantum / self.grain) > grains)).any():
            k[early] -= 1
        return k

    def served(self, phase: Phase, k: np.ndarray) -> np.ndarray:
        """Tokens of each source (columns) served in ``phase`` after its first ``k`` windows (rows)."""
        whole = np.floor(k[:, None] * np.array(phase.quantum) / self.grain) * self.grain
        return np.minimum(whole, np.array(phase.high) - np.array(phase.low)).astype(np.int64)

    def runs(self, source: str | None, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(first token, tokens, place in the order of all tokens) of the runs that tokens [start, stop) of
        ``source`` are cut into: one for each window that serves some."""
        s = self.place[source]
        for phase in self.phases:
            low = phase.low[s]
            a, b = max(start, low), min(stop, phase.high[s])
            if a >= b:
                continue
            grains = np.arange((a - low) // self.grain, (b - 1 - low) // self.grain + 1, dtype=np.int64)
            windows = np.unique(self.window_of(grains, phase.quantum[s]))
            before, after = self.served(phase, windows - 1), self.served(phase, windows)
            opens = phase.base + before.sum(axis=1) + (after - before)[:, :s].sum(axis=1)
            for i in range(len(windows)):
                begin, end = max(a, low + int(before[i, s])), min(b, low + int(after[i, s]))
                yield begin, end - begin, int(opens[i]) + begin - low - int(before[i, s])


def place_pieces(coded: DataFrame, mixture: Mixture, length: int) -> DataFrame:
    """Pieces of the coded documents, which come with ``base``, the tokens of their source in parts before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in PIECES.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()]
        for batch in batches:
            out = []
            cells = (batch.column(c).to_pylist() for c in ("doc_id", "source", "before", "base", "ids"))
            for doc_id, source, before, base, ids in zip(*cells, strict=True):
                n, first = len(ids) // 2, before + base
                wide = memoryview(np.frombuffer(ids, dtype="<u2").astype("<u4")).cast("B")
                for a, many, at in mixture.runs(source, first, first + n):
                    a -= first
                    while many:
                        take = min(many, length - at % length)
                        crc = zlib.crc32(wide[4 * a : 4 * (a + take)])
                        out.append((doc_id, a, take, crc, n, at // length, at % length, source))
                        a, at, many = a + take, at + take, many - take
            if out:
                made = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(made, names)

    return coded.select("doc_id", "source", "before", "base", "ids").mapInArrow(run, PIECES)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = 1024, window: int = 64,
    targets: dict[str | None, float] | None = None, most_sources: int = 10_000,
) -> DataFrame:
    """Pieces of all documents (doc_id, text, source), placed in sequences of ``length`` tokens.

    ``targets``: shares of the sources; the corpus's own if not given, when all queues run dry together. Sources
    without a target come after those with one. ``window``: sequences in which the proportions hold to a packet.
    ``most_sources`` bounds what the driver holds, a total for each source; more are an error. Every
    document has at least its end id; repeated rows are packed each; no rows give no rows; a missing source
    column is an error. Documents are read once, in the order of their files.
    """
    coded = materialize(coded_documents(docs, tokenizer, end_id), "coded")
    sums = coded.groupBy("source", "part").agg(F.max(F.col("before") + F.length("ids") / 2).cast("long").alias("tokens"))
    sums = materialize(sums, "sums")
    found = sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).limit(most_sources + 1).collect()
    if len(found) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    found = sorted(((row.source, row.tokens) for row in found), key=lambda x: (x[0] is None, x[0]))
    sources, totals = [s for s, _ in found], [n for _, n in found]
    # A source without a target gets a share so small that it waits until the others are dry.
    weights = [float(n) for n in totals] if targets is None else [targets.get(s, 0) or 1e-12 for s in sources]
    mixture = Mixture(sources, totals, weights, length * window)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"),
        F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base"),
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    return place_pieces(coded.join(bases, same), mixture, length)
