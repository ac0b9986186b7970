"""Language identification by a bidirectional gated recurrent network over bytes.

Text is cut into windows of UTF-8 bytes. In each window a minimally gated unit runs over the bytes in both
directions; from both states every byte position gets a probability for each language, and a document's
probabilities are the mean over all positions of all its windows. The network is trained here, in numpy, by
backpropagation through time on a bounded sample of windows; nothing but bytes goes into it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import columns, texts

PAD = 256
SYMBOLS = 257
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    window: int = 128  # bytes
    hidden: int = 8  # for each direction
    per_language: int = 400  # documents to learn from, in the mean; the bound on the sample
    windows_per_document: int = 3
    most_languages: int = 500  # more are an error: the sample and the output layer grow with them
    steps: int = 240  # batches, whatever the sample's size
    batch: int = 256
    rate: float = 0.02
    seed: int = 7


def cut(data: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``data`` as rows of symbols, padded at the end, and their lengths."""
    n = -(-len(data) // window)
    rows = np.full(n * window, PAD, dtype=np.int16)
    rows[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    lengths = np.full(n, window, dtype=np.int64)
    if n:
        lengths[-1] = len(data) - (n - 1) * window
    return rows.reshape(n, window), lengths


def both_ways(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols by time for both directions side by side, and where each position's backward step is.

    The backward direction begins at a window's last byte, so that padding always comes after the text. Its
    symbols are numbered from ``SYMBOLS`` on.
    """
    n, window = rows.shape
    mirror = lengths[:, None] - 1 - np.arange(window)
    mirror[mirror < 0] = window - 1
    back = np.take_along_axis(rows, mirror, axis=1)
    back[np.arange(window) >= lengths[:, None]] = PAD
    return np.ascontiguousarray(np.concatenate([rows, back + SYMBOLS]).T, dtype=np.int64), np.ascontiguousarray(mirror.T)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def squash(x: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """x / (1 + |x|), in place: a sigmoid shape that costs a tenth of tanh. ``size``: room for |x|."""
    size = np.abs(x, out=size)
    size += 1
    return np.divide(x, size, out=x)


class Network:
    """Weights: input tables and recurrences of the gate and of the candidate state, and the output layer."""

    def __init__(self, languages: list[str], settings: Settings):
        draw, h = np.random.default_rng(settings.seed), settings.hidden
        self.languages, self.hidden = languages, h
        scale = 1 / np.sqrt(h)
        self.w = {
            "gate": draw.normal(0, 0.3, (2 * SYMBOLS, h)), "state": draw.normal(0, 0.5, (2 * SYMBOLS, h)),
            "gate_u": draw.normal(0, scale, (2, h, h)), "state_u": draw.normal(0, scale, (2, h, h)),
            "out": draw.normal(0, scale, (2, h, len(languages))), "bias": np.zeros(len(languages)),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def states(self, symbols: np.ndarray) -> np.ndarray:
        """Hidden states [time, direction, window, hidden] for ``symbols`` [time, both directions' windows]."""
        time, both = symbols.shape
        h = self.hidden
        gate_in, gate_u, state_in, state_u = (self.w[k] for k in ("gate", "gate_u", "state", "state_u"))
        found = np.empty((time, 2, both // 2, h), dtype=np.float32)
        last = np.zeros((2, both // 2, h), dtype=np.float32)
        gate, made, size, given = (np.empty_like(last) for _ in range(4))
        given = given.reshape(both, h)
        flat_gate, flat_made = gate.reshape(both, h), made.reshape(both, h)
        for t in range(time):
            np.matmul(last, gate_u, out=gate)
            flat_gate += np.take(gate_in, symbols[t], axis=0, out=given, mode="clip")
            squash(gate, size)
            gate *= 0.5
            gate += 0.5
            now = found[t]
            np.multiply(gate, last, out=now)
            np.matmul(now, state_u, out=made)
            flat_made += np.take(state_in, symbols[t], axis=0, out=given, mode="clip")
            squash(made, size)
            made -= last
            made *= gate
            np.add(last, made, out=now)
            last = now
        return found

    def positions(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities [time, window, language] of every position; those of padding mean nothing."""
        symbols, mirror = both_ways(rows, lengths)
        return self._scores(self.states(symbols), mirror)

    def _scores(self, states: np.ndarray, mirror: np.ndarray) -> np.ndarray:
        ahead = states[:, 0] @ self.w["out"][0]
        back = states[:, 1] @ self.w["out"][1]
        return softmax(ahead + back[mirror, np.arange(mirror.shape[1])] + self.w["bias"])

    def window_sums(self, rows: np.ndarray, lengths: np.ndarray, block: int = 512) -> np.ndarray:
        """The sum of each window's position probabilities [window, language]."""
        sums = []
        for i in range(0, len(rows), block):
            part = lengths[i : i + block]
            chances = self.positions(rows[i : i + block], part)
            if (part != rows.shape[1]).any():
                chances *= (np.arange(rows.shape[1])[:, None] < part)[:, :, None]
            sums.append(chances.sum(axis=0))
        return np.concatenate(sums) if sums else np.zeros((0, len(self.languages)))

    def gradients(self, rows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions, by backpropagation through time."""
        symbols, mirror = both_ways(rows, lengths)
        time, both = symbols.shape
        n, h, w = both // 2, self.hidden, self.w
        hs = np.zeros((time + 1, 2, n, h), dtype=np.float32)
        hs[1:] = self.states(symbols)
        inside = np.arange(time)[:, None] < lengths
        wrong = self._scores(hs[1:], mirror)
        wrong[:, np.arange(n), labels] -= 1
        wrong *= inside[:, :, None] / inside.sum()
        # A backward step stands at the mirrored position; mirroring twice inside a window gives it back.
        turned = wrong[mirror, np.arange(n)] * inside[:, :, None]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["bias"] = wrong.sum(axis=(0, 1))
        g["out"][0] = np.einsum("tnh,tnl->hl", hs[1:, 0], wrong)
        g["out"][1] = np.einsum("tnh,tnl->hl", hs[1:, 1], turned)
        down = np.stack([wrong @ w["out"][0].T, turned @ w["out"][1].T], axis=1)
        carry = np.zeros((2, n, h), dtype=np.float32)
        to_gate, to_state = np.empty((time, both, h), np.float32), np.empty((time, both, h), np.float32)
        for t in range(time - 1, -1, -1):
            last = hs[t]
            open_ = squash(last @ w["gate_u"] + w["gate"][symbols[t]].reshape(2, n, h))
            gate = 0.5 * open_ + 0.5
            kept = gate * last
            made = squash(kept @ w["state_u"] + w["state"][symbols[t]].reshape(2, n, h))
            d = carry + down[t]
            d_made = d * gate * (1 - np.abs(made)) ** 2
            d_kept = d_made @ w["state_u"].transpose(0, 2, 1)
            d_gate = (d * (made - last) + d_kept * last) * 0.5 * (1 - np.abs(open_)) ** 2
            carry = d * (1 - gate) + d_kept * gate + d_gate @ w["gate_u"].transpose(0, 2, 1)
            g["state_u"] += kept.transpose(0, 2, 1) @ d_made
            g["gate_u"] += last.transpose(0, 2, 1) @ d_gate
            to_gate[t], to_state[t] = d_gate.reshape(both, h), d_made.reshape(both, h)
        flat = symbols.ravel()
        order = np.argsort(flat, kind="stable")
        seen, first = np.unique(flat[order], return_index=True)
        g["gate"][seen] = np.add.reduceat(to_gate.reshape(-1, h)[order], first)
        g["state"][seen] = np.add.reduceat(to_state.reshape(-1, h)[order], first)
        return g

    def train(self, rows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, settings: Settings) -> None:
        draw = np.random.default_rng(settings.seed)
        mean, square = {k: 0.0 for k in self.w}, {k: 0.0 for k in self.w}
        for step in range(settings.steps):
            pick = draw.integers(len(rows), size=settings.batch)
            g = self.gradients(rows[pick], lengths[pick], labels[pick])
            rate, n = settings.rate * (1 - step / settings.steps), step + 1
            for k, v in g.items():  # Adam
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                move = mean[k] / (1 - 0.9**n) / (np.sqrt(square[k] / (1 - 0.99**n)) + 1e-8)
                self.w[k] = (self.w[k] - rate * move).astype(np.float32)


def learn(labelled: DataFrame, settings: Settings | None = None) -> Network | None:
    """A network from (doc_id, text, lang), or None if no row has all three.

    Documents are drawn by a hash of doc_id so that each language gives ``per_language`` of them in the mean (all
    if it has fewer), and each gives up to ``windows_per_document`` windows. That bounds what the driver learns from.
    """
    settings = settings or Settings()
    rows = columns(labelled, doc_id="long", text="string", lang="string").dropna()
    counts = rows.groupBy("lang").count().limit(settings.most_languages + 1).collect()
    if len(counts) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    if not counts:
        return None
    shares = [x for row in counts for x in (F.lit(row["lang"]), F.lit(settings.per_language / row["count"]))]
    # Two draws of the hash are spent: the sample must not depend on the fold, which is another hash.
    uniform = F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(uniform < F.element_at(F.create_map(*shares), F.col("lang")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cells = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True)
            for doc_id, text, lang in cells:
                data = text.encode()
                n = -(-len(data) // settings.window)
                pick = np.random.default_rng([settings.seed, doc_id & 0xFFFFFFFF]).permutation(n)
                for k in pick[: settings.windows_per_document]:
                    out.append((doc_id, lang, data[k * settings.window : (k + 1) * settings.window]))
            if out:
                ids, langs, parts = zip(*out, strict=True)
                made = [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "lang", "part"])

    sample = drawn.mapInArrow(windows, "doc_id long, lang string, part binary").toArrow()
    sample = sorted(zip(*(sample.column(c).to_pylist() for c in ("doc_id", "lang", "part")), strict=True))
    if not sample:
        return None
    languages = sorted({lang for _, lang, _ in sample})
    cuts = [cut(part, settings.window) for _, _, part in sample]
    network = Network(languages, settings)
    labels = np.array([languages.index(lang) for _, lang, _ in sample])
    network.train(np.concatenate([c[0] for c in cuts]), np.concatenate([c[1] for c in cuts]), labels, settings)
    return network


def judge(network: Network | None, text: str, window: int) -> tuple[str, float]:
    return judge_all(network, [text], window)[0]


def judge_all(network: Network | None, many: list[str], window: int, bytes_at_once: int = 4 << 20) -> list[tuple[str, float]]:
    """(language, probability) of each text; a text without a letter, or without a network, is unknown.

    Windows of several texts run together; a very long text is added up in blocks of ``bytes_at_once``.
    """
    found, chances, sizes = [(UNKNOWN, 0.0)] * len(many), None, np.zeros(len(many))
    if network is None:
        return found
    chances = np.zeros((len(many), len(network.languages)))
    waiting: list[tuple[int, bytes]] = []

    def flush() -> None:
        cuts = [cut(data, window) for _, data in waiting]
        sums = network.window_sums(np.concatenate([c[0] for c in cuts]), np.concatenate([c[1] for c in cuts]))
        owners = np.repeat([i for i, _ in waiting], [len(c[1]) for c in cuts])
        np.add.at(chances, owners, sums)
        waiting.clear()

    held = 0
    for i, text in enumerate(many):
        if not any(map(str.isalpha, text)):
            continue
        data = text.encode()
        sizes[i] = len(data)
        for a in range(0, len(data), bytes_at_once - bytes_at_once % window):
            waiting.append((i, data[a : a + bytes_at_once - bytes_at_once % window]))
            held += len(waiting[-1][1])
            if held >= bytes_at_once:
                flush()
                held = 0
    if waiting:
        flush()
    for i in np.flatnonzero(sizes):
        best = int(chances[i].argmax())
        found[i] = network.languages[best], min(1.0, float(chances[i, best] / sizes[i]))
    return found


def held_out(docs: DataFrame) -> DataFrame:
    """Adds ``held_out``: whether crc32 of doc_id as text leaves 2 by 4. A row without doc_id is held out too."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return docs.withColumn("held_out", F.coalesce(fold == 2, F.lit(True)))


def identify(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text, lang), from its text alone.

    Learns from rows that are not held out and have a text and a language. ``und`` with score 0 stands for a null
    text, a text without a letter, and for all rows if there is nothing to learn from. Repeated rows are judged
    alike; other columns are ignored; no rows give no rows. The corpus is read three times and never shuffled.
    """
    settings = settings or Settings()
    rows = held_out(columns(docs, doc_id="long", text="string", lang="string"))
    network, window = learn(rows.where(~F.col("held_out")), settings), settings.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge_all(network, texts(batch.column("text")), window)
            made = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *made], ["doc_id", "held_out", "lang_pred", "score"]
            )

    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, schema)
