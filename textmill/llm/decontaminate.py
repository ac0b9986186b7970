"""Benchmark decontamination by latent semantic retrieval.

Passages of all documents are weighed by term frequency and inverse document frequency over hashed words. A
randomised singular value decomposition of that matrix, with sums worked out where the texts are, gives each word a
latent vector; a passage's vector is the sum of its words'. Benchmark passages are searched for among windows of
their own length at every few words of every document, by cosine. What is near enough is compared word by word:
by the longest common subsequence with the passage, and for paraphrases by how much of its answer is there too.

Verbatim copies do not depend on the cosine, whose weights sink with each further copy. A stretch of text with enough
of an item's words in order misses few of them, so it has some of any few more: places of the item's rarest words,
looked up at every word of every document, lead to all such stretches.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.functions.stage import materialize
from textmill.llm.rows import columns, map_batches

FEATURE_BITS = 13
FEATURES = 1 << FEATURE_BITS
BLOCK = 1 << 20  # bytes worked on at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# Words are runs of ASCII letters and digits and of all bytes of other characters that ``plain`` leaves.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Settings:
    passage: int = 32  # words in a passage of the matrix
    rank: int = 64  # latent dimensions
    grid: int = 4  # windows begin and end at every fourth word
    lengths: tuple[int, ...] = (8, 12, 20, 28, 40, 60)  # words of the windows; longer items are cut
    emphasis: int = 3  # the power of the inverse document frequency that weighs a word
    negligible: float = 0.01  # words of less than this share of the greatest weight are left out of sums
    least_words: int = 4  # items of fewer words are found by exactly their words alone
    cosine: float = 0.6  # the least of a candidate
    overlap: float = 0.5  # and the least share of its item's weight that its words have
    verbatim: float = 0.8  # share of an item's words in order that is a copy
    inserted: float = 0.25  # share of an item's words that may stand between the words of a copy
    places: int = 3  # of an item's rarest words must be near each other before more is compared; excludes no copy
    places_at_once: int = 1 << 21
    paraphrase: float = 0.6  # and that is a paraphrase, if so much of the answer is there too:
    answer: float = 0.75
    answer_words: int = 8  # the end of an item, where it has no answer of its own
    items_at_once: int = 20_000
    seed: int = 11


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = BLOCK + 1
    ahead = np.full(n, _BASE)
    ahead[0] = 1
    inverse = pow(int(_BASE), -1, 1 << 64)
    back = np.full(n, np.uint64(inverse))
    back[0] = 1
    return np.multiply.accumulate(ahead), np.multiply.accumulate(back)


_tables: list[tuple[np.ndarray, np.ndarray]] = []
# Scripts without spaces between words: each character is a word.
_SPACELESS = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u1950-\u19df"
    "\u1a20-\u1a7f\u3005-\u3007\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\ua9e0-\ua9fe\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
_SPACELESS_CHARACTER = re.compile(f"([{_SPACELESS}])")
_BETWEEN = {"Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Zs", "Zl", "Zp", "Cc"}
_ASCII = bytes(range(0x80))


@functools.cache
def _between_words(c: str) -> bool:
    return unicodedata.category(c) in _BETWEEN or c in "\u200b\u2060\ufeff"


def plain(text: str) -> bytes:
    """Lower-case ``text`` in which spaces stand for all punctuation outside ASCII and around the characters of
    scripts that are written without spaces."""
    data = text.lower().encode()
    if not data.isascii():
        others = "".join(set(data.translate(None, _ASCII).decode()))
        for c in filter(_between_words, others):
            data = data.replace(c.encode(), b" ")
        if _SPACELESS_CHARACTER.search(others):
            data = _SPACELESS_CHARACTER.sub(r" \1 ", data.decode()).encode()
    return data


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words of lower-case ``data`` and where they begin."""
    if not _tables:
        _tables.append(_powers())
    ahead, back = _tables[0]
    hashes, starts, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + BLOCK)
        # A block ends where a word does, unless a word is longer than a block.
        cut = stop
        while stop < len(data) and cut > at and _IS_WORD[data[cut - 1]] and _IS_WORD[data[cut]]:
            cut -= 1
        stop = cut if cut > at else stop
        raw = np.frombuffer(data, dtype=np.uint8, count=stop - at, offset=at)
        inside = np.concatenate([[False], _IS_WORD[raw], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, end = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * ahead[: len(raw)])])
        h = (sums[end] - sums[first]) * back[first]
        h ^= h >> np.uint64(32)
        hashes.append((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32))
        starts.append(first + at)
        at = stop
    if not hashes:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def features_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)


Group = tuple[list[int], np.ndarray, np.ndarray]  # rows, their words' hashes, number of words of each row


def groups_of_texts(column: pa.Array) -> Iterator[Group]:
    """Texts in groups of about half a block; a longer text is a group of its own."""
    rows, data, held = [], [], 0

    def made() -> Group:
        hashes, starts = words_of(b"\n".join(data))
        counts = np.diff(np.concatenate([[0], np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data]))]))
        return rows, hashes, counts

    for i, text in enumerate(column.to_pylist()):
        if text:
            rows.append(i)
            data.append(plain(text))
            held += len(data[-1])
            if held >= BLOCK // 2:
                yield made()
                rows, data, held = [], [], 0
    if rows:
        yield made()


def groups_of_words(column: pa.Array) -> Iterator[Group]:
    """The same of texts whose words' hashes are stored."""
    rows, data, held = [], [], 0
    for i, words in enumerate(column.to_pylist()):
        if words:
            rows.append(i)
            data.append(words)
            held += len(words)
        if rows and (held >= BLOCK or i == len(column) - 1):
            yield rows, np.frombuffer(b"".join(data), dtype="<u4"), np.array([len(d) // 4 for d in data])
            rows, data, held = [], [], 0
    if rows:
        yield rows, np.frombuffer(b"".join(data), dtype="<u4"), np.array([len(d) // 4 for d in data])


def stored_words(docs: DataFrame) -> DataFrame:
    """(doc_id, words) of all rows, written once: every later pass reads hashes and no text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [b""] * batch.num_rows
        for rows, hashes, counts in groups_of_texts(batch.column("text")):
            ends = np.cumsum(counts)
            for row, a, b in zip(rows, (ends - counts).tolist(), ends.tolist(), strict=True):
                made[row] = hashes[a:b].tobytes()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "words"])

    coded = map_batches(columns(docs, doc_id="long", text="string"), work, "doc_id long, words binary")
    return materialize(coded, "words")


def passages(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The passage of each word (``size`` words of one text; a text's last may be shorter) and the first words."""
    ends = np.cumsum(counts)
    inner = np.arange(len(hashes)) - np.repeat(ends - counts, counts)
    first = inner % size == 0
    return np.cumsum(first) - 1, np.flatnonzero(first)


def document_frequencies(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """In how many passages each feature is, and how many passages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for _, hashes, counts in groups_of_words(batch.column("words")):
                if len(hashes):
                    of, first = passages(hashes, counts, settings.passage)
                    both = np.sort(of * FEATURES + features_of(hashes))
                    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
                    seen += np.bincount(both % FEATURES, minlength=FEATURES)
                    total += len(first)
        which = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*which.tolist(), -1], pa.int64()), pa.array([*seen[which].tolist(), total], pa.int64())], ["f", "n"]
        )

    frequency, total = np.zeros(FEATURES), 0
    for row in rows.select("words").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        if row.f < 0:
            total = row.n
        else:
            frequency[row.f] = row.n
    return frequency, total


def slots(lengths: np.ndarray, size: int) -> np.ndarray:
    """For pieces of ``lengths`` words, one behind the other, where each one's first, second, .. ``size``-th word
    stands: a row for each place, and past the last word where a piece is shorter."""
    ends = np.cumsum(lengths)
    at = (ends - lengths) + np.arange(size)[:, None]
    return np.where(at < ends, at, ends[-1] if len(ends) else 0)


def summed(vectors: np.ndarray, feature: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """The sum of the vectors of each piece's words, place by place. ``vectors`` ends with a row of zeros."""
    padded = np.append(feature, len(vectors) - 1)
    total = np.zeros((len(lengths), vectors.shape[1]), dtype=np.float32)
    for row in slots(lengths, size):
        total += np.take(vectors, padded[row], axis=0)
    return total


def with_zeros(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)


def weighted(hashes: np.ndarray, counts: np.ndarray, weight: np.ndarray, basis: np.ndarray, size: int):
    """For each passage of the matrix, scaled to length one: its product with ``basis``, its scale, and the passage
    and feature of each word that has a weight. ``basis`` comes multiplied by the weights, with a row of zeros."""
    of, _ = passages(hashes, counts, size)
    feature = features_of(hashes)
    heavy = weight[feature] > 0
    of, feature = of[heavy], feature[heavy]
    new = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.empty(0, bool)
    nth = np.cumsum(new) - 1
    lengths = np.bincount(nth) if len(nth) else np.empty(0, np.int64)
    scale = 1 / np.sqrt(np.bincount(nth, weights=weight[feature] ** 2)) if len(nth) else np.empty(0)
    return summed(basis, feature, lengths, size) * scale[:, None].astype(np.float32), scale, nth, feature


def range_of(rows: DataFrame, weight: np.ndarray, basis: np.ndarray, settings: Settings) -> np.ndarray:
    """The matrix's transpose times the matrix times ``basis``: a row for each feature, summed over all tasks."""
    rank, heavy = basis.shape[1], with_zeros(basis * weight[:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, FEATURES))
        for batch in batches:
            for _, hashes, counts in groups_of_words(batch.column("words")):
                if len(hashes):
                    made, scale, of, feature = weighted(hashes, counts, weight, heavy, settings.passage)
                    if not len(made):
                        continue
                    made *= scale[:, None].astype(np.float32)
                    for j, column in enumerate(np.ascontiguousarray(made.T)):
                        total[j] += np.bincount(feature, weights=column[of], minlength=FEATURES)
        total *= weight
        which = np.flatnonzero(total.any(axis=0))
        if len(which):
            cells = [pa.array(which), *[pa.array(row[which]) for row in total]]
            yield pa.RecordBatch.from_arrays(cells, ["f", *[f"c{j}" for j in range(rank)]])

    names = [f"c{j}" for j in range(rank)]
    made = rows.select("words").mapInArrow(run, "f long, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((FEATURES, rank))
    for row in made.groupBy("f").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row.f] = row[1:]
    return out


def gram_of(rows: DataFrame, weight: np.ndarray, basis: np.ndarray, settings: Settings) -> np.ndarray:
    """The products of all columns of the matrix times ``basis`` with each other."""
    rank, heavy = basis.shape[1], with_zeros(basis * weight[:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            for _, hashes, counts in groups_of_words(batch.column("words")):
                if len(hashes):
                    made = weighted(hashes, counts, weight, heavy, settings.passage)[0]
                    total += made.T @ made
        i, j = np.divmod(np.arange(rank * rank), rank)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    out = np.zeros((rank, rank))
    made = rows.select("words").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for row in made.collect():
        out[row.i, row.j] = row.v
    return out


@dataclass(frozen=True)
class Latent:
    weight: np.ndarray  # of each feature; 0 if negligible
    vectors: np.ndarray  # of each feature, times its weight, scaled so that all dimensions count alike
    frequency: np.ndarray  # passages of each feature


def latent_words(rows: DataFrame, settings: Settings) -> Latent | None:
    """The decomposition's right singular vectors over the singular values, from all passages."""
    frequency, total = document_frequencies(rows, settings)
    if not total:
        return None
    weight = np.log((1 + total) / (1 + frequency) + 0.1) ** settings.emphasis
    weight = np.maximum(weight, 0)
    weight[weight < settings.negligible * weight.max()] = 0
    if not weight.any():  # every word is in every passage
        weight[:] = 1.0
    start = np.random.default_rng(settings.seed).normal(size=(FEATURES, settings.rank))
    basis = np.linalg.qr(range_of(rows, weight, start, settings))[0]
    values, turn = np.linalg.eigh(gram_of(rows, weight, basis, settings))
    kept = values > 1e-6 * values.max()
    vectors = ((basis @ turn[:, kept]) / np.sqrt(values[kept]) * weight[:, None]).astype(np.float32)
    return Latent(weight, vectors, frequency)


@dataclass(frozen=True)
class Item:
    item_id: int
    words: tuple[int, ...]
    answer: tuple[int, ...]


def common(a: tuple[int, ...], b: list[int]) -> int:
    """Length of the longest common subsequence, with the words of ``a`` as the bits of one number."""
    masks: dict[int, int] = {}
    for i, word in enumerate(a):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        met = row & masks.get(word, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def items_of(rows: list, settings: Settings) -> list[Item]:
    """Passages to search for: items of at most the longest window, and overlapping cuts of longer ones."""
    found, longest = [], settings.lengths[-1]
    for row in rows:
        words = tuple(words_of(plain(row.text or ""))[0].tolist())
        own = tuple(words_of(plain(row.answer or ""))[0].tolist())
        if not words:
            continue
        if len(words) <= 1.25 * longest:
            found.append(Item(row.item_id, words, own or words[-settings.answer_words :]))
            continue
        starts = [*range(0, len(words) - longest, longest // 2), len(words) - longest]
        for at in starts:
            part = words[at : at + longest]
            found.append(Item(row.item_id, part, own or part[-settings.answer_words :]))
    return found


class Search:
    """Benchmark passages by window length, ready to be looked for in texts."""

    def __init__(self, items: list[Item], latent: Latent, settings: Settings):
        self.latent, self.settings, self.by, self.vectors = latent, settings, [], with_zeros(latent.vectors)
        self.items = items
        self.held = np.zeros((len(items), FEATURES // 8), dtype=np.uint8)  # a bit for each feature
        for row, item in zip(self.held, items, strict=True):
            f = features_of(np.array(item.words, np.uint32))
            np.bitwise_or.at(row, f >> 3, (1 << (f & 7)).astype(np.uint8))
        sizes, lengths = np.array(settings.lengths), np.array([len(i.words) for i in items])
        nearest = np.array([np.abs(np.log(sizes / len(i.words))).argmin() for i in items])
        for k, size in enumerate(settings.lengths):
            which = np.flatnonzero((nearest == k) & (lengths >= settings.least_words))
            if len(which):
                own = [items[n] for n in which]
                features = [np.unique(features_of(np.array(i.words, np.uint32))) for i in own]
                vectors = np.stack([latent.vectors[features_of(np.array(i.words, np.uint32))].sum(axis=0) for i in own])
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                whole = np.array([latent.weight[f].sum() for f in features])
                self.by.append((size, own, vectors.T.copy(), which, whole))
        self.index_places()

    def index_places(self) -> None:
        """Words, and the items in which each is one of the rarest.

        A copy misses at most len - least of its item's words. So of any len - least + ``places`` places of the item it
        has ``places``, whichever are taken: the rarest are, which makes the search quick and never less whole.
        """
        s = self.settings
        lengths = np.array([len(i.words) for i in self.items])
        short = lengths < s.least_words
        self.least = np.where(short, lengths, [math.ceil(s.verbatim * n - 1e-9) for n in lengths])
        # The longest stretch that is a copy.
        self.reach = lengths + np.where(short, 0, lengths * s.inserted).astype(np.int64)
        self.places = np.minimum(self.least, s.places)
        words, items = [], []
        for n, item in enumerate(self.items):
            own = np.array(item.words, np.uint32)
            rarest = np.argsort(self.latent.frequency[features_of(own)], kind="stable")
            words.append(own[rarest[: len(own) - self.least[n] + self.places[n]]])
            items.append(np.full(len(words[-1]), n))
        words, items = np.concatenate(words), np.concatenate(items)
        order = np.argsort(words, kind="stable")
        self.keys, self.key_first, self.key_count = np.unique(words[order], return_index=True, return_counts=True)
        self.key_items = items[order]

    def seeds(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, items): each copy of an item has one of its words there, and enough of the item's words around it."""
        key = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[key] == hashes)
        key = key[at]
        ends, made, longest = np.cumsum(counts), np.cumsum(self.key_count[key]), int(self.reach.max())
        a = 0
        while a < len(at):
            # Of each part of the places, and what a copy that begins there has behind it.
            b = max(a + 1, int(np.searchsorted(made, (made[a - 1] if a else 0) + self.settings.places_at_once)))
            c = int(np.searchsorted(at, at[b - 1] + longest, "right"))
            many = self.key_count[key[a:c]]
            word = np.repeat(at[a:c], many)
            inner = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
            item = self.key_items[np.repeat(self.key_first[key[a:c]], many) + inner]
            order = np.argsort(item, kind="stable")
            word, item = word[order], item[order]
            text = np.searchsorted(ends, word, "right")
            later = np.arange(len(word)) + self.places[item] - 1
            fits = later < len(word)
            later = np.minimum(later, len(word) - 1)
            fits &= (item[later] == item) & (text[later] == text) & (word[later] - word < self.reach[item])
            fits &= word <= at[b - 1]
            word, item = word[fits], item[fits]
            if len(word):
                kept = np.concatenate([[True], (word[1:] != word[:-1]) | (item[1:] != item[:-1])])
                yield self.enough(hashes, counts, word[kept], item[kept])
            a = b

    def enough(self, hashes: np.ndarray, counts: np.ndarray, word: np.ndarray, item: np.ndarray):
        """Those seeds around which some stretch has as many words as a copy that are the item's, in any order."""
        ends, feature, good = np.cumsum(counts), features_of(hashes), []
        for i in range(0, len(word), 4096):
            w, n = word[i : i + 4096], item[i : i + 4096]
            text = np.searchsorted(ends, w, "right")
            reach, first, end = self.reach[n], (ends - counts)[text], ends[text]
            span = int(reach.max())
            at = w[:, None] + np.arange(1 - span, span)
            inside = (at >= first[:, None]) & (at < end[:, None])
            f = feature[np.clip(at, 0, len(feature) - 1)]
            met = inside & (self.held[n[:, None], f >> 3] >> (f & 7).astype(np.uint8) & 1).astype(bool)
            sums = np.concatenate([np.zeros((len(w), 1), np.int32), np.cumsum(met, axis=1, dtype=np.int32)], axis=1)
            begin = np.arange(span)  # of a stretch of at most ``span`` words with the seed's; it ends after ``reach``
            stop = np.minimum(begin + reach[:, None], sums.shape[1] - 1)
            most = (np.take_along_axis(sums, stop, axis=1) - sums[:, :span]).max(axis=1)
            good.append(most >= self.least[n])
        good = np.concatenate(good)
        return word[good], item[good]

    def copies(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int, Item, float]]:
        """(text, first word, end, item, cosine) of stretches that have enough of an item's words in order."""
        begins, ends = np.cumsum(counts) - counts, np.cumsum(counts)
        for word, item in self.seeds(hashes, counts):
            text = np.searchsorted(ends, word, "right")
            last = (-1, -1, 0)  # text, item and end of the copy found last; of a whole one, the text's end
            for t, w, n in zip(text.tolist(), word.tolist(), item.tolist(), strict=True):
                if last[:2] == (t, n) and w < last[2]:
                    continue
                own, reach, least = self.items[n].words, int(self.reach[n]), int(self.least[n])
                low, high = max(int(begins[t]), w - reach + 1), min(int(ends[t]), w + reach)
                near = hashes[low:high].tolist()
                if common(own, near) < least:
                    continue
                # From the stretch in which the seed is the item's word on.
                guess = w - low - (own.index(near[w - low]) if near[w - low] in own else 0)
                for k in sorted(range(w - low + 1), key=lambda k: abs(k - guess)):
                    if common(own, near[k : k + reach]) >= least:
                        a, b = low + k, min(low + k + reach, high)
                        made = self.latent.vectors[features_of(hashes[a : min(a + len(own), b)])].sum(axis=0)
                        other = self.latent.vectors[features_of(np.array(own, np.uint32))].sum(axis=0)
                        size = max(float(np.linalg.norm(made) * np.linalg.norm(other)), 1e-9)
                        yield t, a - int(begins[t]), b - int(begins[t]), self.items[n], float(made @ other) / size
                        whole = common(own, near[k : k + reach]) == len(own)
                        last = (t, n, int(ends[t]) if whole else b)
                        break

    def candidates(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int, Item, float]]:
        """(text, first word, end, item, cosine) of windows near an item that have enough of its weight; words count
        from the text's first."""
        grid, ends = self.settings.grid, np.cumsum(counts)
        feature = features_of(hashes)
        cells = -(-counts // grid)
        cell_ends = np.cumsum(cells)
        nth = np.arange(cells.sum()) - np.repeat(cell_ends - cells, cells)
        lengths = np.minimum(np.repeat(counts, cells) - nth * grid, grid)
        cell = np.ascontiguousarray(summed(self.vectors, feature, lengths, grid).T)
        # Sums run along memory, row by row; a group of texts has too few cells to lose digits that matter.
        sums = np.zeros((len(lengths) + 1, len(cell)), dtype=np.float32)
        sums[1:] = np.cumsum(cell, axis=1).T
        for size, own, vectors, which, whole in self.by:
            span = size // grid
            step = max(1, span // 8)
            many = np.maximum(-(-(cells - span) // step) + 1, 1) * (cells > 0)
            owner = np.repeat(np.arange(len(counts)), many)
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            # The last window of a text ends with it.
            first = np.maximum(np.minimum(nth * step, cells[owner] - span), 0)
            end = np.minimum(first + span, cells[owner])
            base = (cell_ends - cells)[owner]
            for i in range(0, len(owner), 16384):
                part = slice(i, i + 16384)
                made = np.take(sums, (base + end)[part], axis=0)
                made -= np.take(sums, (base + first)[part], axis=0)
                made /= np.maximum(np.sqrt(np.einsum("ij,ij->i", made, made))[:, None], 1e-9)
                w, q = np.nonzero(made @ vectors >= self.settings.cosine)
                if not len(w):
                    continue
                cosine = np.einsum("ij,ij->i", made[w], vectors.T[q])
                text, a, b = owner[i + w], first[i + w] * grid, np.minimum(end[i + w] * grid, counts[owner[i + w]])
                at = (ends - counts)[text] + a
                got = np.zeros(len(w))
                for j in range(size):
                    f = feature[np.minimum(at + j, len(feature) - 1)]
                    met = (self.held[which[q], f >> 3] >> (f & 7).astype(np.uint8) & 1).astype(bool) & (a + j < b)
                    got += met * self.latent.weight[f]
                for k in np.flatnonzero(got >= self.settings.overlap * whole[q]):
                    yield int(text[k]), int(a[k]), int(b[k]), own[q[k]], float(cosine[k])

    def best(self, groups: Iterator[Group]) -> dict[int, tuple[float, float, int]]:
        """Row: (share of the item's words in order, cosine, item) of the best confirmed candidate."""
        s, found = self.settings, {}
        for rows, hashes, counts in groups:
            if not len(hashes):
                continue
            begins = np.cumsum(counts) - counts
            held: dict[int, list[int]] = {}
            for t, first, end, item, cosine in chain(self.candidates(hashes, counts), self.copies(hashes, counts)):
                if t not in held:
                    held[t] = hashes[begins[t] : begins[t] + counts[t]].tolist()
                reach = len(item.words) // 2 + 2
                near = held[t][max(0, first - reach) : end + reach]
                share = common(item.words, near) / len(item.words)
                if share < s.paraphrase or share < s.verbatim and common(item.answer, near) < s.answer * len(item.answer):
                    continue
                option = (share, cosine, -item.item_id)
                if rows[t] not in found or option > found[rows[t]]:
                    found[rows[t]] = option
        return {row: (share, cosine, -item) for row, (share, cosine, item) in found.items()}


def searches(words: DataFrame, benchmark: DataFrame, settings: Settings) -> list[Search]:
    """One search for each block of items, so that what the driver and a task hold of the benchmark is bounded."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")
    ).where("item_id is not null and text is not null")
    latent = latent_words(words, settings)
    blocks, made = -(-items.count() // settings.items_at_once), []
    for b in range(blocks if latent is not None else 0):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if found := items_of(mine, settings):
            made.append(Search(found, latent, settings))
    return made


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """For each row of ``docs`` (doc_id, text) whether it holds a passage of ``benchmark`` (item_id, text and, if it
    is there, answer), and the best one's item_id, share of its words in order and cosine (else null).

    Items of one to three words are in a row if exactly these words are, one behind the other; an item without words
    (nothing but white space and punctuation) is in none. Null and empty texts are clean; repeated rows are judged
    alike; a null doc_id stays; ties take the least item_id; other columns are ignored; no rows give no rows and no
    items leave all clean. Documents are never shuffled: texts are read once, and four passes over their words' hashes
    sum up statistics or search, with one more for each further block of items.
    """
    words, names = stored_words(docs), ("item_id", "word_share", "cosine")
    kinds = ("long", "double", "double")
    found = words.select("*", *[F.lit(None).cast(t).alias(n) for n, t in zip(names, kinds, strict=True)])

    def step(search: Search):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = [batch.column(c).to_pylist() for c in ("word_share", "cosine", "item_id")]
            new = [None if s is None else (s, c, i) for s, c, i in zip(*old, strict=True)]
            for row, option in search.best(groups_of_words(batch.column("words"))).items():
                if new[row] is None or (option[0], option[1], -option[2]) > (new[row][0], new[row][1], -new[row][2]):
                    new[row] = option
            share, cosine, item = ([None if x is None else x[k] for x in new] for k in range(3))
            made = [pa.array(item, pa.int64()), pa.array(share, pa.float64()), pa.array(cosine, pa.float64())]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("words"), *made], ["doc_id", "words", *names])

        return work

    schema = "doc_id long, words binary, item_id long, word_share double, cosine double"
    for search in searches(words, benchmark, settings or Settings()):
        found = map_batches(found, step(search), schema)
    return found.select("doc_id", F.col("item_id").isNotNull().alias("contaminated"), *names)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The clean rows of ``docs``, with all their columns."""
    where = docs.columns.index("text")
    left = docs

    def step(search: Search):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[list(search.best(groups_of_texts(batch.column(where))))] = False
            return batch.filter(pa.array(clean))

        return work

    for search in searches(stored_words(docs), benchmark, settings or Settings()):
        left = map_batches(left, step(search), docs.schema)
    return left
