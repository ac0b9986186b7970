"""Pair merging over the distinct words of a corpus, with counts kept up by what each round changes.

Words stay distributed, as flat arrays of symbol numbers: two bytes a symbol while numbers allow, and a count a word. A
round looks for the first symbols of its pairs, and works on what is around the matches only. The driver holds the frontier: the exact counts of the most
frequent pairs. A round merges several pairs at once, and every partition answers with the pair counts that changed,
so no round counts all pairs again. Which pairs go together is decided so that the result is the sequential one:

* a pair that overlaps one already taken (its first symbol ends that one, or its last begins it) waits, since the
  merge changes its count;
* a pair made new by a merge, as ``(x, ab)``, is at most as frequent as the pair ``(x, a)`` it comes from, which waits
  too and so ranks below all that is taken; at equal counts the names decide, and a pair waits if a new one may
  come before it;
* merges of equal symbols, and merges into a token that is there already, end a round.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from textmill.operators.splitting import characters, gathered
from textmill.session import shared_folder

# Pairs held by the driver, pairs looked at for a round, rounds between two checkpoints.
FRONTIER, LOOK, CHECKPOINT = 50_000, 256, 16
LOW = (1 << 32) - 1
# The symbol behind each word: number 0, which has no name.
END = ""
Packed = tuple[np.ndarray, np.ndarray]


def merged_name(a: str, b: str) -> str:
    return a + b.removeprefix("##")


def _kind(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def _pack(names: list[str]):
    """Words and counts as flat arrays: symbol numbers with 0 behind each word, and a count for each word."""
    forms = sorted((ord(name[-1]) << 1 | (len(name) > 1), i) for i, name in enumerate(names) if name != END)
    keys, numbers = (np.array(c, dtype=np.int64) for c in zip(*forms, strict=True)) if forms else (np.empty(0, np.int64),) * 2
    kind = _kind(len(names))

    def packed(words: pa.Array, n: np.ndarray) -> list[bytes]:
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        later = np.ones(size.sum(), dtype=np.int64)
        later[(np.cumsum(size) - size)[size > 0]] = 0
        found = numbers[np.searchsorted(keys, characters(words).astype(np.int64) << 1 | later)] if len(later) else later
        symbols = np.zeros(len(found) + len(size), dtype=kind)
        symbols[np.arange(len(found)) + np.repeat(np.arange(len(size)), size)] = found
        return [symbols.tobytes(), n.astype("<i8").tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            made = packed(batch.column("word"), batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], ["symbols", "counts"])

    return run


def _summed(keys: np.ndarray, values: np.ndarray) -> Packed:
    """Each key once, in order, with the sum of its values."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def _keys(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    return symbols[at].astype(np.int64) << 32 | symbols[at + 1].astype(np.int64)


def _pairs(symbols: np.ndarray, ends: np.ndarray, counts: np.ndarray, at: np.ndarray) -> Packed:
    """Keys and counts of the pairs that begin at ``at``, one for each place. ``ends``: where words end."""
    at = at[(at >= 0) & (at < len(symbols) - 1)]
    at = at[(symbols[at] > 0) & (symbols[at + 1] > 0)]
    return _keys(symbols, at), counts[np.searchsorted(ends, at)]


def all_pairs(packed: Packed) -> Packed:
    symbols, counts = packed
    return _summed(*_pairs(symbols, np.flatnonzero(symbols == 0), counts, np.arange(len(symbols) - 1)))


def merge(packed: Packed, batch: list[tuple[int, int, int]]) -> tuple[Packed, Packed]:
    """The arrays with all pairs of ``batch`` (first, second, merged) merged, and how pair counts changed."""
    symbols, counts = packed
    token = {(a << 32) | b: t for a, b, t in batch}
    wanted = np.array(sorted(token), dtype=np.int64)
    merged = np.array([token[k] for k in wanted.tolist()], dtype=np.int64)
    known = np.iinfo(symbols.dtype).max
    opens = np.zeros(known + 1 if known < 1 << 16 else int(symbols.max(initial=0)) + 1, dtype=bool)
    opens[[a for a, _, _ in batch if a < len(opens)]] = True
    hit = np.flatnonzero(opens[symbols[:-1]])
    keys = _keys(symbols, hit)
    place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    same = wanted[place] == keys
    hit, place = hit[same], place[same]
    if not len(hit):
        return packed, _summed(*(np.empty(0, np.int64),) * 2)
    # Only equal symbols match twice in a row: of such a row every other match holds, from the left.
    run = np.concatenate([[True], np.diff(hit) != 1])
    first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
    held = (np.arange(len(hit)) - first) % 2 == 0
    hit, place = hit[held], place[held]
    ends = np.flatnonzero(symbols == 0)
    before = _pairs(symbols, ends, counts, np.unique(np.concatenate([hit - 1, hit, hit + 1])))
    symbols = symbols.astype(max(symbols.dtype, np.dtype(_kind(int(merged.max())))))
    symbols[hit] = merged[place]
    keep = np.ones(len(symbols), dtype=bool)
    keep[hit + 1] = False
    at = hit - np.arange(len(hit))  # each merge before has taken one place away
    symbols, ends = symbols[keep], ends - np.searchsorted(hit, ends)
    after = _pairs(symbols, ends, counts, np.unique(np.concatenate([at - 1, at])))
    changes = _summed(np.concatenate([before[0], after[0]]), np.concatenate([-before[1], after[1]]))
    return (symbols, counts), changes


def _added(a: Packed, b: Packed) -> Packed:
    return _summed(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))


class Frontier:
    """Exact counts of all pairs more frequent than ``floor``; the symbols' names, which decide ties."""

    def __init__(self, names: list[str]):
        self.names, self.number = names, {n: i for i, n in enumerate(names)}
        self.counts: dict[int, int] = {}
        self.floor, self.stale = 0, True

    def order(self, item: tuple[int, int]) -> tuple[int, str, str]:
        return -item[1], self.names[item[0] >> 32], self.names[item[0] & LOW]

    def refill(self, found: list[tuple[int, int]], complete: bool) -> None:
        self.floor = 0 if complete else found[-1][1]
        self.counts = {k: n for k, n in found if n > self.floor}
        if not self.counts and found:
            # All share one count: the first of them is the best there is.
            self.counts, self.floor = dict(found[:1]), found[0][1] - 1
        self.stale = False

    def batch(self, most: int) -> list[tuple[int, int, str, int]]:
        """Pairs that the sequential algorithm merges next, in its order: (first, second, token, count)."""
        # By count first, which is quick; only pairs as frequent as the last of them are put in order.
        least = min(heapq.nlargest(LOOK, self.counts.values()), default=0)
        top = sorted((item for item in self.counts.items() if item[1] >= least), key=self.order)[:LOOK]
        unseen = max(top[-1][1] if len(top) == LOOK else 0, self.floor)
        taken: list[tuple[int, int, str, int]] = []
        begins: dict[int, list[str]] = {}
        ends: dict[int, list[str]] = {}
        for i, (key, n) in enumerate(top):
            a, b = key >> 32, key & LOW
            token = merged_name(self.names[a], self.names[b])
            ends_round = a == b or token in self.number
            if taken and (
                ends_round or a in ends or b in begins or n <= unseen or any(token == t[2] for t in taken)
                or self._overtaken((self.names[a], self.names[b]), n, top[i + 1 :], begins, ends)
            ):
                break
            taken.append((a, b, token, n))
            begins.setdefault(a, []).append(token)
            ends.setdefault(b, []).append(token)
            if ends_round or len(taken) == most:
                break
        return taken

    def _overtaken(self, pair: tuple[str, str], n: int, later: list, begins: dict, ends: dict) -> bool:
        """Whether a pair made new from one of the same count may come before ``pair``."""
        for key, other in later:
            if other < n:
                return False
            c, d = key >> 32, key & LOW
            lefts, rights = ends.get(c, []), begins.get(d, [])
            new = [(x, y) for x in [self.names[c], *lefts] for y in [self.names[d], *rights]][1:]
            if new and min(new) < pair:
                return True
        return False

    def update(self, changes: Packed, fresh: set[int]) -> None:
        for key, change in zip(changes[0].tolist(), changes[1].tolist(), strict=True):
            if key in self.counts:
                self.counts[key] += change
                if self.counts[key] <= self.floor:
                    del self.counts[key]
            elif change > 0:
                if key >> 32 in fresh or key & LOW in fresh:
                    if change > self.floor:
                        self.counts[key] = change
                elif self.floor:
                    self.stale = True  # an old pair has grown, and what it had is not known here
                else:
                    self.counts[key] = change
        if len(self.counts) > 4 * FRONTIER:
            kept = heapq.nlargest(FRONTIER, self.counts.values())[-1]
            self.floor = max(self.floor, kept)
            self.counts = {k: n for k, n in self.counts.items() if n > self.floor}


def learn_merges(counts: DataFrame, symbols: DataFrame, size: int | None = None, merges: int | None = None) -> list[tuple]:
    """(a, b, token, n) of each merge over ``counts`` (word, n), in the order of the sequential algorithm.

    Stops at ``size`` different symbols (those of ``symbols`` and merged ones) or ``merges`` merges, or when no pair
    is left. ``symbols``: (token), the first symbols. Lost partitions are made again from the last checkpoint.
    """
    spark = counts.sparkSession
    context = spark.sparkContext
    shared_folder(spark)
    frontier = Frontier([END, *sorted(r.token for r in symbols.select("token").distinct().collect())])
    known, out = len(frontier.names) - 1, []
    # A partition for each core: every round runs all of them, and a partition may have any number of arrays.
    cores = max(context.defaultParallelism, 1)
    rows = counts.select("word", F.col("n").cast("bigint")).repartition(cores, "word")
    kind = _kind(len(frontier.names))
    packed = rows.mapInArrow(_pack(frontier.names), "symbols binary, counts binary").rdd.map(
        lambda r: (np.frombuffer(r.symbols, dtype=kind), np.frombuffer(r.counts, dtype="<i8"))
    )
    state = stored = packed.coalesce(cores).persist(StorageLevel.MEMORY_AND_DISK)
    empty = (np.empty(0, np.int64), np.empty(0, np.int64))
    rounds = 0
    while (size is None or known < size) and (merges is None or len(out) < merges):
        if frontier.stale or (frontier.floor and not frontier.counts):
            names = context.broadcast(frontier.names)
            totals = state.flatMap(lambda p: zip(*(x.tolist() for x in all_pairs(p)), strict=True)).reduceByKey(lambda a, b: a + b)
            found = totals.takeOrdered(FRONTIER, lambda kv: (-kv[1], names.value[kv[0] >> 32], names.value[kv[0] & LOW]))
            frontier.refill(found, len(found) < FRONTIER)
        most = min(LOOK, *([size - known] if size else []), *([merges - len(out)] if merges else []))
        chosen = frontier.batch(most)
        if not chosen:
            break
        fresh, batch = set(), []
        for a, b, token, n in chosen:
            out.append((frontier.names[a], frontier.names[b], token, n))
            if token not in frontier.number:
                frontier.number[token] = len(frontier.names)
                frontier.names.append(token)
                fresh.add(frontier.number[token])
                known += 1
            batch.append((a, b, frontier.number[token]))
        stepped = state.map(lambda p, batch=batch: merge(p[:2], batch)).persist(StorageLevel.MEMORY_AND_DISK)
        rounds += 1
        if rounds % CHECKPOINT == 0:
            stepped.checkpoint()
        changed = stepped.map(lambda p: p[1])
        # Partial sums meet on executors where partitions are many; the sum is the same either way.
        wide = changed.getNumPartitions() > 64
        changes = changed.treeAggregate(empty, _added, _added) if wide else changed.fold(empty, _added)
        frontier.update(changes, fresh)
        stored.unpersist()  # the next one is there now
        state, stored = stepped.map(lambda p: p[0]), stepped
    stored.unpersist()
    return out
