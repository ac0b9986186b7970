"""Packing lines into examples over a stream: a state per document, and many documents to a key of the store."""

from __future__ import annotations

import hashlib
import pickle
import struct
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textmill.operators.packing import assemble, split_segments
from textmill.operators.pieces import lengths, listed

LINE = "line_no int, ids array<int>"
OUTPUT = f"doc_id bigint, max_len int, ex int, target int, lines array<struct<{LINE.replace(' ', ':')}>>".replace(",:", ",")
HEAD = "turn int, ex int, target int, tokens int, last int, kept int, held int, touched long"
# Lines ahead of their turn lie together by so many numbers, so that the state is not asked for each of them.
SPAN = 64
MINUTE = 60_000
# Keys of the store. Each call of it, and each key that a batch touches, costs as much as packing many lines.
BUCKETS = 1 << 13
# Bytes of a document's waiting lines that are kept with its bucket; where there are more, they lie apart.
NEAR = 1 << 16
NO_ID = -(1 << 31)  # stands for a null among numbers
HEADER = np.dtype([("doc", "<i8"), ("i", "<i4"), ("line_no", "<i4"), ("flags", "u1")])
OPENED = struct.Struct("<qiiB")  # the same
LAST, NO_LINE, NO_DOC = 1, 2, 4
FLAT = "doc_id bigint, max_len int, ex int, target int, numbers binary, ends binary, ids binary"


def draw(seed: int, tag: str, *keys) -> float:
    text = ":".join([str(seed), tag, *map(str, keys)])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0


def target(seed: int, doc: int, max_len: int, first: int) -> int:
    if draw(seed, "short", doc, max_len, first) < 0.05:
        return 5 + int(draw(seed, "target", doc, max_len, first) * (max_len - 4))
    return max_len


class LinePacker(StatefulProcessor):
    """State of a document: where packing stands, the lines of the example that is open, lines ahead of their turn.

    All of it lies in the state store (RocksDB) and is brought in only for documents that a batch touches. Each call
    of the store costs as much as packing many lines, so ``kept`` and ``held`` say how many lines the open example and
    the spans of waiting lines have, and nothing is asked for that is not there.
    """

    none: list | bytes = []  # ids of a line without any

    def __init__(self, max_len: int, seed: int, idle_ms: int, keep_ms: int):
        self.max_len, self.seed, self.idle_ms, self.keep_ms = max_len, seed, idle_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", HEAD)
        self.open = handle.getListState("open", LINE)
        self.waiting = handle.getMapState("waiting", "span int", f"lines array<struct<i:int,{LINE.replace(' ', ':').replace(',:', ',')}>>")
        # A document that is done is remembered for a while, so that lines sent again do not begin it anew.
        self.done = handle.getValueState("done", "done boolean", self.keep_ms)

    def _span(self, number: int) -> dict[int, tuple]:
        value = self.waiting.getValue((number,)) if self.waiting.containsKey((number,)) else None
        return {i: (line_no, ids) for i, line_no, ids in value[0]} if value else {}

    def _walk(self, doc: int, head: tuple, arrived: dict, ended: bool) -> Iterator[Row]:
        """Pack the lines whose turn it is; with ``ended`` also across gaps, and let go of what is left."""
        turn, ex, goal, tokens, last, kept, waits, touched = head
        known = touched >= 0
        taken: list[tuple] | None = None
        spans: dict[int, dict[int, tuple]] = {}  # those brought in
        fresh: dict[int, dict[int, tuple]] = {}
        for i, line in arrived.items():
            fresh.setdefault(i // SPAN, {})[i] = line
        changed = set(fresh)

        def span(number: int) -> dict[int, tuple]:
            if number not in spans:
                spans[number] = fresh.get(number, {}) | (self._span(number) if waits else {})
            return spans[number]

        while True:
            here = span(turn // SPAN)
            if turn not in here:
                numbers = {*fresh, *(k[0] for k in self.waiting.keys())} if ended and waits else set(fresh) if ended else set()
                ahead = next((m for m in (min((i for i in span(n) if i > turn), default=None) for n in sorted(numbers)) if m is not None), None)
                if ahead is None:
                    break
                turn = ahead
                continue
            line_no, ids = here.pop(turn)
            changed.add(turn // SPAN)
            if taken is None:
                taken = [tuple(line) for line in self.open.get()] if kept else []
            taken.append((line_no, ids))
            tokens += self._size(ids)
            if tokens >= goal:
                yield self._example(doc, ex, goal, taken)
                ex, tokens, taken = ex + 1, 0, []
                goal = target(self.seed, doc, self.max_len, turn + 1)
            turn += 1
            if turn - 1 == last:
                ended = True
        if ended:
            rest = [tuple(line) for line in self.open.get()] if taken is None and kept else taken or []
            if tokens > 0:
                yield self._example(doc, ex, goal, rest)
            if known:
                self.head.clear()
                self.handle.deleteTimer(touched + self.idle_ms)
            if kept:
                self.open.clear()
            if waits:
                self.waiting.clear()
            self.done.update((True,))
            return
        held = waits
        for number in sorted(changed):
            lines = span(number)
            if lines:
                self.waiting.updateValue((number,), ([(i, *lines[i]) for i in sorted(lines)],))
                held = True
            elif waits and self.waiting.containsKey((number,)):
                self.waiting.removeKey((number,))
        if taken is not None:
            if taken:
                self.open.put(taken)
            elif kept:
                self.open.clear()
            kept = len(taken)
        if known:
            self.handle.deleteTimer(touched + self.idle_ms)
        self.handle.registerTimer(self.now + self.idle_ms)
        self.head.update((turn, ex, goal, tokens, last, kept, int(held), self.now))

    def _size(self, ids: list | bytes) -> int:
        return len(ids)

    def _example(self, doc: int, ex: int, goal: int, lines: list[tuple]) -> Row:
        return Row(doc_id=doc, max_len=self.max_len, ex=ex, target=goal, lines=[Row(line_no=n, ids=list(i)) for n, i in lines])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        doc = key[0]
        head = self.head.get()
        if head is None and self.done.exists():
            return
        self.now = timerValues.getCurrentProcessingTimeInMs()
        turn, ex, goal, tokens, last, kept, held, touched = (
            tuple(head) if head is not None else (0, 0, target(self.seed, doc, self.max_len, 0), 0, -1, 0, 0, -1)
        )
        arrived = {}
        for r in rows:
            if r.i >= turn:
                arrived.setdefault(r.i, (r.line_no, r.ids or self.none))
            if r.is_last:
                last = r.i
        yield from self._walk(doc, (turn, ex, goal, tokens, last, kept, held, touched), arrived, 0 <= last < turn)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        head = self.head.get()
        # Not a timer that input has put off.
        if head is not None and head[7] + self.idle_ms <= expiredTimerInfo.getExpiryTimeInMs():
            yield from self._walk(key[0], tuple(head), {}, True)

    def close(self) -> None:
        pass


class Line(NamedTuple):
    i: int
    line_no: int | None
    ids: bytes
    is_last: bool


class FlatPacker(LinePacker):
    """Lines whose ids are bytes, the first of which says how many each takes, and examples whose lines lie one behind the
    other, so that no id becomes an object."""

    none = b"\2"
    row = Row("doc_id", "max_len", "ex", "target", "numbers", "ends", "ids")

    def _size(self, ids: bytes) -> int:
        return (len(ids) - 1) // ids[0]

    def _example(self, doc: int, ex: int, goal: int, lines: list[tuple]) -> Row:
        n = len(lines)
        numbers = struct.pack(f"<{n}i", *[NO_ID if no is None else no for no, _ in lines])
        ends = struct.pack(f"<{n}i", *accumulate([self._size(ids) for _, ids in lines]))
        if all(ids[0] == 2 for _, ids in lines):
            whole = np.frombuffer(b"".join([ids[1:] for _, ids in lines]), "<u2").astype("<i4")
        else:
            whole = np.concatenate([np.frombuffer(ids, "<u2" if ids[0] == 2 else "<i4", offset=1).astype("<i4") for _, ids in lines])
        return self.row(doc, self.max_len, ex, goal, numbers, ends, whole.tobytes())


class Value:
    """A value of one document, for a packer to use like one of the state store."""

    value = None

    def exists(self) -> bool:
        return self.value is not None

    def get(self) -> object:
        return self.value

    def update(self, value: object) -> None:
        self.value = value

    put = update

    def clear(self) -> None:
        self.value = None


class Spans:
    """Spans of waiting lines of one document. Those ``near`` lie with it; of those ``far`` it has the numbers, and the
    store the lines."""

    def __init__(self, store):
        self.store, self.doc = store, None
        self.near: dict[int, list] = {}
        self.far: set[int] = set()

    def containsKey(self, key: tuple) -> bool:
        return key[0] in self.near or key[0] in self.far

    def getValue(self, key: tuple) -> tuple:
        if key[0] in self.near:
            return (self.near[key[0]],)
        return self.store.getValue((self.doc, key[0]))

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.near[key[0]] = value[0]

    def removeKey(self, key: tuple) -> None:
        self.near.pop(key[0], None)
        if key[0] in self.far:
            self.far.remove(key[0])
            self.store.removeKey((self.doc, key[0]))

    def keys(self) -> Iterator[tuple]:
        return iter([(number,) for number in {*self.near, *self.far}])

    def clear(self) -> None:
        for key in list(self.keys()):
            self.removeKey(key)

    def settle(self) -> None:
        """Moves the lines to the store if there are many."""
        if sum(len(ids) + 8 for lines in self.near.values() for _, _, ids in lines) > NEAR:
            for number, lines in self.near.items():
                self.store.updateValue((self.doc, number), (lines,))
            self.far |= set(self.near)
            self.near = {}


class BucketPacker(StatefulProcessor):
    """:class:`FlatPacker` for the documents of a bucket, whose states lie together in one value of the store, so that a
    batch asks for them once. Waiting lines of a long document lie apart.

    Documents have no timers of their own: the bucket has one, for the first time at which one of them is over or one that
    is done is forgotten. It is put forward where need be, but never back; one that comes too early does nothing.
    """

    def __init__(self, max_len: int, seed: int, idle_ms: int, keep_ms: int):
        self.packer, self.keep_ms = FlatPacker(max_len, seed, idle_ms, keep_ms), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.documents = handle.getValueState("documents", "timer long, documents binary")
        store = handle.getMapState("far", "doc long, span int", f"lines array<struct<i:int,{LINE.replace('array<int>', 'binary').replace(' ', ':').replace(',:', ',')}>>")
        p = self.packer
        p.handle, p.head, p.open, p.done, p.waiting = self, Value(), Value(), Value(), Spans(store)

    # What a packer asks of its handle.
    def registerTimer(self, due: int) -> None:
        self.due = due

    def deleteTimer(self, due: int) -> None:
        self.due = None

    def _document(self, documents: dict, doc: int, made: Iterator[Row], now: int) -> Iterator[Row]:
        """``made`` by the packer, with the state of a document brought in before and kept after."""
        p = self.packer
        p.head.value, p.open.value, p.waiting.near, p.waiting.far, self.due, over = documents.get(doc) or (None, None, {}, set(), None, None)
        p.waiting.doc, p.done.value = doc, True if over is not None and now < over else None
        known = p.done.value
        yield from made
        p.waiting.settle()
        if p.done.value and not known:
            over = now + self.keep_ms
        documents[doc] = p.head.value, p.open.value, p.waiting.near, p.waiting.far, self.due, over if p.done.value else None

    def _begun(self) -> tuple[int | None, dict]:
        value = self.documents.get()
        return (value[0], pickle.loads(value[1])) if value else (None, {})

    def _kept(self, timer: int | None, documents: dict, now: int) -> None:
        first = None
        for doc, (head, *_, due, over) in list(documents.items()):
            if head is None and (over is None or over <= now):
                del documents[doc]
                continue
            at = due if head is not None else over
            first = at if first is None or at < first else first
        if not documents:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.documents.clear()
            return
        if timer is None or first < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = first
            self.handle.registerTimer(timer)
        self.documents.update((timer, pickle.dumps(documents, pickle.HIGHEST_PROTOCOL)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        timer, documents = self._begun()
        now = timerValues.getCurrentProcessingTimeInMs()
        arrived: dict[int, list] = {}
        for r in rows:
            doc, line = _from_record(r[0])
            arrived.setdefault(doc, []).append(line)
        for doc, lines in arrived.items():
            yield from self._document(documents, doc, self.packer.handleInputRows((doc,), lines, timerValues), now)
        self._kept(timer, documents, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer, documents = self._begun()
        now, at = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        if timer != at:  # one that was put forward
            return
        for doc in [doc for doc, state in documents.items() if state[4] is not None and state[4] <= at]:
            yield from self._document(documents, doc, self.packer.handleExpiredTimer((doc,), timerValues, expiredTimerInfo), now)
        self._kept(None, documents, now)

    def close(self) -> None:
        pass


def _as_record(docs: pa.Array, i: pa.Array, line_no: pa.Array, is_last: pa.Array, lists: pa.Array) -> pa.Array:
    """Lines as bytes: :data:`HEADER`, then how many bytes an id has, 2 if all of the line's fit in them, then the ids.
    A worker takes one value a line out of Arrow, not one a column."""
    if i.null_count:
        raise ValueError("a line without a number")
    number = lambda x: pc.fill_null(x, 0).to_numpy(zero_copy_only=False)
    values = pc.fill_null(lists.flatten(), NO_ID).to_numpy(zero_copy_only=False)
    count = lengths(lists)
    row = np.repeat(np.arange(len(lists)), count)
    place = np.arange(len(values)) - np.repeat(np.cumsum(count) - count, count)
    wide = np.bincount(row[(values < 0) | (values >= 1 << 16)], minlength=len(lists)) > 0
    width = np.where(wide, 4, 2)
    ends = np.concatenate([[0], np.cumsum(HEADER.itemsize + 1 + count * width)])
    out = np.empty(int(ends[-1]), dtype=np.uint8)
    heads = np.empty(len(lists), dtype=HEADER)
    heads["doc"], heads["i"], heads["line_no"] = number(docs), number(i), number(line_no)
    heads["flags"] = number(is_last.cast(pa.uint8())) * LAST + line_no.is_null().to_numpy(zero_copy_only=False) * NO_LINE + docs.is_null().to_numpy(zero_copy_only=False) * NO_DOC
    out[ends[:-1, None] + np.arange(HEADER.itemsize)] = heads.view(np.uint8).reshape(-1, HEADER.itemsize)
    first = ends[:-1] + HEADER.itemsize
    out[first] = width
    for size, kind in ((2, "<u2"), (4, "<i4")):
        on = np.flatnonzero(width[row] == size)
        cells = first[row[on]] + 1 + place[on] * size
        out[cells[:, None] + np.arange(size)] = values[on].astype(kind).view(np.uint8).reshape(-1, size)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(ends, dtype="<i4")), pa.py_buffer(out)])


def _from_record(record: bytes) -> tuple[int | None, Line]:
    doc, i, line_no, flags = OPENED.unpack_from(record)
    line = Line(i, None if flags & NO_LINE else line_no, record[OPENED.size :], bool(flags & LAST))
    return None if flags & NO_DOC else doc, line


def _as_lines(numbers: pa.Array, ends: pa.Array, ids: pa.Array) -> pa.Array:
    """The lines of examples that lie one behind the other, as array<struct<line_no, ids>>."""
    joined = [np.frombuffer(b"".join(x.to_pylist()), "<i4") for x in (numbers, ends, ids)]
    lines, tokens = (np.concatenate([[0], np.cumsum(pc.binary_length(x).to_numpy(zero_copy_only=False) // 4)]) for x in (numbers, ids))
    upto = joined[1].astype(np.int64) + np.repeat(tokens[:-1], np.diff(lines))
    values = pa.array(joined[2], pa.int32(), mask=joined[2] == NO_ID)
    made = [pa.array(joined[0], pa.int32(), mask=joined[0] == NO_ID), listed(np.concatenate([[0], upto]), values)]
    return listed(lines, pa.StructArray.from_arrays(made, ["line_no", "ids"]))


def pack_lines_stream(
    lines: DataFrame, max_len: int = 128, seed: int = 0, idle_ms: int = 10 * MINUTE, keep_ms: int = 60 * MINUTE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, max_len, ex, target, lines) from a stream of (doc_id, i, line_no, ids, is_last), i counting from 0.

    Examples leave as soon as they are full. Lines that come before their turn are held until the gap closes; a line
    that came before (of one document and i) is left out. The last example leaves with the line marked ``is_last``.
    Where that mark or a line never comes, the document ends ``idle_ms`` after its last line came: what is there is
    packed in order, across the gaps. Lines of a document that is done are left out for ``keep_ms``; after that
    they would begin it anew. The state store has to be RocksDB (``textmill.session.configure`` sets it). Documents go
    to ``buckets`` keys of the store by a hash; a bucket's documents that are not done are brought in together.
    """
    columns = [F.col(c).cast(kind) for c, kind in (("doc_id", "bigint"), ("i", "int"), ("line_no", "int"), ("is_last", "boolean"), ("ids", "array<int>"))]
    coded = lines.select(
        F.arrow_udf(lambda *given: _as_record(*given), "binary")(*columns).alias("line"),
        F.pmod(F.xxhash64(columns[0]), F.lit(buckets)).alias("bucket"),
    )
    packed = coded.groupBy("bucket").transformWithState(
        BucketPacker(max_len, seed, idle_ms, keep_ms), FLAT, "append", "processingTime"
    )
    body = F.arrow_udf(lambda numbers, ends, ids: _as_lines(numbers, ends, ids), OUTPUT[OUTPUT.index("lines ") + 6 :])
    return packed.select("doc_id", "max_len", "ex", "target", body("numbers", "ends", "ids").alias("lines"))


def stream_examples(lines: DataFrame, cls: Column, sep: Column, max_len: int = 128, seed: int = 0, pad_id: int = 0, **options) -> DataFrame:
    """Finished examples (doc_id, max_len, ex, input_ids, input_mask, segment_ids) from a stream of encoded lines."""
    return assemble(split_segments(pack_lines_stream(lines, max_len, seed, **options), seed), cls, sep, pad_id)
