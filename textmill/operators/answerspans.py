"""Spans of windows as bytes, and the best pair of a start and an end of each, in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from textmill.operators.pieces import bounds, listed

RANKED = "struct<first:double,i:array<int>,v:array<double>>"
TOP = "struct<score:double,a:int,b:int,s:int,e:int>"
# Rows that are taken at once, so that a batch of long lists takes little memory beside them.
SIDE = 512
# A window's bytes begin with: how they are made, how many places there are, the first that has a span, how many have
# one, and the first character.
HEAD = np.dtype([("close", "u1"), ("n", "<i4"), ("first", "<i4"), ("count", "<i4"), ("s", "<i4")])


def _by_rows(body: Callable[[pa.Array], pa.Array], lists: pa.Array) -> pa.Array:
    return pa.concat_arrays([body(lists.slice(a, SIDE)) for a in range(0, max(len(lists), 1), SIDE)])


def _pack(offsets: pa.Array) -> pa.Array:
    """array<struct<s, e>> to bytes. Spans that stand together, in order and close to each other, take two bytes each:
    the gap before it and its length. Any other list is written out."""
    flat, ends = offsets.flatten(), bounds(offsets)
    there = flat.is_valid().to_numpy(zero_copy_only=False)
    s, e = (pc.struct_field(flat, name) for name in ("s", "e"))
    whole = (s.is_valid().to_numpy(zero_copy_only=False) & e.is_valid().to_numpy(zero_copy_only=False)) | ~there
    s, e = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (s, e))
    row = np.repeat(np.arange(len(offsets)), np.diff(ends))
    upto = np.concatenate([[0], np.cumsum(there)])
    count = upto[ends[1:]] - upto[ends[:-1]]
    inner = np.flatnonzero(there)
    at = upto[ends[:-1]]  # where a row's spans begin among all spans
    first = np.where(count > 0, np.append(inner, 0)[at] - ends[:-1], 0)
    together = np.where(count > 0, np.append(inner, 0)[np.maximum(at + count - 1, 0)] - ends[:-1] - first + 1, 0) == count
    begin, size = s[inner], e[inner] - s[inner]
    gap = begin - np.append(0, e[inner][:-1]) if len(inner) else begin
    opening = at[count > 0]
    start = np.zeros(len(offsets), dtype=np.int64)
    start[count > 0] = begin[opening]
    gap[opening] = 0
    near = (gap >= 0) & (gap < 256) & (size >= 0) & (size < 256)
    bad = np.bincount(row[~whole], minlength=len(offsets)) + np.bincount(row[inner][~near], minlength=len(offsets))
    close = together & (bad == 0)
    heads = np.zeros(len(offsets), dtype=HEAD)
    for name, values in zip(HEAD.names, (close, np.diff(ends), first, count, start), strict=True):
        heads[name] = values
    gap, size = gap.clip(0, 255).astype(np.uint8).tobytes(), size.clip(0, 255).astype(np.uint8).tobytes()
    heads, wide = heads.tobytes(), HEAD.itemsize
    valid = offsets.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for r, (a, n, ok, known) in enumerate(zip(at.tolist(), count.tolist(), close.tolist(), valid.tolist(), strict=True)):
        head = heads[r * wide : (r + 1) * wide]
        if not known:
            out.append(None)
        elif ok:
            out.append(head + gap[a : a + n] + size[a : a + n])
        else:
            spans = flat.slice(ends[r], ends[r + 1] - ends[r])
            sides = [pc.struct_field(spans, name) for name in ("s", "e")]
            out.append(head + b"".join(
                [spans.is_valid().to_numpy(zero_copy_only=False).tobytes()]
                + [x.is_valid().to_numpy(zero_copy_only=False).tobytes() for x in sides]
                + [pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype("<i4").tobytes() for x in sides]
            ))
    return pa.array(out, pa.binary())


def pack(offsets: str | Column) -> Column:
    """The ``offsets`` of windows as bytes, which :func:`best_pairs` reads: some two for each token, for 24 in a row."""
    return F.arrow_udf(lambda lists: _by_rows(_pack, lists), "binary")(F.col(offsets) if isinstance(offsets, str) else offsets)


class Spans:
    """Packed windows side by side."""

    def __init__(self, packed: pa.Array):
        texts = [t or b"" for t in packed.to_pylist()]
        wide = HEAD.itemsize
        head = np.frombuffer(b"".join(t[:wide].ljust(wide, b"\0") for t in texts), HEAD)
        self.n, self.first = head["n"].astype(np.int64), head["first"].astype(np.int64)
        self.close = head["close"].astype(bool)
        self.count = np.where(self.close, head["count"], 0).astype(np.int64)
        self.at = np.cumsum(self.count) - self.count
        count = self.count.tolist()
        gap = np.frombuffer(b"".join(t[wide : wide + c] for t, c in zip(texts, count, strict=True)), np.uint8).astype(np.int64)
        size = np.frombuffer(b"".join(t[wide + c : wide + 2 * c] for t, c in zip(texts, count, strict=True)), np.uint8).astype(np.int64)
        moved = np.concatenate([[0], np.cumsum(gap + size)])
        ahead = np.repeat(head["s"].astype(np.int64) - moved[self.at], self.count)
        self.e = moved[1:] + ahead
        self.s = self.e - size
        self.other = {}
        for r in np.flatnonzero(~self.close & (self.n > 0)).tolist():
            n, rest = int(self.n[r]), texts[r][wide:]
            flags = np.frombuffer(rest[: 3 * n], bool).reshape(3, n)
            self.other[r] = (*flags, *np.frombuffer(rest[3 * n :], "<i4").reshape(2, n))

    def look(self, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """For places (a line for each window, -1 for none): whether there is a span, whether its s and its e are known, s and e."""
        inner = places - self.first[:, None]
        there = (places >= 0) & (inner >= 0) & (inner < self.count[:, None])
        place = np.where(there, inner + self.at[:, None], len(self.s))
        s, e = np.append(self.s, 0)[place], np.append(self.e, 0)[place]
        has_s, has_e = there.copy(), there.copy()
        for r, (has, with_s, with_e, begin, end) in self.other.items():
            on = (places[r] >= 0) & (places[r] < len(has))
            p = np.where(on, places[r], 0)
            there[r], has_s[r], has_e[r] = on & has[p], on & has[p] & with_s[p], on & has[p] & with_e[p]
            s[r], e[r] = begin[p], end[p]
        return there, has_s, has_e, s, e


def _order(v: float | None) -> tuple:
    """Ascending: no value, NaN and all others from the greatest to the least, as Spark has it for what they are less than 0 by."""
    return (0, 0.0) if v is None else (2, 0.0) if math.isnan(v) else (1, -v)


def _rank(n_best: int, lists: pa.Array) -> pa.Array:
    """The first value of each list, and the places, ascending, and values of its ``n_best`` greatest; of equal ones the first."""
    flat, ends = lists.flatten(), bounds(lists)
    odd_value = ~flat.is_valid().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).astype(np.float64)
    odd_value |= ~np.isfinite(values)
    size = np.diff(ends)
    row = np.repeat(np.arange(len(lists)), size)
    odd = np.bincount(row[odd_value], minlength=len(lists)) > 0
    kept = np.zeros(len(values), dtype=bool)
    for n in np.unique(size[~odd]).tolist():
        some = np.flatnonzero(~odd & (size == n))
        cells = ends[some][:, None] + np.arange(n)
        if n <= n_best:
            kept[cells] = True
            continue
        table = values[cells]
        least = np.partition(table, n - n_best, axis=1)[:, n - n_best, None]
        chosen = table >= least
        for r in np.flatnonzero(chosen.sum(axis=1) > n_best).tolist():  # several that are equal to the last
            chosen[r] = False
            chosen[r, np.argsort(-table[r], kind="stable")[:n_best]] = True
        kept[cells] = chosen
    for r in np.flatnonzero(odd).tolist():
        some = flat.slice(ends[r], size[r]).to_pylist()
        best = sorted(range(len(some)), key=lambda i: (*_order(some[i]), i))[:n_best]
        kept[ends[r] + np.array(best, dtype=np.int64)] = True
    on = np.flatnonzero(kept)
    cut = np.searchsorted(on, ends)
    first = flat.take(pa.array(ends[:-1], mask=size == 0))
    made = [first, listed(cut, pa.array(on - ends[row[on]], pa.int32())), listed(cut, flat.take(pa.array(on)))]
    return pa.StructArray.from_arrays(made, ["first", "i", "v"], mask=lists.is_null())


def ranked(values: str, n_best: int) -> Column:
    """struct<first, i, v>: the first of a list of values, and its greatest ones with their places."""
    return F.arrow_udf(lambda lists: _by_rows(partial(_rank, n_best), lists), RANKED)(F.col(values).cast("array<double>"))


def _table(side: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of ranked lists, a line for each; place -1 fills up. Then whether a value of the line is null or not finite."""
    ends, count = bounds(side.field("i")), np.diff(bounds(side.field("i")))
    shape = len(side), max(int(count.max(initial=0)), 1)
    place, value, odd = np.full(shape, -1, dtype=np.int64), np.zeros(shape), np.zeros(shape, dtype=bool)
    on = np.arange(shape[1]) < count[:, None]
    given = side.field("v").flatten()
    place[on] = side.field("i").flatten().to_numpy(zero_copy_only=False)
    number = pc.fill_null(given, math.nan).to_numpy(zero_copy_only=False)
    value[on], odd[on] = number, ~np.isfinite(number)
    assert ends[-1] == len(given)
    return place, value, odd.any(axis=1)


def _one(starts: list, ends: list, max_answer: int) -> tuple | None:
    """The best pair of one row whose values may be null or not finite: (start, end, score). A score that is no number
    is above, one that is null below all others."""
    best = None
    for k, (i, a, has) in enumerate(starts):
        for m, (j, b, there) in enumerate(ends):
            if has and there and i <= j < i + max_answer:
                score = None if a is None or b is None else a + b
                key = ((0, 0.0) if score is None else (2, 0.0) if math.isnan(score) else (1, score)), -i, -j
                if best is None or key > best[0]:
                    best = key, k, m, score
    return best and best[1:]


def _best(max_answer: int, packed: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    made = []
    for a in range(0, max(len(packed), 1), SIDE):
        spans, left, right = Spans(packed.slice(a, SIDE)), starts.slice(a, SIDE), ends.slice(a, SIDE)
        left, right = (pa.StructArray.from_arrays([pc.struct_field(x, n) for n in ("i", "v")], ["i", "v"]) for x in (left, right))
        i, x, odd_x = _table(left)
        j, y, odd_y = _table(right)
        _, has, _, s, _ = spans.look(i)
        there, _, known, _, e = spans.look(j)
        fits = has[:, :, None] & there[:, None, :] & (j[:, None, :] >= i[:, :, None]) & (j[:, None, :] - i[:, :, None] < max_answer)
        score = np.where(fits, x[:, :, None] + y[:, None, :], -np.inf).reshape(len(i), i.shape[1] * j.shape[1])
        # Places ascend, so the first of equal scores has the first start, and then the first end.
        best = score.argmax(axis=1)
        line = np.arange(len(i))
        k, m, found = best // j.shape[1], best % j.shape[1], fits.any(axis=(1, 2))
        top = score[line, best]
        null = np.zeros(len(i), dtype=bool)
        for r in np.flatnonzero((odd_x | odd_y) & found).tolist():
            one = _one(*[
                [*zip(place[r].tolist(), side[r]["v"].as_py(), flag[r].tolist())]  # noqa: B905 (places that fill up have no value)
                for place, side, flag in ((i, left, has), (j, right, there))
            ], max_answer)
            k[r], m[r], null[r] = one[0], one[1], one[2] is None
            top[r] = math.nan if one[2] is None else one[2]
        b, c = i[line, k], j[line, m]
        columns = [
            pa.array(top, mask=null | ~found), pa.array(-b, pa.int32(), mask=~found), pa.array(-c, pa.int32(), mask=~found),
            pa.array(s[line, k], pa.int32(), mask=~found), pa.array(e[line, m], pa.int32(), mask=~(found & known[line, m])),
        ]
        made.append(pa.StructArray.from_arrays(columns, ["score", "a", "b", "s", "e"], mask=pa.array(~found)))
    return pa.concat_arrays(made)


def best_pairs(joined: DataFrame, packed: str, starts: str, ends: str, max_answer: int, out: str) -> DataFrame:
    """Adds ``out``: struct<score, a, b, s, e>, the best start and end of each window, as numbers below 0, and the
    characters they stand for; null without any. Of equal scores the first start counts, then the first end."""
    body = lambda *given: _best(max_answer, *given)
    return joined.withColumn(out, F.arrow_udf(body, TOP)(F.col(packed), F.col(starts), F.col(ends)))
