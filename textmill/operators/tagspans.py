"""Spans of IOB tags inside Arrow batches: a sentence's tags are one list, and its spans are found by array arithmetic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textmill.operators.pieces import bounds, listed


class Tags:
    """What distinct tags mean: outside (null too), beginning, and the number of their type."""

    def __init__(self, names: list[str | None]):
        self.types: dict[str, int] = {}
        self.outside = np.array([n is None or n == "O" for n in names], dtype=bool)
        self.begins = np.array([(n or "").startswith("B") for n in names], dtype=bool)
        self.type = np.array([self.types.setdefault((n or "")[2:], len(self.types)) for n in names], dtype=np.int64)

    def spans(self, tag: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where spans begin and their last tags; ``first``: tags that begin a sentence."""
        out = self.outside[tag]
        fresh, last = np.ones(len(tag), dtype=bool), np.ones(len(tag), dtype=bool)
        fresh[1:] = first[1:] | out[:-1] | (self.type[tag[1:]] != self.type[tag[:-1]])
        opens = ~out & (self.begins[tag] | fresh)
        last[:-1] = first[1:] | out[1:] | opens[1:]
        return np.flatnonzero(opens), np.flatnonzero(~out & last)


def _firsts(ends: np.ndarray) -> np.ndarray:
    first = np.zeros(ends[-1] + 1, dtype=bool)
    first[ends[:-1]] = True
    return first[:-1]


def row_spans(tags: pa.Array) -> pa.Array:
    """array<string> to array<struct<type, s, e>>: spans with the places of their first and last tags."""
    ends = bounds(tags)
    coded = tags.flatten().dictionary_encode(null_encoding="encode")
    known, tag = Tags(coded.dictionary.to_pylist()), coded.indices.to_numpy()
    s, e = known.spans(tag, _firsts(ends))
    row = np.searchsorted(ends, s, side="right") - 1
    types = pa.array(list(known.types), pa.string()).take(pa.array(known.type[tag[s]], pa.int64()))
    columns = [types, pa.array(s - ends[row], pa.int32()), pa.array(e - ends[row], pa.int32())]
    return listed(np.searchsorted(s, ends), pa.StructArray.from_arrays(columns, ["type", "s", "e"]), tags)


def row_matches(pred: pa.Array, ref: pa.Array) -> pa.Array:
    """Two array<string> of one length to struct<tp, n_pred, n_ref, hits, n>: spans that both have, spans of each, and
    tags that agree, of those whose reference is neither null nor -100."""
    flat = ref.flatten()
    used = pc.fill_null(pc.not_equal(flat, "-100"), False)
    kept = np.concatenate([[0], np.cumsum(used.to_numpy(zero_copy_only=False))])
    ends = kept[bounds(ref)]
    n = int(ends[-1])
    both = pa.concat_arrays([pred.flatten().filter(used), flat.filter(used)]).dictionary_encode(null_encoding="encode")
    known, tag = Tags(both.dictionary.to_pylist()), both.indices.to_numpy()
    first = _firsts(ends)
    (s0, e0), (s1, e1) = (known.spans(side, first) for side in (tag[:n], tag[n:]))
    last, kind = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    last[s0], kind[s0] = e0, known.type[tag[:n][s0]]
    common = s1[(last[s1] == e1) & (kind[s1] == known.type[tag[n:][s1]])]
    per_row = lambda places: np.diff(np.searchsorted(places, ends))
    columns = [per_row(common), per_row(s0), per_row(s1), per_row(np.flatnonzero(tag[:n] == tag[n:])), np.diff(ends)]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["tp", "n_pred", "n_ref", "hits", "n"])
