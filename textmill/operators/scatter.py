"""Places chosen in lists and values put at places, for whole Arrow batches of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textmill.operators.pieces import bounds, lengths, listed


def candidates(ids: pa.Array, mask: pa.Array, ignore: pa.Array, disallow: pa.Array | None = None) -> pa.Array:
    """array<int>: the places where the mask is 1 and the id is known and none of the row's ``ignore``."""
    first, row = bounds(ids), np.repeat(np.arange(len(ids)), lengths(ids))
    place = np.arange(len(row)) - first[row]

    def beside(lists: pa.Array) -> np.ndarray:
        """The values of another list of the row at the same places; 0 where it has none."""
        at = pa.array(bounds(lists)[row] + place, mask=place >= lengths(lists)[row])
        return pc.fill_null(lists.flatten().take(at).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)

    flat = ids.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    value = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
    allowed = known & (beside(mask) == 1)
    width = int(lengths(ignore).max(initial=0))
    for k in range(width):
        id_ = pc.list_element(ignore, k)
        unlike = value != pc.fill_null(id_, 0).to_numpy(zero_copy_only=False)[row]
        allowed &= unlike & id_.is_valid().to_numpy(zero_copy_only=False)[row]  # an unknown id is like all
    if disallow is not None:
        allowed &= beside(disallow) == 0
    count = np.concatenate([[0], np.cumsum(allowed)])[first]
    return listed(count, pa.array(place[allowed], pa.int32()), ids)


def scattered(sequence: pa.Array, positions: pa.Array, updates: pa.Array) -> pa.Array:
    """struct<updated, changed>: place 0 is ignored, and so are places behind the end; of several updates of a place the
    mean counts, rounded down; an unknown one makes it unknown."""
    first, size, flat = bounds(sequence), lengths(sequence), sequence.flatten()
    pairs = lengths(positions)
    row = np.repeat(np.arange(len(positions)), pairs)
    nth = np.arange(len(row)) - np.repeat(bounds(positions)[:-1], pairs)
    place = pc.fill_null(positions.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    update = updates.flatten().take(pa.array(bounds(updates)[row] + nth, mask=nth >= lengths(updates)[row]))
    kept = (place > 0) & (place < size[row])
    target = first[row[kept]] + place[kept]
    value = pc.fill_null(update, 0).to_numpy(zero_copy_only=False)[kept]
    n, total = np.bincount(target, minlength=len(flat)), np.bincount(target, weights=value, minlength=len(flat))
    unknown = np.zeros(len(flat), dtype=bool)
    unknown[target[update.is_null().to_numpy(zero_copy_only=False)[kept]]] = True
    hit = n > 0
    made = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).copy()
    made[hit] = np.floor(total[hit] / n[hit]).astype(made.dtype)
    unknown |= flat.is_null().to_numpy(zero_copy_only=False) & ~hit
    mask = unknown if unknown.any() else None
    columns = [listed(first, pa.array(made, flat.type, mask=mask), sequence), listed(first, pa.array(hit.astype(np.int32)), sequence)]
    return pa.StructArray.from_arrays(columns, ["updated", "changed"])
