"""The draws of ``functions/draws.py`` for whole lists of whole numbers, in Arrow batches.

A draw is the first 32 bits of the MD5 sum of a text, which begins alike for all numbers of a row. Sums of many short
texts are worked out side by side; texts of more than one MD5 block, and negative numbers, go one by one.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from textmill.functions.draws import as_column

# Texts summed at once, which stay near the processor, and numbers taken at once.
SIDE, PART = 1 << 14, 1 << 16
# Bytes of a text in one block: the rest holds its end mark and its length.
ROOM = 55
# Numbers below are found written out.
SMALL = 1 << 12
_SHIFT = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], dtype=np.uint32)
_ADDED = (np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint64).astype(np.uint32)
_BEGIN = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _summed(words: list[np.ndarray | None], n: int) -> np.ndarray:
    """The first 32 bits of the MD5 sum of ``n`` blocks, given as their 16 words; None stands for a word of zeros.

    The last three rounds do not reach these bits.
    """
    a, b, c, d = (np.full(n, x, dtype=np.uint32) for x in _BEGIN)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(61):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
            word = i
        elif turn == 1:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
            word = (5 * i + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
            word = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
            word = (7 * i) % 16
        np.add(f, a, out=f)
        if words[word] is not None:
            np.add(f, words[word], out=f)
        np.add(f, _ADDED[i], out=f)
        shift = _SHIFT[turn, i % 4]
        np.left_shift(f, shift, out=g)
        np.right_shift(f, np.uint32(32) - shift, out=f)
        np.bitwise_or(f, g, out=f)
        np.add(f, b, out=a)  # the old first place is free
        a, b, c, d = d, a, b, c
    return (b + np.uint32(_BEGIN[0])).byteswap()


def md5_heads(blocks: np.ndarray) -> np.ndarray:
    """The first 32 bits of the MD5 sum of each padded block: (n, 64) bytes to n numbers."""
    out = np.empty(len(blocks), dtype=np.uint32)
    for at in range(0, len(blocks), SIDE):
        part = np.ascontiguousarray(blocks[at : at + SIDE].view("<u4").T)
        out[at : at + SIDE] = _summed([*part], part.shape[1])
    return out


@lru_cache(maxsize=256)
def _tails(size: int, upto: int) -> np.ndarray:
    """For each number below ``upto`` the words of a block that has it behind ``size`` zero bytes, with end mark and length."""
    blocks = np.zeros((upto, 64), dtype=np.uint8)
    for number, block in enumerate(blocks):
        text = str(number).encode()
        end = size + len(text)
        block[size : end + 1] = np.frombuffer(text + b"\x80", np.uint8)
        block.view("<u4")[14] = end * 8
    return blocks.view("<u4")


def _small_heads(texts: list[bytes], size: np.ndarray, row: np.ndarray, numbers: np.ndarray, most: int) -> np.ndarray:
    """:func:`heads` of numbers below ``SMALL``: a row's words and a number's words lie over each other."""
    upto = 1 << max(9, most.bit_length())
    sizes, kind = np.unique(size, return_inverse=True)
    tails = np.ascontiguousarray(np.concatenate([_tails(n, upto) for n in sizes.tolist()]).T)
    begin = np.frombuffer(b"".join(t.ljust(64, b"\0") for t in texts), "<u4").reshape(-1, 16).T.copy()
    used = (int(sizes[-1]) + len(str(most))) // 4 + 1
    out = np.empty(len(row), dtype=np.uint32)
    for at in range(0, len(row), SIDE):
        r = row[at : at + SIDE]
        key = kind[r] * upto + numbers[at : at + SIDE]
        words = [begin[w][r] | tails[w][key] for w in range(used)] + [None] * (16 - used)
        words[14] = tails[14][key]
        out[at : at + SIDE] = _summed(words, len(r))
    return out


def heads(prefixes: pa.Array, row: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each number the 32 bits of its row's prefix with the number behind it."""
    if not len(numbers):
        return np.empty(0, dtype=np.uint32)
    texts = [t.encode() for t in prefixes.to_pylist()]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    least, most = int(numbers.min()), int(numbers.max())
    if 0 <= least and most < SMALL and size.max() + len(str(most)) <= ROOM:
        return _small_heads(texts, size, row, numbers, most)
    digits = 1 + sum((numbers >= 10**k).astype(np.int64) for k in range(1, len(str(most))))
    single = (numbers < 0) | (size[row] + digits > ROOM)
    if single.any():
        out = np.empty(len(numbers), dtype=np.uint32)
        sums = [hashlib.md5(texts[r] + str(n).encode()).digest()[:4] for r, n in zip(row[single].tolist(), numbers[single].tolist(), strict=True)]
        out[single] = np.frombuffer(b"".join(sums), ">u4")
        if not single.all():
            out[~single] = heads(prefixes, row[~single], numbers[~single])
        return out
    table = np.frombuffer(b"".join(t[:ROOM].ljust(64, b"\0") for t in texts), np.uint8).reshape(-1, 64)
    blocks = table[row]
    flat, begin, end = blocks.reshape(-1), np.arange(len(row)) * 64, size[row] + digits
    for k in range(int(digits.max())):
        has = np.flatnonzero(digits > k) if k else slice(None)
        flat[(begin + end)[has] - 1 - k] = 48 + numbers[has] // 10**k % 10
    flat[begin + end] = 0x80
    blocks.view("<u4")[:, 14] = end * 8
    return md5_heads(blocks)


def _parts(lists: pa.Array):
    """(first row, last, row of each element, elements): slices of rows with about ``PART`` elements."""
    count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(count) // PART)) + 1).tolist(), len(lists)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, b, np.repeat(np.arange(b - a), count[a:b]), lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _drawn(prefixes: pa.Array, lists: pa.Array) -> pa.Array:
    made = [heads(prefixes.slice(a, b - a), row, numbers) for a, b, row, numbers in _parts(lists)]
    values = np.concatenate([np.empty(0), *made]) / 4294967296.0
    count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(values), mask=mask)


def _least(prefixes: pa.Array, lists: pa.Array, budgets: pa.Array) -> pa.Array:
    chosen, count = [], []
    for a, b, row, numbers in _parts(lists):
        size = np.bincount(row, minlength=b - a)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        table = np.full((b - a, int(size.max(initial=0))), np.iinfo(np.uint64).max, dtype=np.uint64)
        table[row, place] = heads(prefixes.slice(a, b - a), row, numbers).astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)
        table.sort(axis=1)
        most = np.clip(np.minimum(budgets.slice(a, b - a).to_numpy(zero_copy_only=False), size), 0, None)
        table = (table[:, : int(most.max(initial=0))] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        kept = np.arange(table.shape[1]) < most[:, None]
        table[~kept] = np.iinfo(np.int64).max
        table.sort(axis=1)
        chosen.append(table[kept])
        count.append(most)
    ends = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *count]))])
    flat = np.concatenate([np.empty(0, np.int64), *chosen])
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=mask)


def prefix(seed: int, tag: str, *keys) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *[as_column(k).cast("string") for k in keys], F.lit(""))


def uniform_each(seed: int, tag: str, *keys, numbers) -> Column:
    """array<double>: ``uniform(seed, tag, *keys, number)`` for each number of a list without nulls."""
    return F.arrow_udf(lambda texts, lists: _drawn(texts, lists), "array<double>")(prefix(seed, tag, *keys), as_column(numbers))


def least_drawn(seed: int, tag: str, *keys, numbers, n: Column) -> Column:
    """array<int>: the ``n`` numbers (0 or more) with the least draws, of equal ones the least numbers; ascending."""
    body = lambda texts, lists, most: _least(texts, lists, most)
    return F.arrow_udf(body, "array<int>")(prefix(seed, tag, *keys), as_column(numbers), n)
