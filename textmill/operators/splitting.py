"""Words of plain texts inside Arrow batches: tables over characters, and arithmetic on where words begin.

Plain texts hold only characters that fold to one character each, whatever is around them (``functions/text.py`` tells
them apart). Others come as words made by column expressions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textmill.functions.text import BLANKS, PLAIN_BELOW, accent_table

BLANK, WORD, OTHER = 0, 1, 2
# Characters taken at once; a longer text is taken alone.
SLICE = 1 << 17
# Bytes of partial counts that are held, and of counted words that are taken at once.
HELD, GATHERED = 1 << 26, 1 << 23


@lru_cache(maxsize=None)
def tables(lower: bool, runs: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each character its folded form and its kind: punctuation (``runs``: all but letters, marks, digits and
    connectors) is OTHER."""
    accents = dict(zip(*accent_table(), strict=True)) if lower else {}
    fold, kind = np.zeros(PLAIN_BELOW, dtype=np.uint16), np.full(PLAIN_BELOW, WORD, dtype=np.uint8)
    for code in range(PLAIN_BELOW):
        c = chr(code).lower() if lower else chr(code)
        c = accents.get(c, c)
        if len(c) > 1 or ord(c) > 0xFFFF:
            continue  # never in a plain text
        if not runs and c in BLANKS:
            c = " "
        fold[code], category = ord(c), unicodedata.category(c)
        if c == " " or (runs and (category[0] == "Z" or c in "\t\n\x0b\f\r")):
            kind[code] = BLANK
        elif runs:
            kind[code] = WORD if category[0] in "LMN" or category == "Pc" else OTHER
        elif category[0] == "P" or (" " < c <= "~" and not c.isalnum()):
            kind[code] = OTHER
    return fold, kind


def characters(texts: pa.Array) -> np.ndarray:
    """The characters of all texts (no nulls), which lie side by side in the array's buffer."""
    if not len(texts):
        return np.empty(0, np.uint8)
    texts = texts.cast(pa.large_string())
    _, ends, chars = texts.buffers()
    begin, end = np.frombuffer(ends, np.int64)[[texts.offset, texts.offset + len(texts)]].tolist()
    data = chars[begin:end].to_pybytes() if chars else b""
    return np.frombuffer(data, np.uint8) if data.isascii() else np.frombuffer(data.decode().encode("utf-32-le"), "<u4")


def strings(codes: np.ndarray, begin: np.ndarray) -> pa.Array:
    """The characters as strings; ``begin``: where each begins, and the end."""
    if len(codes) and codes.max() >= 0x80:
        ends = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64))])
        begin, data = ends[begin], codes.astype("<u4").tobytes().decode("utf-32-le").encode()
    else:
        data = codes.astype(np.uint8).tobytes()
    return pa.StringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data))


def split(texts: pa.Array, lower: bool = True, runs: bool = False, blanks: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (no nulls) and how many each has. ``runs``: of OTHER characters, several make one word.
    ``blanks``: with the blanks before them."""
    fold, kind = tables(lower, runs)
    codes = characters(texts)
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    kinds = kind[codes]
    first = np.zeros(len(codes) + 1, dtype=bool)  # characters that begin a text, and the end
    first[0] = True
    first[ends] = True
    alone = False if runs else kinds == OTHER
    fresh = np.ones(len(codes) + 1, dtype=bool)  # unlike the character before
    fresh[1:-1] = kinds[1:] != kinds[:-1]
    starts = (kinds != BLANK) & (fresh[:-1] | first[:-1] | alone)
    begin, end = np.flatnonzero(starts), np.flatnonzero((kinds != BLANK) & (fresh[1:] | first[1:] | alone)) + 1
    count = np.diff(np.concatenate([[0], np.searchsorted(begin, ends)]))
    if blanks:
        begin = np.maximum(np.repeat(np.concatenate([[0], ends[:-1]]), count), np.concatenate([[0], end])[: len(end)])
    inside = np.zeros(len(codes) + 1, dtype=np.int8)
    inside[begin] = 1
    inside[end] -= 1
    kept = fold[codes[np.cumsum(inside[:-1], dtype=np.int8) > 0]]
    return strings(kept, np.concatenate([[0], np.cumsum(end - begin)])), count


def cuts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First row and length of slices of about ``most`` bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    found = np.flatnonzero(np.diff(size)) + 1
    for a, b in zip([0, *found.tolist()], [*found.tolist(), len(texts)], strict=True):
        yield a, b - a


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    for a, n in cuts(texts, SLICE):
        yield texts.slice(a, n)


def by_slices(made: Callable[..., pa.Array], most: int, texts: pa.Array, *others: pa.Array) -> pa.Array:
    """``made`` of slices of a batch's rows, one behind the other."""
    return pa.concat_arrays([made(*[c.slice(a, n) for c in (texts, *others)]) for a, n in cuts(texts, most)])


def words_in(texts: pa.Array, given: pa.Array, lower: bool = True, blanks: bool = False) -> pa.Array:
    """array<string>: the words of each text, or those given where the text is null; null where both are."""
    made = [split(pc.fill_null(part, ""), lower, blanks=blanks) for part in slices(texts)]
    flat = pa.concat_arrays([m[0] for m in made])
    count = np.concatenate([m[1] for m in made])
    ends = np.concatenate([[0], np.cumsum(count)])
    plain = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    if texts.null_count == 0:
        return plain
    return pc.if_else(texts.is_valid(), plain, given.cast(plain.type))


def _added_up(held: list[pa.RecordBatch], key: str) -> pa.RecordBatch:
    summed = pa.Table.from_batches(held).group_by(key, use_threads=False).aggregate([("n", "sum")])
    return summed.select([key, "n_sum"]).rename_columns([key, "n"]).combine_chunks().to_batches()[0]


def added_up(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The same counts with most keys once: parts are held up to ``HELD`` bytes and summed."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        if len(part):
            held.append(part)
            size += part.nbytes
        if size >= HELD:
            held = [_added_up(held, key)]
            size = held[0].nbytes
            if 2 * size > HELD:
                yield held[0]
                held, size = [], 0
    if held:
        yield _added_up(held, key)


def counter(lower: bool = True, runs: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (text, words), one of which is null, to (word, n): the words of many slices and how often they are there."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (split(pc.fill_null(part, ""), lower, runs)[0] for part in slices(batch.column(0)))
            for words in chain(texts, [batch.column(1).flatten()]):
                coded = words.dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n, pa.int64())], ["word", "n"])

    return lambda batches: added_up(parts(batches), "word")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``GATHERED`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if any(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def letter_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (word, n) to (token, n): the characters of words, all but the first with the continuation prefix."""

    def parts() -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            words, n = batch.column("word"), batch.column("n").to_numpy()
            size = pc.utf8_length(words).to_numpy().astype(np.int64)
            later = np.ones(size.sum(), dtype=np.int64)
            later[(np.cumsum(size) - size)[size > 0]] = 0
            keys, where = np.unique(characters(words).astype(np.int64) << 1 | later, return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, where, np.repeat(n, size))
            tokens = ["##" * (k & 1) + chr(k >> 1) for k in keys.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(sums)], ["token", "n"])

    return added_up(parts(), "token")


def piece_counter(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (word, n) to (token, n): heads and tails of 2 to ``longest`` characters."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            size = pc.utf8_length(batch.column("word")).to_numpy()
            order = np.argsort(-size, kind="stable")
            words, n = (batch.column(c).take(pa.array(order)) for c in ("word", "n"))
            upto = len(size) - np.searchsorted(np.sort(size), np.arange(longest + 2))  # words of so many characters or more
            for k in range(2, longest + 1):
                if not upto[k]:
                    break
                made = [(pc.utf8_slice_codeunits(words.slice(0, upto[k]), 0, k), upto[k])]
                if upto[k + 1]:
                    tails = pc.utf8_slice_codeunits(words.slice(0, upto[k + 1]), -k)
                    made.append((pc.binary_join_element_wise("##", tails, ""), upto[k + 1]))
                for tokens, count in made:
                    yield _added_up([pa.RecordBatch.from_arrays([tokens, n.slice(0, count)], ["token", "n"])], "token")

    return lambda batches: parts(batches)
