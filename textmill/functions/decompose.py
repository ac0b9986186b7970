"""Full canonical decomposition of text as column expressions.

Three steps: each character becomes its parts (one character mapping for each place of a part), syllables of Hangul are
taken apart by arithmetic, and marks that follow each other are put in the order of their classes. The mappings are
made from Python's character table when the expression is built; nothing is looked up row by row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from textmill.functions.draws import as_column

# Fixed values of Hangul: the first syllable, the first of the leading, middle and closing letters, and their numbers.
SYLLABLES, LEADING, MIDDLE, CLOSING = 0xAC00, 0x1100, 0x1161, 0x11A7
LEADS, MIDDLES, CLOSINGS = 19, 21, 28
LAST_SYLLABLE = SYLLABLES + LEADS * MIDDLES * CLOSINGS - 1
CLASS_BASE = 0x4E00  # a mark's class is carried as the character this far on


def _characters() -> range:
    return range(0xC0, 0x110000)  # no character before is decomposed or a mark


@lru_cache(maxsize=1)
def part_tables() -> list[tuple[str, str]]:
    """For each place of a part: the characters that have it, and what it is."""
    places: list[tuple[list[str], list[str]]] = []
    for code in _characters():
        if SYLLABLES <= code <= LAST_SYLLABLE or 0xD800 <= code <= 0xDFFF:
            continue
        parts = unicodedata.normalize("NFD", chr(code))
        if parts != chr(code):
            for i, part in enumerate(parts):
                if i == len(places):
                    places.append(([], []))
                places[i][0].append(chr(code))
                places[i][1].append(part)
    return [("".join(source), "".join(target)) for source, target in places]


@lru_cache(maxsize=1)
def mark_classes() -> tuple[str, str, str]:
    """The marks that have a class, their classes as characters, and a pattern of such a mark."""
    marks = [c for c in _characters() if unicodedata.combining(chr(c))]
    runs: list[list[int]] = []
    for code in marks:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    pattern = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)
    return "".join(map(chr, marks)), "".join(chr(CLASS_BASE + unicodedata.combining(chr(c))) for c in marks), f"[{pattern}]"


def _syllable(char: Column) -> Column:
    letters = lambda first, n: F.lit("".join(chr(first + i) for i in range(n)))
    number = F.ascii(char) - SYLLABLES
    close = F.pmod(number, F.lit(CLOSINGS))
    return F.concat(
        F.substring(letters(LEADING, LEADS), F.floor(number / (MIDDLES * CLOSINGS)).cast("int") + 1, F.lit(1)),
        F.substring(letters(MIDDLE, MIDDLES), F.pmod(F.floor(number / CLOSINGS), F.lit(MIDDLES)).cast("int") + 1, F.lit(1)),
        F.when(close == 0, "").otherwise(F.substring(letters(CLOSING, CLOSINGS), close + 1, F.lit(1))),
    )


def _parts(char: Column) -> Column:
    (source, target), *more = part_tables()
    rest = [F.translate(char, s, t) for s, t in more]
    made = F.concat(F.translate(char, source, target), *[F.when(r == char, "").otherwise(r) for r in rest])
    return F.when(char < chr(_characters().start), char).when(
        char.between(chr(SYLLABLES), chr(LAST_SYLLABLE)), _syllable(char)
    ).otherwise(made)


def _ordered(marks: Column) -> Column:
    source, target, _ = mark_classes()
    keyed = F.transform(F.split(marks, ""), lambda c, i: F.struct(F.translate(c, source, target).alias("k"), i.alias("i"), c.alias("c")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["c"]), "")


def decompose(text) -> Column:
    """The canonical decomposition (NFD) of a text; null stays null."""
    text = as_column(text)
    apart = F.array_join(F.transform(F.split(text, ""), _parts), "")
    several = F.lit(mark_classes()[2] + "{2,}+")
    pieces, runs = F.split(apart, several, -1), F.regexp_extract_all(apart, several, F.lit(0))
    # One piece more than runs.
    ordered = F.array_join(F.zip_with(pieces, runs, lambda p, m: F.concat(p, F.when(m.isNull(), "").otherwise(_ordered(m)))), "")
    marked = F.when(apart.rlike(mark_classes()[2] + "{2}"), ordered).otherwise(apart)
    return F.when(text.rlike(r"[\x{C0}-\x{10FFFF}]"), marked).otherwise(text)
