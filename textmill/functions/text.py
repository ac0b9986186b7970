"""Text cleaning and word splitting as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import starts
from textmill.functions.decompose import decompose
from textmill.functions.draws import as_column
from textmill.functions.trie import longest

# Fixed values of the tokenizer format: special tokens, ASCII punctuation ranges (which include the
# symbols Unicode does not call punctuation), and the eight ideograph blocks.
SPECIAL_TOKENS = ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]"]
PUNCTUATION = r"!-/:-@\[-`{-~\p{P}"
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)

WORD = rf"[{PUNCTUATION}]|[^\p{{Z}}{PUNCTUATION}]+"
SPECIAL = "|".join(t.replace("[", r"\[").replace("]", r"\]") for t in SPECIAL_TOKENS)
# Stands for found tokens, or round them. A private character: cleaning drops it, so no word holds it.
MARK = "\ue000"
# A word with the blanks before it, in cleaned and folded text: an ideograph, a punctuation character, a mark or a run.
SPOTTED = rf" *+(?:[{IDEOGRAPHS}]|[{PUNCTUATION}]|\x{{E000}}|[^ \x{{E000}}{PUNCTUATION}{IDEOGRAPHS}]++)"
# The same in texts that hold none of what is rare: no ideographs, no marks.
SPOTTED_PLAIN = rf" *+(?:[{PUNCTUATION}]|[^ {PUNCTUATION}]++)"
# What the quick path of word splitting cannot take: dropped characters, free combining marks (and the
# dotted capital I, whose small form has one), ideographs and special tokens. Characters up to U+02FF but for
# two hold none of it, so most texts need the first, cheaper look only.
UNUSUAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\xAD\x{130}\x{300}-\x{10FFFF}]"
RARE = rf"[\p{{C}}\p{{Mn}}\x{{FFFD}}\x{{130}}{IDEOGRAPHS}&&[^\t\n\r]]"
# Plain texts hold only these: below the limit, each character folds to one, whatever is around it. The frequent ones
# stand ahead of an inner class, so that most characters are looked at once.
PLAIN_BELOW = 0x2028
LATER_PLAIN = r"\xAE-\x{12F}\x{131}-\x{2FF}\x{2010}-\x{2027}"
PLAIN = rf"\A[ -~[\t\n\r\xA0-\xAC{LATER_PLAIN}]]*\z"
# The same for runs, which may hold control characters too.
PLAIN_RUN = rf"\A[ -~[\x00-\x1F\x7F-\xAD{LATER_PLAIN}]]*\z"
# Other blanks than the space, all of which end words.
BLANKS = "\t\n\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Vocabulary learning keeps runs: word characters together, everything else that is not blank together.
RUN_CHARS = r"\p{L}\p{M}\p{N}\p{Pc}"
RUN = rf"[{RUN_CHARS}]+|[^{RUN_CHARS}\p{{Z}}\s]+"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Characters that lose only combining marks when decomposed, and what is left of them."""
    plain = {}
    for code in range(0x80, 0xAC00):
        left = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
        if len(left) == 1 and left[0] != chr(code):
            plain[chr(code)] = left[0]
    return "".join(plain), "".join(plain.values())


def strip_accents(text) -> Column:
    """Drop combining marks, composed or free. Hangul keeps its composed form."""
    source, target = accent_table()
    return F.regexp_replace(F.translate(as_column(text), source, target), r"\p{Mn}+", "")


def lower_plain(text) -> Column:
    return strip_accents(F.lower(as_column(text)))


def _folded(text: Column, lower: bool) -> Column:
    """Blanks as spaces, small letters without accents; as long as the text, unless that is rare."""
    source, target = accent_table() if lower else ("", "")
    return F.translate(F.lower(text) if lower else text, BLANKS + source, " " * len(BLANKS) + target)


def _rare(text: Column, tokens: str | None) -> Column:
    found = (text.rlike(UNUSUAL) & text.rlike(RARE)) | (text.contains("[") & text.rlike(SPECIAL))
    return found | text.rlike(tokens) if tokens else found


def is_plain(text, tokens: str | None = None) -> Column:
    """Whether a text's words can be found by tables over characters (``operators/splitting.py``)."""
    text = as_column(text)
    found = text.contains("[") & text.rlike(SPECIAL)
    return text.rlike(PLAIN) & ~(found | text.rlike(tokens) if tokens else found)


def is_plain_run(text) -> Column:
    """The same for :func:`runs_of`, which drops no control characters and knows no tokens."""
    return as_column(text).rlike(PLAIN_RUN)


def _dropped(lower: bool) -> str:
    return r"[\p{C}\p{Mn}\x{FFFD}]+" if lower else r"[\p{C}\x{FFFD}]+"


def _parts(text: Column, tokens: str | None) -> Column:
    """The text cut at special and added tokens: plain parts and tokens in turn."""
    pattern = f"{SPECIAL}|{tokens}" if tokens else SPECIAL
    return F.split(F.regexp_replace(F.translate(text, MARK, "\x00"), f"({pattern})", f"{MARK}$1{MARK}"), MARK)


def _named(token: Column, lower: bool) -> Column:
    special = F.array(*[F.lit(t) for t in SPECIAL_TOKENS])
    return F.when(F.array_contains(special, token), token).otherwise(F.lower(token)) if lower else token


CHARS = "array<struct<x:string,at:int,part:int>>"
SPAN = "array<struct<word:string,at:array<int>>>"


def words_of(text, lower: bool = True, tokens: str | None = None, full: bool = False) -> Column:
    """Array of words: special tokens whole, ideographs and punctuation characters on their own.

    ``tokens``: a pattern of added tokens (:func:`added_pattern`), which pass whole too, also from inside a word.
    ``full``: lower-cased text is decomposed wholly before it loses its marks, so Hangul becomes its letters.
    """
    text = decompose(text) if full and lower else as_column(text)
    # Most texts hold nothing that needs care: one character mapping and one split then do it all.
    spaced = F.regexp_replace(_folded(text, lower), f"([{PUNCTUATION}])", " $1 ")
    quick = F.array_remove(F.split(spaced, " "), "")
    plain = lambda p: F.regexp_extract_all(F.regexp_replace(_folded(p, lower), _dropped(lower), ""), F.lit(SPOTTED), F.lit(0))
    careful = F.flatten(F.transform(
        _parts(text, tokens), lambda p, i: F.when(i % 2 == 1, F.array(_named(p, lower))).otherwise(F.transform(plain(p), lambda w: F.ltrim(w)))
    ))
    return F.when(_rare(text, tokens), careful).otherwise(quick)


def with_spans(df: DataFrame, text: str, words: str, at: str, lower: bool = True, tokens: str | None = None) -> DataFrame:
    """Adds ``words``, the words of :func:`words_of` with the blanks before them, which together are the text. They are
    null for plain texts, whose words are found where they are encoded.

    Cleaning may drop characters inside a word and folding make more of them, so rare texts go character by character:
    each kept one carries its place along. There words are bare, and ``at`` (else null) has the place of each of their
    characters.
    """
    source, target = accent_table() if lower else ("", "")
    rare, parts = F.col("_rare"), F.col("_parts")
    # Plain texts hold nothing rare, so most are looked at once.
    rows = df.withColumn("_plain", is_plain(F.col(text), tokens))
    rows = rows.withColumn("_rare", ~F.col("_plain") & _rare(F.col(text), tokens)).withColumn("_parts", F.when(rare, _parts(F.col(text), tokens)))
    rows = rows.withColumn("_offsets", starts(F.transform("_parts", lambda p: F.length(p))))

    def chars(part: Column) -> Column:
        single = F.split(part, "")
        if not lower:
            return single
        # Small forms depend on what is around; only where one takes more characters they are made one by one.
        return F.when(F.length(F.lower(part)) == F.length(part), F.split(F.lower(part), "")).otherwise(F.transform(single, lambda c: F.lower(c)))

    def fold(char: Column) -> Column:
        return F.regexp_replace(F.translate(char, BLANKS + source, " " * len(BLANKS) + target), _dropped(lower), "")

    def placed(both: Column, no: Column) -> Column:
        part, first = both["_parts"], both["_offsets"]
        token = F.array(F.struct(F.lit(MARK).alias("x"), first.alias("at"), no.alias("part")))
        return F.when(no % 2 == 1, token).when(part == "", F.array().cast(CHARS)).otherwise(
            F.transform(chars(part), lambda c, i: F.struct(fold(c).alias("x"), (first + i).cast("int").alias("at"), no.alias("part")))
        )

    rows = rows.withColumn("_placed", F.flatten(F.transform(F.arrays_zip("_parts", "_offsets"), placed)))
    rows = rows.withColumn("_chars", F.flatten(F.transform("_placed", lambda k: F.when(
        k["x"] != "", F.transform(F.split(k["x"], ""), lambda x: F.struct(x.alias("x"), k["at"].alias("at"), k["part"].alias("part")))
    ).otherwise(F.array().cast(CHARS)))))
    clean = F.when(rare, F.array_join(F.transform("_chars", lambda k: k["x"]), "")).otherwise(_folded(F.col(text), lower))
    rows = rows.withColumn("_clean", F.when(~F.col("_plain"), clean))
    find = lambda pattern: F.regexp_extract_all("_clean", F.lit(pattern), F.lit(0))
    rows = rows.withColumn("_found", F.when(rare, find(SPOTTED)).otherwise(find(SPOTTED_PLAIN)))
    # Where rare: words without blanks, and their first of the kept characters.
    rows = rows.withColumn("_bare", F.when(rare, F.transform("_found", lambda w: F.ltrim(w))))
    rows = rows.withColumn("_s", F.when(rare, starts(F.transform("_found", lambda m: F.length(m)))))
    gaps = F.zip_with("_found", "_bare", lambda m, w: F.length(m) - F.length(w))
    rows = rows.withColumn("_gaps", F.when(rare, gaps)).withColumn("_s", F.zip_with("_s", "_gaps", lambda s, g: (s + g).cast("int")))

    def careful(word: Column, s: Column) -> Column:
        first = F.element_at("_chars", s + 1)
        name = F.element_at(parts, first["part"] + 1)
        at = F.when(word == MARK, F.sequence(first["at"], first["at"] + F.length(name) - 1)).otherwise(
            F.transform(F.slice("_chars", s + 1, F.length(word)), lambda k: k["at"])
        )
        return F.struct(F.when(word == MARK, _named(name, lower)).otherwise(word).alias("word"), at.alias("at"))

    rows = rows.withColumn("_spans", F.when(rare, F.zip_with("_bare", "_s", careful).cast(SPAN)))
    rows = rows.withColumn(words, F.when(rare, F.transform("_spans", lambda w: w["word"])).otherwise(F.col("_found")))
    rows = rows.withColumn(at, F.transform("_spans", lambda w: w["at"]))
    return rows.drop("_rare", "_parts", "_offsets", "_placed", "_chars", "_clean", "_plain", "_bare", "_found", "_gaps", "_s", "_spans")


def added_pattern(tokens: list[str], lower: bool = True) -> str | None:
    """A pattern that finds added tokens, the longest at a place; in any case if texts are lower-cased."""
    names = [t for t in tokens if t and t not in SPECIAL_TOKENS]
    if not names:
        return None
    return f"(?iu:{longest(t.lower() for t in names)})" if lower else f"(?:{longest(names)})"


def runs_of(text) -> Column:
    """Array of lower-cased word runs and punctuation runs (vocabulary learning)."""
    return F.regexp_extract_all(lower_plain(text), F.lit(RUN), F.lit(0))


def joined(items) -> Column:
    """An array shown as one string, for reports and comparisons."""
    return F.array_join(as_column(items).cast("array<string>"), " ")
