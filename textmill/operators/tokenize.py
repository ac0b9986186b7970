"""Words, word pieces, ids, offsets and decoding.

Encoding is a projection: a row's words are array expressions inside the row, and its pieces and ids are made of whole
Arrow batches of rows (``operators/pieces.py``), so texts are never exploded, shuffled or gathered again, and no word
can crowd a task. What they look things up in is a :class:`Codebook`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import let
from textmill.functions.origin import origin, with_origin
from textmill.functions.text import SPECIAL_TOKENS, added_pattern, is_plain, with_spans, words_of
from textmill.operators.pieces import (
    CODED, Matcher, TokenNames, row_codes, row_covering, row_ids, row_labels, row_spans, row_text, row_tokens,
)
from textmill.operators.splitting import by_slices, counter, words_in

MAX_CHARS = 100
# Bounds of what a codebook holds: tokens of all kinds, and added ones among them.
MAX_TOKENS, MAX_ADDED = 4_000_000, 100_000
CODE = "array<struct<id:int,f:int,n:int>>"
CODES = f"array<{CODE}>"
COVERING = "array<struct<at:bigint,word_no:int,piece_no:int,token:string,s:int,e:int>>"
SPANS = "struct<ids:array<int>,s:array<int>,e:array<int>>"


def plain_or_words(text: Column, lower: bool = True, tokens: str | None = None) -> tuple[Column, Column]:
    """The text if it is plain, so that its words are found in the Arrow batch, and else its words.

    Plain texts have an empty list beside them, no null: Spark asks for the size of an Arrow batch at each row, and
    lists go back over all nulls at their end to tell it.
    """
    plain = is_plain(text, tokens)
    # Inside a lambda, so that what few rows need is no part of the code compiled for all.
    words = let(text, lambda t: words_of(t, lower, tokens))
    return F.when(plain, text).alias("text"), F.when(plain, F.array().cast("array<string>")).otherwise(words).alias("words")


def pretokenize(df: DataFrame, keys: list[str], text: str, lower: bool = True, tokens: str | None = None) -> DataFrame:
    """(keys, pos, word); a row without words keeps one row with null pos and word."""
    return df.select(*keys, F.posexplode_outer(words_of(text, lower, tokens)).alias("pos", "word"))


def split_rows(df: DataFrame, keys: list[str], text: str, lower: bool = True, tokens: str | None = None) -> DataFrame:
    """(keys, words): the words of :func:`pretokenize` as one array a row, found in Arrow batches; null for a null text."""
    words = F.arrow_udf(lambda texts, given: words_in(texts, given, lower), "array<string>")
    return df.select(*keys, words(*plain_or_words(F.col(text), lower, tokens)).alias("words"))


class Codebook:
    """What encoding needs of a vocabulary (token, id, source): its pieces and, apart, the special and added tokens,
    which never split.

    A code is (id, f, n): a token, the character of the word it begins at and how many it takes. Vocabularies are
    bounded by their size; added tokens by ``MAX_ADDED``, beyond which this is an error.
    """

    def __init__(self, vocab: DataFrame, unk: str = "[UNK]", max_chars: int = MAX_CHARS, lower: bool = True):
        self.unk, self.lower = unk, lower
        rows = vocab.select("token", F.col("id").cast("int"), "source").limit(MAX_TOKENS + 1).collect()
        rows.sort(key=lambda r: -r.id)  # of tokens that repeat, the least id counts
        added = {r.token: r.id for r in rows if r.source == "added"}
        if len(rows) > MAX_TOKENS or len(added) > MAX_ADDED:
            raise ValueError(f"more than {MAX_TOKENS} tokens, or more than {MAX_ADDED} added ones")
        base = {r.token: r.id for r in rows if r.source != "added"}
        self.id_of = base | added
        self.tokens = added_pattern(list(added), lower)
        heads = {t: self.id_of[t] for t in base if t and t not in SPECIAL_TOKENS}
        tails = {t[2:]: self.id_of[t] for t in base if t.startswith("##") and len(t) > 2}
        whole = {t: i for t, i in self.id_of.items() if t in SPECIAL_TOKENS or t in added}
        self.matcher = Matcher(heads, tails, whole, self.id_of[unk], unk, max_chars)

    def _made(self, body: Callable, kind: str, *columns: Column) -> Column:
        """Python sees whole Arrow batches; the columns stay in the row they are in."""
        matcher = self.matcher
        return F.arrow_udf(lambda *given: body(matcher, *given), kind)(*columns)

    def ids(self, words: Column) -> Column:
        """The ids of the row's words, one behind the other. A word over ``max_chars`` or with a rest that no piece
        matches is unknown as a whole."""
        return self._made(row_ids, "array<int>", words)

    def text_ids(self, text: Column) -> Column:
        """:meth:`ids` of the words of a text."""
        lower = self.lower
        coded = lambda matcher, texts, given: row_ids(matcher, words_in(texts, given, lower))
        body = lambda matcher, *given: by_slices(partial(coded, matcher), CODED, *given)
        return self._made(body, "array<int>", *plain_or_words(text, lower, self.tokens))

    def codes(self, words: Column) -> Column:
        return self._made(row_codes, CODES, words)

    def placed(self, text: Column, words: Column, at: Column) -> Column:
        """``words`` and ``at``: of :func:`with_spans`, null for plain texts."""
        lower = self.lower
        body = lambda matcher, texts, given, at: row_tokens(matcher, words_in(texts, given, lower, blanks=True), at)
        return self._made(body, TOKEN, F.when(words.isNull(), text), words, at)

    def spans(self, text: Column, words: Column, at: Column) -> Column:
        """Of :meth:`placed` the ids and the characters, as arrays side by side."""
        lower = self.lower
        coded = lambda matcher, texts, given, at: row_spans(matcher, words_in(texts, given, lower, blanks=True), at)
        body = lambda matcher, *given: by_slices(partial(coded, matcher), CODED, *given)
        return self._made(body, SPANS, F.when(words.isNull(), text), words, at)

    def covering(self, text: Column, words: Column, at: Column, asked: Column) -> Column:
        """Of :meth:`placed` those tokens that cover one of the ``asked`` characters (array<bigint>, no nulls)."""
        lower = self.lower
        coded = lambda matcher, texts, given, at, asked: row_covering(matcher, words_in(texts, given, lower, blanks=True), at, asked)
        body = lambda matcher, *given: by_slices(partial(coded, matcher), CODED, *given)
        return self._made(body, COVERING, F.when(words.isNull(), text), words, at, asked)

    def labelled(self, words: Column, mark: Column, tags: Column, ignored: int | None) -> Column:
        return self._made(
            lambda matcher, *given: row_labels(matcher, *given, ignored), "struct<ids:array<int>,labels:array<int>>", words, mark, tags
        )

    def token(self, word: Column, code: Column) -> Column:
        """The text of one of the word's tokens."""
        piece = F.concat(F.when(code["f"] > 0, F.lit("##")).otherwise(F.lit("")), F.substring(word, code["f"] + 1, code["n"]))
        return F.when(code["id"] == self.id_of[self.unk], F.lit(self.unk)).otherwise(piece)


def codebook(vocab: DataFrame | Codebook, lower: bool = True) -> Codebook:
    return vocab if isinstance(vocab, Codebook) else Codebook(vocab, lower=lower)


def wordpiece(words: DataFrame, vocab: DataFrame | Codebook, unk: str = "[UNK]", max_chars: int = MAX_CHARS) -> DataFrame:
    """Greedy longest match from the left for distinct words: adds ``pieces`` and ``ids``.

    A word over ``max_chars`` or with an unmatched rest is one
    unknown token; special and added tokens are themselves.
    """
    book = vocab if isinstance(vocab, Codebook) else Codebook(vocab, unk=unk, max_chars=max_chars)
    rows = words.withColumn("_codes", book.codes(F.array("word"))).withColumn("_code", F.element_at("_codes", 1))
    return rows.select(
        *words.columns, F.transform("_code", lambda c: book.token(F.col("word"), c)).alias("pieces"), F.transform("_code", lambda c: c["id"]).alias("ids")
    )


def word_codes(df: DataFrame, text: str, vocab: DataFrame | Codebook, lower: bool = True) -> DataFrame:
    """Distinct words of a corpus with count, pieces and ids."""
    book = codebook(vocab, lower)
    parts = df.select(*plain_or_words(F.col(text), book.lower, book.tokens))
    counted = parts.mapInArrow(counter(book.lower), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return wordpiece(counted, book)


def encode_rows(df: DataFrame, keys: list[str], text: str, vocab: DataFrame | Codebook, lower: bool = True) -> DataFrame:
    """(keys, ids): the id array of each row's text. No shuffle; a null text has no ids."""
    book = codebook(vocab, lower)
    coded = df.select(*keys, book.text_ids(F.col(text)).alias("_ids_of"))
    return coded.select(*keys, F.coalesce("_ids_of", F.array().cast("array<int>")).alias("ids"))


def to_ids(pieces: DataFrame, vocab: DataFrame, unk: str = "[UNK]", keep: list[str] | None = None) -> DataFrame:
    """Adds ``id`` for each ``token``: an added token wins over a base one, unknown tokens get the unk id."""
    unk_id = vocab.filter(F.col("token") == unk).agg(F.min("id")).scalar()
    rank = F.when(F.col("source") == "added", 0).otherwise(1)
    chosen = vocab.groupBy("token").agg(F.min(F.struct(rank.alias("r"), "id"))["id"].alias("_id"))
    # No hint: added tokens have no fixed bound, so Catalyst decides by size.
    return pieces.join(chosen, "token", "left").select(
        *(keep or pieces.columns), F.coalesce("_id", unk_id).alias("id")
    )


# Fixed values of the output format: what to tidy, in this order.
TIDY = [
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"), (" 'm", "'m"),
    (" do not", " don't"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
]


def decode(
    df: DataFrame, keys: list[str], ids: str, vocab: DataFrame, skip_special: bool = True, tidy: bool = True
) -> DataFrame:
    """(keys, text): ids back to text, continuation pieces glued on. Inside the row; no shuffle. Ids that the
    vocabulary does not have are left out."""
    rows = vocab.select("id", "token").limit(MAX_TOKENS + 1).collect()
    if len(rows) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} tokens")
    known = [(r.id, r.token) for r in rows if r.id is not None and r.token is not None]
    names = TokenNames([(i, t) for i, t in known if not skip_special or t not in SPECIAL_TOKENS])
    text = F.arrow_udf(lambda lists: row_text(names, lists), "string")(F.col(ids).cast("array<bigint>"))
    # Worked out once, however often the expressions below name it.
    made = df.select(*keys, text.alias("_text"))
    text = F.btrim(F.replace(F.coalesce("_text", F.lit("")), F.lit(" ##"), F.lit("")))
    if tidy:
        for old, new in TIDY:
            text = F.replace(text, F.lit(old), F.lit(new))
    return made.select(*keys, text.alias("text"))


TOKEN = "array<struct<word_no:int,piece_no:int,token:string,id:int,s:int,e:int>>"

def with_offsets(df: DataFrame, text: str, out: str, vocab: DataFrame | Codebook, lower: bool = True) -> DataFrame:
    """Adds ``out``: array<struct<word_no, piece_no, token, id, s, e>>, the tokens that :func:`encode_rows` gives with
    the characters of the text they stand for, end exclusive. An unknown word is one token over the whole word. Inside
    the row; no shuffle.
    """
    book = codebook(vocab, lower)
    rows = with_spans(df, text, "_words", "_at", lower, book.tokens)
    return rows.withColumn(out, book.placed(F.col(text), F.col("_words"), F.col("_at"))).drop("_words", "_at")


def with_spans_of_tokens(df: DataFrame, text: str, out: str, vocab: DataFrame | Codebook, lower: bool = True) -> DataFrame:
    """Adds ``out``: struct of the arrays ids, s and e, the same tokens without their words and texts."""
    book = codebook(vocab, lower)
    rows = with_spans(df, text, "_words", "_at", lower, book.tokens)
    return rows.withColumn(out, book.spans(F.col(text), F.col("_words"), F.col("_at"))).drop("_words", "_at")


def token_offsets(df: DataFrame, keys: list[str], text: str, vocab: DataFrame | Codebook, lower: bool = True) -> DataFrame:
    """(keys, word_no, piece_no, token, id, s, e): :func:`with_offsets` as rows.

    The outer form, so that no filter on the array is inferred, which would work all tokens out twice.
    """
    book = codebook(vocab, lower)
    rows = with_offsets(df, text, "_tokens", book).select(*keys, F.inline_outer("_tokens")).filter("token is not null")
    return with_origin(rows, df, keys, text, book)


SPAN_BUCKET = 64
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _tokens_at(texts: DataFrame, chars: DataFrame, keys: list[str], text: str, char: str, book: Codebook) -> DataFrame:
    """(keys, char, word_no, piece_no, token, s, e): the tokens of texts that cover the asked characters.

    A text's distinct characters go to its row, and leave it with their tokens. No other token leaves the row.
    """
    asked = chars.select(*keys, F.col(char).cast("bigint").alias("_asked")).filter("_asked is not null")
    asked = asked.groupBy(*keys).agg(F.collect_set("_asked").alias("_asked"))
    # Spans of words are worked out behind the join, and its rows are no more than the texts.
    rows = texts.select(*keys, F.col(text).alias("_text")).join(asked, keys)
    rows = with_spans(rows, "_text", "_words", "_at", book.lower, book.tokens)
    found = rows.select(*keys, book.covering(F.col("_text"), F.col("_words"), F.col("_at"), F.col("_asked")).alias("_found"))
    # The outer form, as in token_offsets.
    return found.select(*keys, F.inline_outer("_found")).filter("at is not null").withColumnRenamed("at", "_covered")


def char_to_token(offsets: DataFrame, chars: DataFrame, keys: list[str], char: str) -> DataFrame:
    """The token that covers each asked character.

    Where ``offsets`` comes right from :func:`token_offsets`, by the same keys, the characters go to the rows of the
    texts, so that no token is moved or written but those that were asked for. Any other table of tokens is met by a
    range join within a text, by equal buckets of characters: a token stands in each bucket it touches
    (few, as words are short), a character in exactly one, so long texts do not compare all pairs.
    """
    made = origin(offsets)
    if made and sorted(made.keys) == sorted(keys) and dict(chars.dtypes)[char] in WHOLE:
        found = _tokens_at(made.texts, chars, keys, made.text, char, made.book).alias("o")
        c = chars.alias("c")
        condition = F.col(f"c.{char}").cast("bigint") == F.col("o._covered")
        for k in keys:
            condition = condition & (F.col(f"c.{k}") == F.col(f"o.{k}"))
        return c.join(found, condition, "left").select("c.*", "o.word_no", "o.piece_no", "o.token", "o.s", "o.e")
    touched = F.sequence(F.floor(F.col("s") / SPAN_BUCKET), F.floor((F.col("e") - 1) / SPAN_BUCKET))
    o = offsets.withColumn("_bucket", F.explode(touched)).alias("o")
    c = chars.withColumn("_bucket", F.floor(F.col(char) / SPAN_BUCKET)).alias("c")
    condition = (F.col("o.s") <= F.col(f"c.{char}")) & (F.col(f"c.{char}") < F.col("o.e"))
    for k in [*keys, "_bucket"]:
        condition = condition & (F.col(f"c.{k}") == F.col(f"o.{k}"))
    return c.join(o, condition, "left").select("c.*", "o.word_no", "o.piece_no", "o.token", "o.s", "o.e").drop("_bucket")
