"""Queries over words, pieces, sequences and windows."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from textmill.functions.decompose import decompose
from textmill.functions.draws import uniform, uniform_index
from textmill.functions.stage import materialize
from textmill.functions.text import SPECIAL_TOKENS, words_of
from textmill.operators import encode as E, tokenize as T
from textmill.operators.packing import token_id
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, SPOTTED, code_parts, draw, folded, q, query, repeated, words
from textmill.plans.sqlparts import shown as text_of
from textmill.plans.workspace import workspace

QUERIES, SQL = {}, {}


def S(name, sql=None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: shown(fn(workspace(spark, folder)))
        if sql:
            SQL[name] = sql
        return fn

    return keep


# Texts that the given tables have nothing like: ideographs and special tokens in one run, Hangul, dropped characters
# inside a word, a word over the limit, composed and free accents. Their results are written out in the SQL.
ODD_TEXTS = [
    (-1, "ab\u4e2d\u6587cd [MASK]Now[SEP]"), (-2, "\ud55c\uad6d \x00\ud55c\u200b\uae00"), (-3, "q" * 101), (-4, "\u4e2d[MASK]\u6587\t[sep]"),
    (-5, "E\u0301T\u00e9 \u0130x"),
]


def odd_texts(w):
    return w.spark.createDataFrame(ODD_TEXTS, "doc_id bigint, text string")


@S("pretokenize", query("""
  SELECT doc_id, line_no, count(*) AS n_words, string_agg(word, ' ' ORDER BY pos) AS words
  FROM line_occ GROUP BY doc_id, line_no
  UNION ALL SELECT -1, 0, 7, 'ab ' || chr(20013) || ' ' || chr(25991) || ' cd [MASK] now [SEP]'
  UNION ALL SELECT -2, 0, 2, chr(54620) || chr(44397) || ' ' || chr(54620) || chr(44544)
  UNION ALL SELECT -3, 0, 1, repeat('q', 101)
  UNION ALL SELECT -4, 0, 6, chr(20013) || ' [MASK] ' || chr(25991) || ' [ sep ]'
  UNION ALL SELECT -5, 0, 2, 'ete ix'"""))
def _(w):
    lines = w.lines.unionByName(odd_texts(w).select("doc_id", F.lit(0).alias("line_no"), F.col("text").alias("line")))
    return lines.select("doc_id", "line_no", words_of("line").alias("words")).select(
        "doc_id", "line_no", F.size("words").cast("bigint").alias("n_words"), F.array_join("words", " ").alias("words")
    )


@S("wordpiece", query(f"SELECT word, {text_of('pieces')} AS pieces FROM line_codes"))
def _(w):
    return T.word_codes(w.lines, "line", w.book).select("word", "pieces")


PART["vocab_added"] = "SELECT token, id, source FROM vocab UNION ALL SELECT token, id, 'added' FROM added"


@S("to_ids", query("""
  SELECT o.token, coalesce(v.id, 0)::BIGINT AS id, n FROM (
    SELECT token, sum(n)::BIGINT AS n FROM (
      SELECT source AS token, 1 AS n FROM documents UNION ALL SELECT url, 1 FROM pages
      UNION ALL SELECT unnest(pieces), 1 FROM line_occ o JOIN line_codes c ON c.word = o.word) GROUP BY token) o
  LEFT JOIN vocab_added v ON v.token = o.token"""))
def _(w):
    """Sources, addresses and all pieces of all lines; each distinct word is cut once."""
    from textmill.plans.corpus import added_vocab

    names = w.documents.select(F.col("source").alias("token")).unionByName(w.table("pages").select(F.col("url").alias("token")))
    # The outer form: for a plain one a filter is inferred on the pieces, which moves below the counting of words.
    pieces = T.word_codes(w.lines, "line", w.book).select(F.explode_outer("pieces").alias("token"), "n")
    counted = names.withColumn("n", F.lit(1).cast("bigint")).unionByName(pieces).groupBy("token").agg(F.sum("n").alias("n"))
    return T.to_ids(counted, added_vocab(w))


PART["turn_pair"] = """
  SELECT u.conv_id, u.turn, u.text AS text_a, a.text AS text_b FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'"""
PART["turn_occ"] = f"""
  SELECT conv_id, turn, side, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM (
    SELECT conv_id, turn, 'a' AS side, {words('text_a')} AS ws FROM turn_pair
    UNION ALL SELECT conv_id, turn, 'b', {words('text_b')} FROM turn_pair)"""
PART.update(code_parts("turn", "SELECT DISTINCT word FROM turn_occ"))
PART["turn_ids"] = """
  SELECT conv_id, turn, coalesce(flatten(list(ids ORDER BY pos) FILTER (side = 'a')), []) AS a,
         coalesce(flatten(list(ids ORDER BY pos) FILTER (side = 'b')), []) AS b
  FROM turn_occ o JOIN turn_codes c ON c.word = o.word GROUP BY conv_id, turn"""
PART["turn_full"] = f"""
  SELECT conv_id, turn, a, b, [1] || a || [2] || b || [2] AS input_ids,
         {repeated('0', 'len(a) + 2')} || {repeated('1', 'len(b) + 1')} AS token_type_ids,
         {repeated('1', 'len(a) + len(b) + 3')} AS attention_mask,
         [1] || {repeated('0', 'len(a)')} || [1] || {repeated('0', 'len(b)')} || [1] AS special_tokens_mask FROM turn_ids"""
PART["turn_cut"] = """
  SELECT conv_id, turn, a[1:len(a) - off_a] AS a, b[1:len(b) - off_b] AS b, k AS n_removed,
         CASE WHEN k > 0 THEN a[len(a) - off_a - least(len(a) - off_a, 16) + 1:] ELSE [] END AS overflow FROM (
    SELECT *, k - off_b AS off_a FROM (
      SELECT *, CASE WHEN len(a) > len(b) THEN 0 ELSE least(k, len(b) - len(a)) END
                + ceil((k - least(k, abs(len(a) - len(b)))) / 2.0)::BIGINT AS off_b
      FROM (SELECT *, greatest(len(a) + len(b) + 3 - 64, 0) AS k FROM turn_ids)))"""


def pairs(w):
    turns = E.pair_turns(w.table("conversations"))
    return materialize(E.encode_pairs(turns, ["conv_id", "turn"], "text_a", "text_b", w.book), "pairs")


def specials(w):
    return token_id(w.vocab, "[CLS]"), token_id(w.vocab, "[SEP]")


def full(w):
    return E.with_specials(pairs(w), *specials(w))


@S("encode_pairs", query(f"""
  SELECT conv_id, turn, {text_of('input_ids')} AS input_ids, {text_of('token_type_ids')} AS token_type_ids,
         {text_of('attention_mask')} AS attention_mask FROM turn_full"""))
def _(w):
    return full(w).select("conv_id", "turn", "input_ids", "token_type_ids", "attention_mask")


@S("special_tokens_mask", query(f"""
  SELECT conv_id, turn, {text_of('special_tokens_mask')} AS special_tokens_mask FROM turn_full"""))
def _(w):
    return full(w).select("conv_id", "turn", "special_tokens_mask")


@S("truncate_pairs", query(f"SELECT conv_id, turn, {text_of('a')} AS a, {text_of('b')} AS b FROM turn_cut"))
def _(w):
    return E.truncate(pairs(w), 64).select("conv_id", "turn", "a", "b")


@S("overflow", query(f"SELECT conv_id, turn, n_removed::BIGINT AS n_removed, {text_of('overflow')} AS overflow FROM turn_cut"))
def _(w):
    return E.truncate(pairs(w), 64, stride=16).select("conv_id", "turn", "n_removed", "overflow")


PAD_SQL = f"""
  SELECT conv_id, turn, batch, {text_of('ids')} AS input_ids, {text_of('types')} AS token_type_ids,
         {text_of('mask')} AS attention_mask FROM (
    SELECT conv_id, turn, batch, {repeated('0', 'n - len(input_ids)')} || input_ids AS ids,
           {repeated('0', 'n - len(input_ids)')} || token_type_ids AS types,
           {repeated('0', 'n - len(input_ids)')} || attention_mask AS mask
    FROM (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS n
          FROM (SELECT *, floor({draw('pad', 'conv_id', 'turn')} * 20)::BIGINT AS batch FROM turn_full)))"""


@S("pad_to_longest", query(PAD_SQL))
def _(w):
    batched = full(w).withColumn("batch", uniform_index(20, 0, "pad", "conv_id", "turn"))
    columns = ["input_ids", "token_type_ids", "attention_mask"]
    return E.pad(batched, "longest", columns, side="left", batch=["batch"]).select("conv_id", "turn", "batch", *columns)


def _tidy_sql(text: str) -> str:
    for old, new in T.TIDY:
        text = f"replace({text}, {q(old)}, {q(new)})"
    return text


@S("decode", query(f"""
  SELECT conv_id, turn, {_tidy_sql("trim(replace(string_agg(token, ' ' ORDER BY pos), ' ##', ''))")} AS text FROM (
    SELECT conv_id, turn, unnest(range(len(input_ids))) AS pos, unnest(input_ids) AS id FROM turn_full) i
  JOIN vocab v ON v.id = i.id WHERE token NOT IN ({', '.join(q(t) for t in SPECIAL_TOKENS)}) GROUP BY conv_id, turn"""))
def _(w):
    return T.decode(full(w), ["conv_id", "turn"], "input_ids", w.vocab)


PART["spotted"] = f"""
  SELECT doc_id, word_no, {folded('raw')} AS word, length(raw) AS n_chars,
         coalesce(sum(length(gap) + length(raw)) OVER (PARTITION BY doc_id ORDER BY word_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(gap) AS s
  FROM (SELECT doc_id, unnest(range(len(raws))) AS word_no, unnest(gaps) AS gap, unnest(raws) AS raw FROM (
    SELECT doc_id, regexp_extract_all(text, {q(SPOTTED)}, 1) AS gaps,
           regexp_extract_all(text, {q(SPOTTED)}, 2) AS raws FROM documents))"""
PART.update(code_parts("spot", "SELECT DISTINCT word FROM spotted"))
PART["offsets"] = """
  SELECT doc_id, word_no, piece_no, token, id,
         s + coalesce(sum(width) OVER (PARTITION BY doc_id, word_no ORDER BY piece_no
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
         s + (sum(width) OVER (PARTITION BY doc_id, word_no ORDER BY piece_no))::BIGINT AS e
  FROM (SELECT *, CASE WHEN token = '[UNK]' THEN n_chars WHEN starts_with(token, '##') THEN length(token) - 2
                       ELSE length(token) END AS width
        FROM (SELECT doc_id, word_no, n_chars, s, unnest(range(len(pieces))) AS piece_no, unnest(pieces) AS token,
                     unnest(ids) AS id
              FROM spotted o JOIN spot_codes c ON c.word = o.word))"""


# The word ``sep`` of an odd text, cut by the vocabulary.
PART.update(code_parts("odd", "SELECT 'sep' AS word"))
PART["odd_word"] = """
  SELECT token, 1 + coalesce(sum(n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_char, n FROM (
    SELECT i, token, CASE WHEN token = '[UNK]' THEN 3 WHEN starts_with(token, '##') THEN length(token) - 2 ELSE length(token) END AS n
    FROM (SELECT unnest(range(len(pieces))) AS i, unnest(pieces) AS token FROM odd_codes))"""


@S("token_offsets", query("""
  SELECT doc_id, string_agg(token || '@' || s || ':' || e, ' ' ORDER BY word_no, piece_no) AS spans
  FROM offsets GROUP BY doc_id
  UNION ALL SELECT -2, '[UNK]@0:2 [UNK]@4:7'
  UNION ALL SELECT -3, '[UNK]@0:101'
  UNION ALL SELECT -4, '[UNK]@0:1 [MASK]@1:7 [UNK]@7:8 ' || (
    SELECT CASE WHEN count(*) = 1 THEN '[@9:10' ELSE '[UNK]@9:10' END FROM vocab WHERE token = '[')
    || ' ' || (SELECT string_agg(token || '@' || (9 + first_char) || ':' || (9 + first_char + n), ' ' ORDER BY first_char) FROM odd_word)
    || ' ' || (SELECT CASE WHEN count(*) = 1 THEN ']@13:14' ELSE '[UNK]@13:14' END FROM vocab WHERE token = ']')"""))
def _(w):
    texts = w.documents.select("doc_id", "text").unionByName(odd_texts(w).filter("doc_id in (-2, -3, -4)"))
    span = lambda t: F.concat(t["token"], F.lit("@"), t["s"].cast("string"), F.lit(":"), t["e"].cast("string"))
    return T.with_offsets(texts, "text", "tokens", w.book).select("doc_id", F.array_join(F.transform("tokens", span), " ").alias("spans"))


@S("char_to_token", query(f"""
  SELECT c.doc_id, c.no, c.at, coalesce(o.word_no, -1) AS word_no, coalesce(o.piece_no, -1) AS piece_no, coalesce(o.token, '') AS token FROM (
    SELECT doc_id, no, floor({draw('char', 'doc_id', 'no')} * n_chars)::BIGINT AS at
    FROM documents, (SELECT unnest(range(5)) AS no)) c
  LEFT JOIN offsets o ON o.doc_id = c.doc_id AND o.s <= c.at AND c.at < o.e"""))
def _(w):
    asked = w.documents.select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("no")).select(
        "doc_id", "no", F.floor(uniform(0, "char", "doc_id", "no") * F.col("n_chars")).alias("at")
    )
    # As stored: the texts are dealt out by document anyway.
    texts = w.stored("documents").select("doc_id", "text")
    found = T.char_to_token(T.token_offsets(texts, ["doc_id"], "text", w.book), asked, ["doc_id"], "at")
    return found.select("doc_id", "no", "at", "word_no", "piece_no", "token").fillna(
        {"word_no": -1, "piece_no": -1, "token": ""}  # characters between words
    )


def _latin_decomposed() -> str:
    """The SQL replaces accented Latin letters one by one, until none is left that has parts."""
    sql = "text"
    for code in range(0xC0, 0x180):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1:
            sql = f"replace({sql}, chr({code}), {' || '.join(f'chr({ord(c)})' for c in parts)})"
    return sql


# Syllables with and without a closing letter, a letter of three parts, and marks out of order.
COMPOSED_TEXTS = [(-1, "\ud55c\uae00 \uac00"), (-2, "\u1ed8n"), (-3, "q\u0307\u0323")]


@S("decompose_text", f"""
  SELECT doc_id, length(d)::BIGINT AS n_chars, md5(d) AS digest FROM (
    SELECT doc_id, {_latin_decomposed()} AS d FROM documents
    UNION ALL SELECT -1, chr(4370) || chr(4449) || chr(4523) || chr(4352) || chr(4467) || chr(4527) || ' ' || chr(4352) || chr(4449)
    UNION ALL SELECT -2, 'O' || chr(803) || chr(770) || 'n'
    UNION ALL SELECT -3, 'q' || chr(803) || chr(775))""")
def decompose_text(w):
    composed = w.spark.createDataFrame(COMPOSED_TEXTS, "doc_id bigint, text string")
    texts = w.table("documents").select("doc_id", "text").unionByName(composed).select("doc_id", decompose("text").alias("d"))
    return texts.select("doc_id", F.length("d").cast("bigint").alias("n_chars"), F.md5(F.col("d").cast("binary")).alias("digest"))
