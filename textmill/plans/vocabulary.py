"""Queries over vocabulary learning."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.stage import materialize
from textmill.functions.text import words_of
from textmill.operators import vocabulary as V
from textmill.operators.tokenize import encode_rows, wordpiece
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, code_parts, query, words
from textmill.plans.workspace import workspace

QUERIES, SQL = {}, {}


def S(name, sql=None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: shown(fn(workspace(spark, folder)))
        if sql:
            SQL[name] = sql
        return fn

    return keep


@S("word_counts", query("SELECT word, n FROM run_counts"))
def _(w):
    return w.word_counts


@S("alphabet", query("SELECT token, n FROM letters"))
def _(w):
    return V.alphabet(w.word_counts)


@S("frequent_pieces", query("SELECT token, n FROM piece_counts"))
def _(w):
    return V.frequent_pieces(w.word_counts)


@S("assemble_vocab", query("SELECT token, id::BIGINT AS id, source FROM vocab"))
def _(w):
    return w.vocab


ROUNDS = 12
PART["marked0"] = """
  SELECT n, array_to_string(list_transform(range(1, length(word) + 1), lambda i:
    chr(1) || (CASE WHEN i = 1 THEN '' ELSE '##' END) || substr(word, i, 1) || chr(1)), '') AS symbols FROM run_counts"""
for r in range(ROUNDS):
    PART[f"best{r}"] = f"""
  SELECT a, b, sum(n)::BIGINT AS n, a || CASE WHEN starts_with(b, '##') THEN substr(b, 3) ELSE b END AS token FROM (
    SELECT n, unnest(l[1:len(l) - 1]) AS a, unnest(l[2:]) AS b
    FROM (SELECT n, string_split(substr(symbols, 2, length(symbols) - 2), chr(1) || chr(1)) AS l FROM marked{r})
    WHERE len(l) > 1)
  GROUP BY a, b ORDER BY n DESC, a, b LIMIT 1"""
    PART[f"marked{r + 1}"] = f"""
  SELECT m.n, replace(symbols, chr(1) || a || chr(1) || chr(1) || b || chr(1), chr(1) || token || chr(1)) AS symbols
  FROM marked{r} m, best{r}"""
MERGES = " UNION ALL ".join(f"SELECT {r + 1}::BIGINT AS merge_no, a, b, token, n FROM best{r}" for r in range(ROUNDS))


@S("merge_rounds", query(MERGES))
def _(w):
    return V.learn_wordpiece(w.word_counts, merges=ROUNDS)


@S("learn_wordpiece")
def _(w):
    """The vocabulary of merges, up to the size of the workspace's vocabularies."""
    return w.learned_vocab


@S("encode_learned")
def _(w):
    """All lines in the ids of the learned vocabulary."""
    return encode_rows(w.lines, ["doc_id", "line_no"], "line", w.learned_book)


PART["cased_occ"] = f"SELECT lang, source, word, count(*) AS n FROM (SELECT lang, source, unnest({words('text', False)}) AS word FROM documents) GROUP BY 1, 2, 3"
PART["plain_occ"] = f"SELECT lang, source, word, count(*) AS n FROM (SELECT lang, source, unnest({words('text')}) AS word FROM documents) GROUP BY 1, 2, 3"
for kind in ("cased", "plain"):
    PART.update(code_parts(kind, f"SELECT DISTINCT word FROM {kind}_occ"))


def _coverage_sql(kind: str) -> str:
    return f"""
  SELECT '{kind}' AS kind, lang, source, sum(n)::BIGINT AS words, sum(len(pieces) * n)::BIGINT AS pieces,
         sum(CASE WHEN pieces[1] = '[UNK]' THEN n ELSE 0 END)::BIGINT AS unknown,
         sum(CASE WHEN len(pieces) = 1 AND pieces[1] <> '[UNK]' THEN n ELSE 0 END)::BIGINT AS whole
  FROM {kind}_occ o JOIN {kind}_codes c ON c.word = o.word GROUP BY ROLLUP (lang, source)"""


@S("coverage_report", query(f"""
  SELECT *, round(pieces / words, 6) AS pieces_per_word, round(unknown / words, 6) AS unknown_share
  FROM ({_coverage_sql('cased')} UNION ALL {_coverage_sql('plain')})"""))
def _(w):
    parts = []
    for kind, lower in (("cased", False), ("plain", True)):
        counted = (
            w.documents.select("lang", "source", "text")
            .select("lang", "source", F.explode(words_of("text", lower)).alias("word"))
            .groupBy("lang", "source", "word").agg(F.count("*").alias("n"))
        )
        counted = materialize(counted, f"{kind}-counts")
        codes = wordpiece(counted.select("word").distinct(), w.book)
        parts.append(V.coverage_report(counted, codes, ["lang", "source"]).withColumn("kind", F.lit(kind)))
    both = parts[0].unionByName(parts[1])
    return both.withColumn("pieces_per_word", F.col("pieces") / F.col("words")).withColumn(
        "unknown_share", F.col("unknown") / F.col("words")
    )
