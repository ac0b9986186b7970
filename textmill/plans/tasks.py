"""Queries over task features: tagging, question answering, batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from textmill.functions.drawn import uniform_each
from textmill.functions.draws import uniform, uniform_index
from textmill.functions.stage import materialize
from textmill.operators import encode as E, features as X
from textmill.operators.answerspans import pack
from textmill.operators.packing import token_id
from textmill.operators.tokenize import encode_rows
from textmill.plans.encoding import full
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, code_parts, draw, query, words
from textmill.plans.sqlparts import shown as text_of
from textmill.plans.workspace import workspace
from textmill.sources import nested

QUERIES, SQL = {}, {}


def S(name, sql=None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: shown(fn(workspace(spark, folder)))
        if sql:
            SQL[name] = sql
        return fn

    return keep


def specials(w):
    return token_id(w.vocab, "[CLS]"), token_id(w.vocab, "[SEP]")


@S("prepare_columns", query("""
  SELECT doc_id, quality::BIGINT AS label, toxic::VARCHAR AS toxic_text FROM labels"""))
def _(w):
    renamed = nested.prepare_columns(
        w.table("labels").withColumn("extra", F.lit(1)), ["extra"], {"quality": "label", "toxic": "toxic_text"}, ["toxic_text"]
    )
    return renamed


PART["tagged"] = f"""
  SELECT doc_id, line_no, token_no, token, floor({draw('tag', 'doc_id', 'line_no', 'token_no')} * 5)::BIGINT AS tag FROM (
    SELECT doc_id, line_no, unnest(range(len(l))) AS token_no, unnest(l) AS token FROM (
      SELECT doc_id, line_no, list_filter(string_split(line, ' '), lambda t: t <> '') AS l FROM doc_lines))"""
PART["aligned"] = """
  SELECT doc_id, line_no, token_no, pos, piece_no, id, tag FROM (
    SELECT o.*, unnest(range(len(ids))) AS piece_no, unnest(ids) AS id FROM (
      SELECT doc_id, line_no, token_no, tag, unnest(range(len(ws))) AS pos, unnest(ws) AS word
      FROM (SELECT *, WORDS AS ws FROM tagged)) o JOIN line_codes c ON c.word = o.word)""".replace("WORDS", words("token"))


def _align_sql(later: str) -> str:
    order = "ORDER BY token_no, pos, piece_no"
    return f"""
  SELECT doc_id, line_no, '1 ' || string_agg(id, ' ' {order}) || ' 2' AS input_ids,
         '-100 ' || string_agg(CASE WHEN pos = 0 AND piece_no = 0 THEN tag ELSE {later} END, ' ' {order}) || ' -100' AS labels
  FROM aligned GROUP BY doc_id, line_no"""


def tagged(w):
    tokens = F.filter(F.split("line", " "), lambda t: t != "")
    return w.lines.select("doc_id", "line_no", tokens.alias("tokens")).withColumn(
        "tags", F.transform("tokens", lambda _, i: uniform_index(5, 0, "tag", "doc_id", "line_no", i))
    )


@S("align_labels", query(_align_sql("-100")))
def _(w):
    return X.align_labels(tagged(w), ["doc_id", "line_no"], w.book, *specials(w))


@S("align_labels_all", query(_align_sql("tag")))
def _(w):
    return X.align_labels(tagged(w), ["doc_id", "line_no"], w.book, *specials(w), label_all=True)


PART["qa_example"] = f"""
  SELECT doc_id AS id, doc_id % (SELECT count(*) FROM benchmark) AS question_id, doc_id AS context_id,
         CASE WHEN has THEN at_char END AS answer_start, CASE WHEN has THEN substr(text, at_char + 1, n) END AS answer_text,
         substr(text, at_char + 1, n2) AS guess, text
  FROM (SELECT doc_id, text, floor({draw('at', 'doc_id')} * length(text))::BIGINT AS at_char,
               1 + floor({draw('len', 'doc_id')} * 40)::BIGINT AS n,
               1 + floor({draw('len2', 'doc_id')} * 40)::BIGINT AS n2, {draw('has', 'doc_id')} < 0.8 AS has FROM documents)"""
PART["question_occ"] = f"""
  SELECT item_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM (SELECT item_id, {words('text')} AS ws FROM benchmark)"""
PART.update(code_parts("question", "SELECT DISTINCT word FROM question_occ"))
PART["question_ids"] = """
  SELECT item_id AS question_id, flatten(list(ids ORDER BY pos)) AS q
  FROM question_occ o JOIN question_codes c ON c.word = o.word GROUP BY item_id"""
PART["context_pieces"] = """
  SELECT doc_id AS context_id, list({'id': id, 's': s, 'e': e} ORDER BY word_no, piece_no) AS pieces
  FROM offsets GROUP BY doc_id"""
PART["qa_window"] = """
  SELECT id, question_id, answer_start, answer_text, win, start, q,
         pieces[start + 1:start + greatest(room, 0)] AS c FROM (
    SELECT *, win * (room - 128) AS start FROM (
      SELECT *, unnest(range(1 + ceil(greatest(len(pieces) - room, 0) / (room - 128)::DOUBLE)::BIGINT)) AS win FROM (
        SELECT e.*, k.q, p.pieces, 384 - len(k.q) - 3 AS room FROM qa_example e
        JOIN question_ids k ON k.question_id = e.question_id
        JOIN context_pieces p ON p.context_id = e.context_id)))"""


def qa_examples(w):
    doc, size = F.col("doc_id"), F.length("text")
    n_items = w.table("benchmark").agg(F.count("*")).scalar()
    at = F.floor(uniform(0, "at", doc) * size)
    has = uniform(0, "has", doc) < 0.8
    cut = lambda tag: F.substring("text", F.col("at").cast("int") + 1, 1 + uniform_index(40, 0, tag, doc).cast("int"))
    return w.documents.select("doc_id", "text", at.alias("at"), has.alias("has"), F.pmod(doc, n_items).alias("question_id")).select(
        F.col("doc_id").alias("id"), "question_id", F.col("doc_id").alias("context_id"),
        F.when(F.col("has"), F.col("at")).alias("answer_start"), F.when(F.col("has"), cut("len")).alias("answer_text"),
        cut("len2").alias("guess"), "text",
    )


def qa_windows(w):
    questions = encode_rows(
        w.table("benchmark").select(F.col("item_id").alias("question_id"), "text"), ["question_id"], "text", w.book
    )
    contexts = X.offsets_by_row(
        w.stored("documents").select(F.col("doc_id").alias("context_id"), "text"), ["context_id"], "text", w.book
    )
    examples = qa_examples(w).select("id", "question_id", "context_id", "answer_start", "answer_text")
    return X.qa_windows(examples, questions, contexts, *specials(w))


@S("stride_windows", query(f"""
  SELECT id, win AS "window", start, len(c) AS n_context,
         '1 ' || {text_of('q')} || ' 2 ' || {text_of("list_transform(c, lambda p: p.id)")} || ' 2'
         || repeat(' 0', (384 - len(q) - len(c) - 3)::BIGINT) AS input_ids FROM qa_window"""))
def _(w):
    step = F.lit(384 - 3 - 128) - (F.col("c_first") - 2)
    return qa_windows(w).select("id", "window", (F.col("window") * step).alias("start"), F.col("c_count").alias("n_context"), "input_ids")


@S("qa_train_features", query("""
  SELECT id, win AS "window", CASE WHEN inside THEN s ELSE 0 END AS start_position,
         CASE WHEN inside THEN e ELSE 0 END AS end_position FROM (
    SELECT id, win, coalesce(max(answer_start) IS NOT NULL AND max(s0) <= max(answer_start)
                             AND max(e1) >= max(answer_start + length(answer_text)), false) AS inside,
           max(CASE WHEN s <= answer_start THEN i END) AS s,
           min(CASE WHEN e >= answer_start + length(answer_text) THEN i END) AS e FROM (
      SELECT id, win, answer_start, answer_text, c[1].s AS s0, c[len(c)].e AS e1,
             len(q) + 2 + unnest(range(len(c))) AS i, unnest(c).s AS s, unnest(c).e AS e FROM qa_window)
    GROUP BY id, win)"""))
def _(w):
    return X.qa_train_features(qa_windows(w), "answer_start", "answer_text").select(
        "id", "window", "start_position", "end_position"
    )


@S("qa_eval_features", query(f"""
  SELECT id, win AS "window", len(q) + 2 AS first,
         {text_of("list_transform(c, lambda p: p.s || ':' || p.e)")} AS offsets FROM qa_window"""))
def _(w):
    text = F.transform(F.filter("offsets", lambda o: o.isNotNull()), lambda o: F.concat_ws(":", o["s"], o["e"]))
    first = F.array_position(F.transform("offsets", lambda o: o.isNotNull()), True) - 1
    features = X.qa_eval_features(qa_windows(w))
    return features.select("id", "window", first.alias("first"), text.alias("offsets"))


PART["span_score"] = f"""
  SELECT id, win, i, n_first, s, e, a, b,
         row_number() OVER (PARTITION BY id, win ORDER BY a DESC, i) AS ra,
         row_number() OVER (PARTITION BY id, win ORDER BY b DESC, i) AS rb FROM (
    SELECT id, win, i, n_first, CASE WHEN k BETWEEN 1 AND len(c) THEN c[k].s END AS s,
           CASE WHEN k BETWEEN 1 AND len(c) THEN c[k].e END AS e,
           {draw('start', 'id', 'win', 'i')} AS a, {draw('end', 'id', 'win', 'i')} AS b
    FROM (SELECT *, i - n_first + 1 AS k FROM (
      SELECT id, win, c, len(q) + 2 AS n_first, unnest(range(384)) AS i FROM qa_window)))"""
PART["best_span"] = """
  SELECT id, s, e, score FROM (
    SELECT x.id, x.s, y.e, x.a + y.b AS score,
           row_number() OVER (PARTITION BY x.id ORDER BY x.a + y.b DESC, x.win, x.i, y.i) AS rn
    FROM span_score x JOIN span_score y ON y.id = x.id AND y.win = x.win
      AND y.i >= x.i AND y.i - x.i < 30
    WHERE x.ra <= 20 AND y.rb <= 20 AND x.s IS NOT NULL AND y.s IS NOT NULL) WHERE rn = 1"""
PART["qa_answer"] = """
  SELECT d.doc_id AS id, coalesce(substr(d.text, s + 1, e - s), '') AS prediction, coalesce(score, 0.0) AS score,
         null_score
  FROM documents d LEFT JOIN best_span b ON b.id = d.doc_id
  LEFT JOIN (SELECT id, max(a + b) AS null_score FROM span_score WHERE i = 0 GROUP BY id) n ON n.id = d.doc_id"""


def best_spans(w, **options):
    features = X.qa_eval_features(qa_windows(w)).select("id", "window", pack("offsets").alias("offsets"))
    features = materialize(features, "qa-features")
    line = F.sequence(F.lit(0), F.lit(383))
    score = lambda tag: uniform_each(0, tag, "id", "window", numbers=line)
    logits = features.select("id", "window", score("start").alias("start_logits"), score("end").alias("end_logits"))
    contexts = w.stored("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("context"))
    return X.qa_best_spans(features, logits, contexts, **options)


@S("qa_best_spans", query("SELECT id, prediction, round(score, 6) AS score, round(null_score, 6) AS null_score FROM qa_answer"))
def _(w):
    return best_spans(w)


@S("qa_best_spans_no_answer", query("""
  SELECT id, CASE WHEN score > null_score THEN prediction ELSE '' END AS prediction, round(score, 6) AS score,
         round(null_score, 6) AS null_score FROM qa_answer"""))
def _(w):
    return best_spans(w, no_answer=True)


@S("batch_plan", query(f"""
  SELECT doc_id, rn // 32 AS batch, rn % 32 AS pos FROM (
    SELECT doc_id, row_number() OVER (ORDER BY {draw('batch', 'doc_id')}, doc_id) - 1 AS rn FROM documents)"""))
def _(w):
    return X.batch_plan(w.documents.select("doc_id"), ["doc_id"], 32)


@S("padded_batches", query(f"""
  SELECT conv_id, turn, batch, pos, {text_of('input_ids')} || repeat(' 0', (n - len(input_ids))::BIGINT) AS input_ids FROM (
    SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS n FROM (
      SELECT conv_id, turn, input_ids, rn // 16 AS batch, rn % 16 AS pos FROM (
        SELECT *, row_number() OVER (ORDER BY {draw('batch', 'conv_id', 'turn')}, conv_id, turn) - 1 AS rn FROM turn_full)))"""))
def _(w):
    planned = X.batch_plan(full(w).select("conv_id", "turn", "input_ids"), ["conv_id", "turn"], 16)
    return E.pad(planned, "longest", ["input_ids"], batch=["batch"]).select("conv_id", "turn", "batch", "pos", "input_ids")


@S("split_sizes", query("""
  SELECT source AS split, count(*) AS rows, count(*) // 32 * 3 AS steps FROM documents GROUP BY source"""))
def _(w):
    return X.split_sizes(w.documents.select(F.col("source").alias("split")), "split", 32, 3)


def make_scorer():
    def score(frame: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(frame["embedding"].to_numpy()).astype("float64") if len(frame) else np.zeros((0, 64))
        logits = np.stack([values[:, :32].sum(axis=1), values[:, 32:].sum(axis=1)], axis=1)
        return pd.DataFrame({"vec_id": frame["vec_id"], "neg": logits[:, 0], "pos": logits[:, 1]})

    return score


@S("score_batches", query("""
  SELECT vec_id, round(list_sum(list_transform(embedding[1:32], lambda x: x::DOUBLE)), 6) AS neg,
         round(list_sum(list_transform(embedding[33:64], lambda x: x::DOUBLE)), 6) AS pos FROM embeddings"""))
def _(w):
    return X.score_batches(w.table("embeddings").select("vec_id", "embedding"), make_scorer,
                           "vec_id bigint, neg double, pos double")


@S("flatten_columns", query("""
  SELECT doc_id, lang AS meta_lang, source AS meta_source, n_chars AS size_chars FROM documents"""))
def _(w):
    structs = w.documents.select("doc_id", F.struct("lang", "source").alias("meta"), F.struct(F.col("n_chars").alias("chars")).alias("size"))
    return nested.flatten_columns(structs)


@S("nest_columns", query("""
  SELECT event_id, event_type AS kind, user_id AS "user" FROM events"""))
def _(w):
    nest = nested.nest_columns(w.table("events").select("event_id", "event_type", "user_id"), ["event", "user"])
    return nest.select("event.id", F.col("event.type").alias("kind"), F.col("user.id").alias("user")).withColumnRenamed("id", "event_id")


