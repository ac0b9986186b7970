"""Queries over sources, sinks and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.stage import materialize
from textmill.operators.vocabulary import add_tokens
from textmill.plans.report import shown
from textmill.plans.sqlparts import BLANKS, PART, draw, q, query
from textmill.plans.workspace import workspace
from textmill.sources import corpus, layout, metriclog, nested, vocabfile

QUERIES, SQL = {}, {}


def S(name, sql=None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: shown(fn(workspace(spark, folder)))
        if sql:
            SQL[name] = sql
        return fn

    return keep


@S("corpus_lines", query("SELECT doc_id, line_no, line FROM doc_lines"))
def _(w):
    return w.lines


def _page_sql() -> str:
    text = "html"
    for pattern, to in corpus.PAGE_RULES:
        text = f"regexp_replace({text}, {q(pattern)}, {'chr(10)' if to == chr(10) else q(to)}, 'g')"
    for entity, to in corpus.ENTITIES:
        text = f"replace({text}, {q(entity)}, {q(to)})"
    text = f"regexp_replace({text}, '[ \\t\\r\\f]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"SELECT page_id, trim({text}, {BLANKS}) AS text FROM pages WHERE trim({text}, {BLANKS}) <> ''"


PART["page_text"] = _page_sql()


@S("clean_pages", query("SELECT page_id, text FROM page_text"))
def _(w):
    return corpus.clean_pages(w.table("pages").select("page_id", "html"), ["page_id"])


PART["sentences"] = f"""
  SELECT doc_id, sent_no, trim(raw, {BLANKS}) AS sentence
  FROM (SELECT doc_id, unnest(range(len(l))) AS sent_no, unnest(l) AS raw
        FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS l
              FROM documents))
  WHERE trim(raw, {BLANKS}) <> ''"""


@S("sentence_segment", query("SELECT doc_id, sent_no, sentence FROM sentences"))
def _(w):
    return corpus.sentence_segment(w.documents.select("doc_id", "text"), ["doc_id"])


@S("merge_corpora", query("""
  SELECT 'documents' AS corpus, doc_id AS id, text FROM documents
  UNION ALL SELECT 'pages', page_id, text FROM page_text
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations"""))
def _(w):
    pages = corpus.clean_pages(w.table("pages").select("page_id", "html"), ["page_id"])
    return corpus.merge_corpora(
        documents=w.documents.select(F.col("doc_id").alias("id"), "text"),
        pages=pages.select(F.col("page_id").alias("id"), "text"),
        conversations=w.table("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"),
    )


@S("shard_by_line", query("""
  SELECT doc_id, line_no, (row_number() OVER (ORDER BY doc_id, line_no) - 1) % 64 AS shard FROM doc_lines"""))
def _(w):
    return layout.shard(w.lines, 64, "line").select("doc_id", "line_no", "shard")


@S("shard_by_doc", query(f"""
  SELECT doc_id, line_no, floor({draw('shard', 'doc_id')} * 2048)::BIGINT AS shard FROM doc_lines"""))
def _(w):
    return layout.shard(w.lines, 2048, "doc").select("doc_id", "line_no", "shard")


@S("assign_files", query(f"""
  SELECT file, (row_number() OVER (ORDER BY file) - 1) % 7 AS worker FROM (
    SELECT DISTINCT 'part-' || floor({draw('shard', 'doc_id')} * 2048)::BIGINT AS file FROM documents)"""))
def _(w):
    files = layout.shard(w.documents.select("doc_id"), 2048, "doc").select(
        F.concat(F.lit("part-"), F.col("shard").cast("string")).alias("file")
    ).distinct()
    return layout.assign_files(files, 7)


@S("nested_json", query("SELECT doc_id, line_no, raw AS line FROM (SELECT doc_id, unnest(range(len(l))) AS line_no, "
                        "unnest(l) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"))
def _(w):
    items = F.transform(F.split("text", "\n"), lambda t, i: F.struct(
        F.col("doc_id").alias("doc_id"), i.alias("line_no"), t.alias("line")))
    files = w.documents.select("doc_id", "text").select(F.to_json(F.struct(items.alias("data"))).alias("json"))
    return nested.rows_of_field(files, "json", "data", "doc_id bigint, line_no int, line string")


@S("label_map", query("""
  SELECT d.lang AS label, l.id, count(*) AS n FROM documents d
  JOIN (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS id FROM (SELECT DISTINCT lang FROM documents)) l
    ON l.lang = d.lang GROUP BY d.lang, l.id"""))
def _(w):
    docs = w.documents.select(F.col("lang").alias("label"))
    labels = nested.label_map(nested.label_list(docs, "label"))
    with_ids = nested.to_label_id(docs.groupBy("label").agg(F.count("*").alias("n")), labels, "label", "id")
    return nested.to_label(with_ids.select("id", "n"), labels, "id").select("label", "id", "n")


PART["added"] = """
  SELECT token, vocab_size + row_number() OVER (ORDER BY o, token) - 1 AS id FROM (
    SELECT lower(source) AS token, min(doc_id) AS o FROM documents GROUP BY 1
    UNION ALL SELECT lower(url), min(page_id) + 1000000000 FROM pages GROUP BY 1) t,
    (SELECT count(*) AS vocab_size FROM vocab)
  WHERE token NOT IN (SELECT token FROM vocab)"""


def added_vocab(w):
    sources = w.documents.select(F.col("source").alias("token"), F.col("doc_id").alias("o"))
    urls = w.table("pages").select(F.col("url").alias("token"), (F.col("page_id") + 1000000000).alias("o"))
    return add_tokens(w.vocab, sources.unionByName(urls), "o", lower=True)


@S("add_tokens", query("SELECT token, id::BIGINT AS id, source FROM vocab "
                       "UNION ALL SELECT token, id, 'added' FROM added"))
def _(w):
    return added_vocab(w)


@S("vocab_id_gaps", query("""
  SELECT token, id::BIGINT AS id, (id <> coalesce(lag(id) OVER (ORDER BY id), -1) + 1)::BIGINT AS gap
  FROM vocab WHERE source <> 'letter'"""))
def _(w):
    return vocabfile.id_gaps(w.vocab.filter("source <> 'letter'"))


def example_keys(w):
    """Placement reads its rows more than once; written keys keep packing from running again for each."""
    return materialize(w.examples().select("doc_id", "ex"), "example-keys")


@S("place_examples", query(f"""
  SELECT doc_id, ex::BIGINT AS ex, job, seq, job + 4 * (seq % ceil((30 - job) / 4.0)::BIGINT) AS out_file FROM (
    SELECT *, row_number() OVER (PARTITION BY job ORDER BY doc_id, ex) - 1 AS seq FROM (
      SELECT doc_id, ex, floor({draw('job', 'doc_id')} * 4)::BIGINT AS job FROM segments))"""))
def _(w):
    return layout.place_examples(example_keys(w), 30, 4).select("doc_id", "ex", "job", "seq", "out_file")


@S("training_batches", query(f"""
  SELECT doc_id, ex::BIGINT AS ex, epoch, rank, rn // 32 AS batch, rn % 32 AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY epoch, rank ORDER BY u, doc_id, ex) - 1 AS rn FROM (
      SELECT doc_id, ex, e.epoch, (doc_id % 100) % 8 AS rank, {draw('order', "'epoch'", 'doc_id', 'ex')} AS u
      FROM segments, (SELECT unnest(range(2)) AS epoch) e))""").replace("concat_ws(':', '0', 'order', 'epoch',", "concat_ws(':', '0', 'order', e.epoch,"))
def _(w):
    return layout.training_batches(example_keys(w), ["doc_id", "ex"], F.pmod("doc_id", F.lit(100)), 32, 8, epochs=2)


PART["metric_log"] = """
  SELECT event_id, user_id % 4 AS rank, event_id AS step, value, ts,
         CASE event_type WHEN 'click' THEN 'disc_accuracy' WHEN 'view' THEN 'train_perf'
                         WHEN 'error' THEN 'total_loss' ELSE event_type END AS metric
  FROM events"""


def metric_log(w):
    kind = F.col("event_type")
    return w.table("events").select(
        "event_id", F.pmod("user_id", F.lit(4)).alias("rank"), F.col("event_id").alias("step"), "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "click", "disc_accuracy").when(kind == "view", "train_perf").when(kind == "error", "total_loss")
        .otherwise(kind).alias("metric"),
    )


@S("metric_log_lines", query("""
  SELECT rank, 'LOG' AS type, step::VARCHAR AS step, metric, round(value, 6) AS value FROM metric_log"""))
def _(w):
    records = metric_log(w).select(
        "rank", F.lit("LOG").alias("type"), F.col("step").cast("string").alias("step"),
        F.create_map("metric", "value").alias("data"),
    )
    parsed = metriclog.parse_metric_lines(metriclog.format_metric_lines(records))
    return parsed.select("rank", "type", "step", F.explode("data").alias("metric", "value"))


