"""Queries over metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.drawn import uniform_each
from textmill.functions.draws import uniform
from textmill.operators import corrupt as C, metrics as M
from textmill.operators.tokenize import split_rows
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, draw, query
from textmill.plans.tasks import qa_examples
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


PART["scored"] = f"""
  SELECT vec_id, label::BIGINT AS ref, embedding, (list_position(l, list_max(l)) - 1)::BIGINT AS pred,
         0.5 + {draw('weight', 'vec_id')} AS weight, embedding[1]::DOUBLE AS x
  FROM (SELECT *, embedding[1:10] AS l FROM embeddings)"""


def scored(w):
    return w.table("embeddings").withColumn("logits", F.slice("embedding", 1, 10)).select(
        "vec_id", F.col("label").alias("ref"), "embedding", "logits", M.argmax("logits").alias("pred"),
        (uniform(0, "weight", "vec_id") + 0.5).alias("weight"), F.element_at("embedding", 1).cast("double").alias("x"),
    )


@S("accuracy", query("""
  SELECT 'share' AS kind, round(avg((pred = ref)::INT), 6) AS accuracy FROM scored
  UNION ALL SELECT 'count', sum((pred = ref)::INT)::DOUBLE FROM scored
  UNION ALL SELECT 'weighted', round(sum(weight * (pred = ref)::INT) / sum(weight), 6) FROM scored"""))
def _(w):
    s = scored(w)
    kinds = {"share": M.accuracy(s, "pred", "ref"), "count": M.accuracy(s, "pred", "ref", normalize=False),
             "weighted": M.accuracy(s, "pred", "ref", weight="weight")}
    out = None
    for kind, df in kinds.items():
        part = df.select(F.lit(kind).alias("kind"), "accuracy")
        out = part if out is None else out.unionByName(part)
    return out


PART["per_label"] = """
  SELECT l.label, l.label <> 11 AS known, coalesce(sum(w) FILTER (pred = l.label AND ref = l.label), 0) AS tp,
         coalesce(sum(w) FILTER (pred = l.label), 0) AS np, coalesce(sum(w) FILTER (ref = l.label), 0) AS nr, wt
  FROM (SELECT unnest(range(12)) AS label) l,
       (SELECT pred, ref, 1.0::DOUBLE AS w, 'plain' AS wt FROM scored UNION ALL SELECT pred, ref, weight, 'weighted' FROM scored)
  GROUP BY l.label, wt"""
PART["label_f1"] = "SELECT *, CASE WHEN np + nr = 0 THEN 0 ELSE 2 * tp / (np + nr) END AS f1 FROM per_label"


@S("f1", query("""
  SELECT 'binary' AS average, round(f1, 6) AS f1 FROM label_f1 WHERE label = 3 AND wt = 'plain'
  UNION ALL SELECT 'binary weighted rows', round(f1, 6) FROM label_f1 WHERE label = 3 AND wt = 'weighted'
  UNION ALL SELECT 'micro', round(2 * sum(tp) / sum(np + nr), 6) FROM label_f1 WHERE wt = 'plain'
  UNION ALL SELECT 'macro', round(avg(f1), 6) FROM label_f1 WHERE wt = 'plain' AND np + nr > 0
  UNION ALL SELECT 'macro fixed labels', round(avg(f1), 6) FROM label_f1 WHERE wt = 'plain'
  UNION ALL SELECT 'weighted', round(sum(f1 * nr) / sum(nr), 6) FROM label_f1 WHERE wt = 'plain'
  UNION ALL SELECT 'samples', round(avg(CASE WHEN a + b = 0 THEN 0 ELSE 2.0 * h / (a + b) END), 6) FROM (
    SELECT list_sum(list_transform(range(1, 11), lambda i: (embedding[i] > 0)::INT)) AS a,
           list_sum(list_transform(range(1, 11), lambda i: (embedding[i + 10] > 0)::INT)) AS b,
           list_sum(list_transform(range(1, 11), lambda i: (embedding[i] > 0 AND embedding[i + 10] > 0)::INT)) AS h FROM scored)"""))
def _(w):
    s = scored(w)
    fixed = w.spark.range(12).select(F.col("id").cast("int").alias("label"))
    marks = s.select(
        F.transform(F.slice("embedding", 1, 10), lambda v: F.when(v > 0, 1).otherwise(0)).alias("p"),
        F.transform(F.slice("embedding", 11, 10), lambda v: F.when(v > 0, 1).otherwise(0)).alias("r"),
    )
    kinds = {
        "binary": M.f1(s, "pred", "ref", "binary", 3), "binary weighted rows": M.f1(s, "pred", "ref", "binary", 3, "weight"),
        "micro": M.f1(s, "pred", "ref", "micro"), "macro": M.f1(s, "pred", "ref", "macro"),
        "macro fixed labels": M.f1(s, "pred", "ref", "macro", labels=fixed),
        "weighted": M.f1(s, "pred", "ref", "weighted"), "samples": M.f1(marks, "p", "r", "samples"),
    }
    out = None
    for kind, df in kinds.items():
        part = df.select(F.lit(kind).alias("average"), "f1")
        out = part if out is None else out.unionByName(part)
    return out


@S("f1_per_label", query("SELECT label, round(f1, 6) AS f1 FROM label_f1 WHERE wt = 'plain' AND np + nr > 0"))
def _(w):
    return M.f1(scored(w), "pred", "ref", None)


@S("spearman", query("""
  SELECT round(corr(rx, ry), 6) AS rho FROM (
    SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
           rank() OVER (ORDER BY ref) + (count(*) OVER (PARTITION BY ref) - 1) / 2.0 AS ry FROM scored)"""))
def _(w):
    return M.spearman(scored(w), "x", "ref")


# The same continued fraction, a row a step; the gamma functions are the engine's own.
PART["beta_input"] = """
  SELECT (n - 2) / 2.0::DOUBLE AS a, rho * rho AS s FROM (
    SELECT corr(rx, ry) AS rho, count(*) AS n FROM (
      SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY ref) + (count(*) OVER (PARTITION BY ref) - 1) / 2.0 AS ry FROM scored))"""
PART["beta_side"] = """
  SELECT *, CASE WHEN first THEN a ELSE 0.5 END AS p, CASE WHEN first THEN 0.5 ELSE a END AS q,
         CASE WHEN first THEN 1 - s ELSE s END AS x FROM (SELECT *, 1 - s < (a + 1) / (a + 2.5) AS first FROM beta_input)"""
PART["beta_step"] = """
  SELECT 0 AS m, p, q, x, 1.0::DOUBLE AS c, 1 / (1 - (p + q) * x / (p + 1)) AS d, 1 / (1 - (p + q) * x / (p + 1)) AS h FROM beta_side
  UNION ALL
  SELECT m, p, q, x, 1 + odd / c, 1 / (1 + odd * d), h * (1 + odd / c) / (1 + odd * d) FROM (
    SELECT m, p, q, x, 1 + even / c AS c, 1 / (1 + even * d) AS d, h * (1 + even / c) / (1 + even * d) AS h,
           -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 2 * m + 1)) AS odd FROM (
      SELECT m + 1 AS m, p, q, x, c, d, h,
             (m + 1) * (q - m - 1) * x / ((p + 2 * m + 1) * (p + 2 * m + 2)) AS even FROM beta_step WHERE m < 400))"""


@S("spearman_pvalue", query("""
  SELECT round(rho, 6) AS rho, round(CASE WHEN first THEN value ELSE 1 - value END, 6) AS p FROM (
    SELECT corr(rx, ry) AS rho FROM (
      SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY ref) + (count(*) OVER (PARTITION BY ref) - 1) / 2.0 AS ry FROM scored)),
    (SELECT first, exp(lgamma(a + 0.5) - lgamma(a) - lgamma(0.5) + a * ln(1 - s) + ln(s) / 2) * h / b.p AS value
     FROM beta_side b, (SELECT h FROM beta_step WHERE m = 400))"""))
def _(w):
    return M.spearman(scored(w), "x", "ref", pvalue=True)


def _tags(column, tag):
    draw = lambda name: uniform_each(0, name, "doc_id", "line_no", numbers="pos")

    def one(u, v):
        kind = F.when(v < 0.5, "PER").otherwise("LOC")
        return F.when(u < 0.5, "O").when(u < 0.75, F.concat(F.lit("B-"), kind)).otherwise(F.concat(F.lit("I-"), kind))

    return F.zip_with(draw(tag), draw(tag + "2"), one).alias(column)


def _tag_sql(tag: str) -> str:
    u, v = draw(tag, "doc_id", "line_no", "pos"), draw(tag + "2", "doc_id", "line_no", "pos")
    return f"(CASE WHEN {u} < 0.5 THEN 'O' ELSE (CASE WHEN {u} < 0.75 THEN 'B-' ELSE 'I-' END) || (CASE WHEN {v} < 0.5 THEN 'PER' ELSE 'LOC' END) END)"


PART["tags"] = f"""
  SELECT doc_id, line_no, pos, ref, CASE WHEN {draw('same', 'doc_id', 'line_no', 'pos')} < 0.7 THEN ref ELSE other END AS pred
  FROM (SELECT doc_id, line_no, pos, {_tag_sql('ref')} AS ref, {_tag_sql('other')} AS other FROM line_occ)"""


def _spans_sql(tag: str) -> str:
    return f"""
  SELECT doc_id, line_no, any_value(kind) AS type, min(pos) AS s, max(pos) AS e FROM (
    SELECT *, sum(opens) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS span FROM (
      SELECT *, (tag <> 'O' AND (tag[1] = 'B' OR prev IS NULL OR prev = 'O' OR prev[3:] <> kind))::INT AS opens FROM (
        SELECT doc_id, line_no, pos, {tag} AS tag, {tag}[3:] AS kind,
               lag({tag}) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS prev FROM tags)))
  WHERE tag <> 'O' GROUP BY doc_id, line_no, span"""


PART["pred_span"] = _spans_sql("pred")
PART["ref_span"] = _spans_sql("ref")


def tags(w):
    """A row for each line, with its tags as arrays: nothing is exploded, shuffled or gathered again."""
    size = F.size("words")
    pos = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    occ = split_rows(w.lines, ["doc_id", "line_no"], "line").select("doc_id", "line_no", pos.alias("pos"))
    same = uniform_each(0, "same", "doc_id", "line_no", numbers="pos")
    drawn = occ.select("doc_id", "line_no", "pos", _tags("ref", "ref"), _tags("other", "other"), same.alias("same"))
    # Side by side, as a list that a lambda looks into would be folded into it and made for each element.
    pred = F.transform(F.arrays_zip("ref", "other", "same"), lambda x: F.when(x["same"] < 0.7, x["ref"]).otherwise(x["other"]))
    return drawn.select("doc_id", "line_no", "pos", "ref", pred.alias("pred"))


@S("entity_spans", query("SELECT doc_id, line_no, type, s, e FROM ref_span"))
def _(w):
    return M.entity_spans(tags(w), ["doc_id", "line_no"], "pos", "ref")


@S("entity_scores", query("""
  SELECT round(tp / np, 6) AS precision, round(tp / nr, 6) AS recall, round(2 * tp / (np + nr), 6) AS f1,
         round(acc, 6) AS accuracy FROM (
    SELECT (SELECT count(*) FROM pred_span p JOIN ref_span r ON r.doc_id = p.doc_id AND r.line_no = p.line_no
              AND r.type = p.type AND r.s = p.s AND r.e = p.e)::DOUBLE AS tp,
           (SELECT count(*) FROM pred_span)::DOUBLE AS np, (SELECT count(*) FROM ref_span)::DOUBLE AS nr,
           (SELECT avg((pred = ref)::INT) FROM tags) AS acc)"""))
def _(w):
    return M.entity_scores(tags(w), ["doc_id", "line_no"], "pos", "pred", "ref")


def _answer_sql(x: str) -> str:
    bare = f"regexp_replace(lower({x}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    # \b is ASCII-only in this engine; the corpus engine's is too for these articles next to letters.
    return f"trim(regexp_replace(regexp_replace({bare}, '\\b(a|an|the)\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


PART["answer_pair"] = f"""
  SELECT id, no, {_answer_sql('guess')} AS p, {_answer_sql('answer')} AS g FROM (
    SELECT id, guess, 0 AS no, answer_text AS answer FROM qa_example WHERE answer_text IS NOT NULL
    UNION ALL SELECT id, guess, 1, substr(guess, 1, 12) FROM qa_example WHERE answer_text IS NOT NULL)"""
PART["answer_word"] = """
  SELECT id, no, w, sum(p) AS np, sum(g) AS ng FROM (
    SELECT id, no, unnest(string_split(p, ' ')) AS w, 1 AS p, 0 AS g FROM answer_pair
    UNION ALL SELECT id, no, unnest(string_split(g, ' ')), 0, 1 FROM answer_pair) WHERE w <> '' GROUP BY id, no, w"""
PART["answer_score"] = """
  SELECT a.id, max((a.p = a.g)::INT)::DOUBLE AS exact, max(coalesce(2.0 * same / n, 0))::DOUBLE AS f1
  FROM answer_pair a LEFT JOIN (
    SELECT id, no, sum(least(np, ng)) AS same, sum(np + ng) AS n FROM answer_word GROUP BY id, no) s
  ON s.id = a.id AND s.no = a.no GROUP BY a.id"""


def answers(w):
    known = qa_examples(w).filter(F.col("answer_text").isNotNull())
    return known.select("id", "guess", F.array("answer_text", F.substring("guess", 1, 12)).alias("answers"))


@S("squad_pairs", query("SELECT id, exact, round(f1, 6) AS f1 FROM answer_score"))
def _(w):
    return M.squad_pairs(answers(w), "guess", "answers")


@S("squad_scores", query("SELECT round(100 * avg(exact), 6) AS exact_match, round(100 * avg(f1), 6) AS f1 FROM answer_score"))
def _(w):
    return M.squad_scores(answers(w), "guess", "answers")


PART["gumbel"] = f"""
  SELECT vec_id, arg_max(c, score) AS sampled, max(score) AS score FROM (
    SELECT vec_id, c, v / 0.7 - CASE WHEN c = label THEN 1000.0 ELSE 0.0 END
           - ln(-ln({draw('gumbel', 'vec_id', 'c')} + 1e-9) + 1e-9) AS score
    FROM (SELECT vec_id, label, unnest(range(64)) AS c, unnest(embedding)::DOUBLE AS v FROM embeddings))
  GROUP BY vec_id"""


@S("sample_from_logits", query("SELECT vec_id, sampled, round(score, 6) AS score FROM gumbel"))
def _(w):
    return C.sample_from_logits(w.table("embeddings"), ["vec_id"], "embedding", 0.7, "label")


PART["slot_rows"] = f"""
  SELECT s.vec_id, s.ref AS label, s.pred, g.sampled, ({draw('on', 's.vec_id')} < 0.8)::INT AS weight,
         ln(list_sum(list_transform(s.embedding[1:10], lambda v: exp(v::DOUBLE)))) - s.embedding[s.ref + 1]::DOUBLE AS loss
  FROM scored s JOIN gumbel g ON g.vec_id = s.vec_id"""
PART["token_rows"] = f"""
  SELECT vec_id, i, v AS logit, ({draw('is', 'vec_id', 'i')} < 0.15)::INT AS label,
         ({draw('on', 'vec_id', 'i')} < 0.9)::INT AS mask, (v > 0)::INT AS pred
  FROM (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)"""


def slot_rows(w):
    sampled = C.sample_from_logits(w.table("embeddings"), ["vec_id"], "embedding", 0.7, "label").select("vec_id", "sampled")
    return scored(w).join(sampled, "vec_id").select(
        "vec_id", F.col("ref").alias("label"), "pred", "sampled", "logits",
        (uniform(0, "on", "vec_id") < 0.8).cast("int").alias("weight"), M.cross_entropy("logits", "ref").alias("loss"),
    )


def token_rows(w):
    long = w.table("embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    logit = F.col("v").cast("double")
    return long.select(
        "vec_id", "i", logit.alias("logit"), (uniform(0, "is", "vec_id", "i") < 0.15).cast("int").alias("label"),
        (uniform(0, "on", "vec_id", "i") < 0.9).cast("int").alias("mask"), M.by_sign(logit).alias("pred"),
    )


SIGMOID = "greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))"


@S("masked_metrics", query(f"""
  SELECT round(sum(weight * (pred = label)::INT) / sum(weight), 6) AS masked_lm_accuracy,
         round(sum(weight * loss) / sum(weight), 6) AS masked_lm_loss,
         round(sum(weight * (sampled = label)::INT) / sum(weight), 6) AS sampled_masked_lm_accuracy,
         any_value(disc_loss) AS disc_loss, any_value(disc_accuracy) AS disc_accuracy,
         any_value(disc_precision) AS disc_precision, any_value(disc_recall) AS disc_recall
  FROM slot_rows, (
    SELECT round(avg({SIGMOID}), 6) AS disc_loss, round(sum(mask * (pred = label)::INT) / sum(mask), 6) AS disc_accuracy,
           round(sum(mask * pred * (pred = label)::INT) / sum(mask * pred), 6) AS disc_precision,
           round(sum(mask * label * (pred = label)::INT) / sum(mask * label), 6) AS disc_recall FROM token_rows)"""))
def _(w):
    tokens = token_rows(w)
    loss = M.sigmoid_cross_entropy(F.col("logit"), F.col("label").cast("double"))
    return M.masked_metrics(slot_rows(w), tokens.withColumn("loss", loss))


@S("token_losses", query(f"""
  SELECT round(gen, 6) AS gen_loss, round(disc, 6) AS disc_loss, round(gen + 50 * disc, 6) AS total_loss FROM
    (SELECT sum(weight * loss) / (sum(weight) + 1e-6) AS gen FROM slot_rows),
    (SELECT sum(mask * ({SIGMOID})) / (sum(mask) + 1e-6) AS disc FROM token_rows)"""))
def _(w):
    return M.token_losses(slot_rows(w), token_rows(w))


@S("top_k_labels", query("""
  SELECT vec_id, r - 1 AS rank, c AS id, 'class ' || c AS label, round(exp(v) / total, 6) AS score FROM (
    SELECT vec_id, c, v, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, c) AS r,
           sum(exp(v)) OVER (PARTITION BY vec_id) AS total
    FROM (SELECT vec_id, unnest(range(10)) AS c, unnest(embedding[1:10])::DOUBLE AS v FROM embeddings)) WHERE r <= 3"""))
def _(w):
    names = w.table("embeddings").select(F.concat(F.lit("class "), F.col("label").cast("string")).alias("label"))
    labels = nested.label_map(nested.label_list(names, "label"))
    return M.top_k_labels(scored(w), ["vec_id"], "logits", 3, labels).select("vec_id", "rank", "id", "label", "score")


@S("decide_labels", query("""
  SELECT vec_id, pred, round(embedding[1]::DOUBLE, 6) AS regression, (x > 0)::BIGINT AS sign FROM scored"""))
def _(w):
    return scored(w).select("vec_id", "pred", F.element_at("logits", 1).alias("regression"), M.by_sign(F.col("x")).alias("sign"))


@S("roc_auc", query("""
  SELECT round(sum(CASE WHEN p = 1 THEN r END) / (sum(p) * sum(1 - p)) - (sum(p) + 1) / 2.0 / sum(1 - p), 6) AS auc FROM (
    SELECT p, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
    FROM (SELECT round(x, 2) AS s, (ref >= 5)::INT AS p FROM scored))"""))
def _(w):
    s = scored(w).select(F.round("x", 2).alias("s"), (F.col("ref") >= 5).cast("int").alias("p"))
    return M.roc_auc(s, "s", "p")
