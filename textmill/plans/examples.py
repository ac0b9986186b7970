"""Queries over packing, masking and corruption."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.draws import uniform_index
from textmill.operators import corrupt as C, packing as P
from textmill.operators.longpacking import pack_long
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, draw, pack_part, query
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


KEYS = ["doc_id", "max_len", "ex"]


def packed(w, lengths=(128,)):
    return P.pack_lines(P.documents_of_lines(w.encoded), list(lengths))


@S("pack_lines", query("""
  SELECT doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex, target::BIGINT AS target, first_line, n_lines FROM segments"""))
def _(w):
    return packed(w).select(
        *KEYS, "target", F.element_at("lines", 1)["line_no"].alias("first_line"), F.size("lines").alias("n_lines")
    )


@S("split_segments", query(f"""
  SELECT doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex, {text_of('a')} AS a, {text_of('b')} AS b FROM segments"""))
def _(w):
    return P.split_segments(packed(w))


EXAMPLE_SQL = f"""
  SELECT doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex, {text_of('input_ids')} AS input_ids,
         {text_of('input_mask')} AS input_mask, {text_of('segment_ids')} AS segment_ids FROM examples"""


@S("assemble_examples", query(EXAMPLE_SQL))
def _(w):
    return w.examples()


@S("pack_lines_long", query("""
  SELECT doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex, target::BIGINT AS target, first_line, n_lines FROM segments"""))
def _(w):
    """The examples of :func:`pack_lines` without a row for a document; small blocks, so that pointers cross many."""
    packed = pack_long(w.encoded, [128], block=64, tokens=512)
    return packed.select(
        "doc_id", "max_len", "ex", "target", F.element_at("lines", 1)["line_no"].alias("first_line"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )


@S("build_examples", query(EXAMPLE_SQL, {"packed": pack_part([128, 512])}))
def _(w):
    return w.examples([128, 512])


def candidates(w):
    ids = [P.token_id(w.vocab, t) for t in ("[CLS]", "[SEP]", "[MASK]")]
    # Special ids become columns first: a subquery may not stand inside a lambda.
    df = w.examples().withColumns({f"_id{i}": c for i, c in enumerate(ids)})
    return C.mask_candidates(df, [F.col(f"_id{i}") for i in range(3)]).drop("_id0", "_id1", "_id2")


def sampled(w, **options):
    return C.sample_positions(candidates(w), **options)


def masked(w):
    return C.apply_mask(sampled(w), P.token_id(w.vocab, "[MASK]"))


PART["slot"] = """
  SELECT doc_id, max_len, ex, pos, id, seg FROM (
    SELECT doc_id, max_len, ex, unnest(range(max_len)) AS pos, unnest(input_ids) AS id, unnest(input_mask) AS m,
           unnest(segment_ids) AS seg FROM examples)
  WHERE m = 1"""
PART["candidate"] = "SELECT * FROM slot WHERE id NOT IN (1, 2, 4)"
PART["budgets"] = """
  SELECT doc_id, max_len, ex, greatest(1, least(floor(0.155 * max_len), round_even(count(*) * 0.15::DOUBLE, 0)))::BIGINT AS budget
  FROM slot GROUP BY doc_id, max_len, ex"""


def _drawn_sql(key: str) -> str:
    return f"""
  SELECT c.doc_id, c.max_len, c.ex, c.pos, c.id FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, max_len, ex ORDER BY {key}, pos) AS rn FROM candidate) c
  JOIN budgets b ON b.doc_id = c.doc_id AND b.max_len = c.max_len AND b.ex = c.ex WHERE c.rn <= b.budget"""


PART["drawn"] = _drawn_sql(draw("mask", "doc_id", "max_len", "ex", "pos"))
PART["drawn_weighted"] = _drawn_sql(f"-ln({draw('mask', 'doc_id', 'max_len', 'ex', 'pos')}) / (1 + pos % 3)")
PART["hidden"] = f"SELECT * FROM drawn WHERE {draw('hide', 'doc_id', 'max_len', 'ex', 'pos')} < 0.85"
PART["masked_row"] = """
  SELECT s.doc_id, s.max_len, s.ex, s.pos, s.id, CASE WHEN h.pos IS NULL THEN s.id ELSE 4 END AS masked,
         d.id AS orig
  FROM slot s
  LEFT JOIN drawn d ON d.doc_id = s.doc_id AND d.max_len = s.max_len AND d.ex = s.ex AND d.pos = s.pos
  LEFT JOIN hidden h ON h.doc_id = s.doc_id AND h.max_len = s.max_len AND h.ex = s.ex AND h.pos = s.pos"""
HEAD = "doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex"
BY = "GROUP BY doc_id, max_len, ex"


@S("mask_candidates", query(f"SELECT {HEAD}, string_agg(pos, ' ' ORDER BY pos) AS candidates FROM candidate {BY}"))
def _(w):
    return candidates(w).select(*KEYS, "candidates")


@S("mask_budget", query(f"SELECT {HEAD}, budget FROM budgets"))
def _(w):
    return sampled(w).select(*KEYS, "budget")


@S("sample_positions", query(f"SELECT {HEAD}, string_agg(pos, ' ' ORDER BY pos) AS positions FROM drawn {BY}"))
def _(w):
    return sampled(w).select(*KEYS, "positions")


@S("sample_positions_weighted",
   query(f"SELECT {HEAD}, string_agg(pos, ' ' ORDER BY pos) AS positions FROM drawn_weighted {BY}"))
def _(w):
    weighted = candidates(w).withColumn(
        "weights", F.transform("input_ids", lambda _, i: (1 + F.pmod(i, F.lit(3))).cast("double"))
    )
    return C.sample_positions(weighted, weights="weights").select(*KEYS, "positions")


@S("sample_positions_replacement", query(f"""
  SELECT {HEAD}, string_agg(pos, ' ' ORDER BY j) AS positions FROM (
    SELECT k.doc_id, k.max_len, k.ex, k.j, c.pos FROM (
      SELECT b.doc_id, b.max_len, b.ex, j, floor({draw('slot', 'b.doc_id', 'b.max_len', 'b.ex', 'j')} * n)::BIGINT AS nth
      FROM (SELECT *, unnest(range(budget)) AS j FROM budgets) b
      JOIN (SELECT doc_id, max_len, ex, count(*) AS n FROM candidate {BY}) t
        ON t.doc_id = b.doc_id AND t.max_len = b.max_len AND t.ex = b.ex) k
    JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id, max_len, ex ORDER BY pos) - 1 AS nth FROM candidate) c
      ON c.doc_id = k.doc_id AND c.max_len = k.max_len AND c.ex = k.ex AND c.nth = k.nth) {BY}"""))
def _(w):
    return sampled(w, replacement=True).select(*KEYS, "positions")


@S("apply_mask", query(f"""
  SELECT {HEAD}, string_agg(masked, ' ' ORDER BY pos) || repeat(' 0', (max_len - count(*))::BIGINT) AS masked_ids,
         coalesce(string_agg(orig, ' ' ORDER BY pos) FILTER (orig IS NOT NULL), '') AS masked_lm_ids
  FROM masked_row {BY}"""))
def _(w):
    return masked(w).select(*KEYS, "masked_ids", "masked_lm_ids")


@S("gather_positions", query(f"""
  SELECT {HEAD}, string_agg(id, ' ' ORDER BY pos) AS ids, string_agg(seg, ' ' ORDER BY pos) AS segments
  FROM (SELECT d.*, s.seg FROM drawn d JOIN slot s
        ON s.doc_id = d.doc_id AND s.max_len = d.max_len AND s.ex = d.ex AND s.pos = d.pos) {BY}"""))
def _(w):
    return sampled(w).select(
        *KEYS, C.gather_positions("input_ids", "positions").alias("ids"),
        C.gather_positions("segment_ids", "positions").alias("segments"),
    )


@S("scatter_update", query(f"""
  SELECT {HEAD}, string_agg(coalesce(v, id), ' ' ORDER BY pos) AS updated,
         string_agg(CASE WHEN v IS NULL THEN 0 ELSE 1 END, ' ' ORDER BY pos) AS changed FROM (
    SELECT e.*, u.v FROM (
      SELECT doc_id, max_len, ex, unnest(range(max_len)) AS pos, unnest(input_ids) AS id FROM examples) e
    LEFT JOIN (
      SELECT doc_id, max_len, ex, p, floor(sum(x) / count(*))::BIGINT AS v FROM (
        SELECT doc_id, max_len, ex, floor({draw('at', 'doc_id', 'max_len', 'ex', 'j')} * 20)::BIGINT AS p, j * 7 AS x
        FROM examples, (SELECT unnest(range(12)) AS j)) WHERE p > 0 GROUP BY doc_id, max_len, ex, p) u
    ON u.doc_id = e.doc_id AND u.max_len = e.max_len AND u.ex = e.ex AND u.p = e.pos) {BY}"""))
def _(w):
    slots = F.sequence(F.lit(0), F.lit(11))
    df = w.examples().withColumns({
        "at": F.transform(slots, lambda j: uniform_index(20, 0, "at", *KEYS, j).cast("int")),
        "to": F.transform(slots, lambda j: j * 7),
    })
    return C.scatter_update(df, "input_ids", "at", "to", "updated", "changed").select(*KEYS, "updated", "changed")


@S("unmask", query(f"SELECT {HEAD}, {text_of('input_ids')} AS restored_ids FROM examples"))
def _(w):
    return C.unmask(masked(w)).select(*KEYS, "restored_ids")


FAKE = f"floor({draw('fake', 'doc_id', 'max_len', 'ex', 'pos')} * (SELECT count(*) FROM vocab))::BIGINT"
OTHER = f"floor({draw('fake', 'doc_id', 'max_len', 'ex', 'pos')} * ((SELECT count(*) FROM vocab) - 1))::BIGINT"


def _replaced_sql(value: str) -> str:
    return f"""
  SELECT {HEAD}, string_agg(v, ' ' ORDER BY pos) || repeat(' 0', (max_len - count(*))::BIGINT) AS corrupted_ids,
         string_agg(CASE WHEN v <> id THEN 1 ELSE 0 END, ' ' ORDER BY pos) || repeat(' 0', (max_len - count(*))::BIGINT) AS is_fake
  FROM (SELECT *, CASE WHEN orig IS NULL THEN id ELSE {value} END AS v FROM masked_row) {BY}"""


def corrupted(w, **options):
    size = w.vocab.agg(F.count("*")).scalar()
    df = masked(w).withColumn("_size", size)
    return C.replace_tokens(df, F.col("_size"), **options)


@S("replace_tokens", query(_replaced_sql(FAKE)))
def _(w):
    return corrupted(w).select(*KEYS, "corrupted_ids", "is_fake")


@S("replace_tokens_never_right", query(_replaced_sql(f"CASE WHEN {OTHER} >= orig THEN {OTHER} + 1 ELSE {OTHER} END")))
def _(w):
    return corrupted(w, never_right=True).select(*KEYS, "corrupted_ids", "is_fake")


@S("preview_masked", query(f"""
  SELECT {HEAD}, string_agg(CASE WHEN orig IS NULL THEN v.token ELSE v.token || ' (' || o.token || ')' END, ' '
                            ORDER BY pos) AS preview
  FROM masked_row m JOIN vocab v ON v.id = m.masked LEFT JOIN vocab o ON o.id = m.orig {BY}"""))
def _(w):
    # The vocabulary is learned with [UNK] at 0, so the padding id is set apart for the preview.
    pad = P.token_id(w.vocab, "[PAD]")
    df = masked(w).withColumn("_pad", pad).withColumn(
        "masked_ids", F.transform(F.arrays_zip("masked_ids", "input_mask"),
                                  lambda x: F.when(x["input_mask"] == 1, x["masked_ids"]).otherwise(F.col("_pad")))
    )
    return C.preview_masked(df, w.vocab)


