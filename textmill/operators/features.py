"""Task features: aligned tags, question answering windows and spans, batch plans, batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.draws import uniform
from textmill.functions.origin import origin, with_origin
from textmill.functions.prefix import hashed_rank, running_total
from textmill.functions.text import words_of
from textmill.operators.answerspans import best_pairs, pack, ranked
from textmill.operators.encode import stride_windows
from textmill.operators.packing import filled
from textmill.operators.pieces import MARK, bounds
from textmill.operators.tokenize import Codebook, codebook, with_spans_of_tokens

IGNORED = -100
MOST = (1 << 31) - 1
BAR = "\u00a6"  # neither punctuation nor a letter, and as common a character as splitting knows


def align_labels(
    df: DataFrame, keys: list[str], vocab: DataFrame | Codebook, cls: Column, sep: Column, tokens: str = "tokens",
    tags: str = "tags", label_all: bool = False,
) -> DataFrame:
    """(keys, input_ids, labels): the first piece of a word gets its tag, later pieces the tag or -100,
    special tokens -100. A given token that splits further keeps its own first piece as the first one."""
    book = codebook(vocab)
    # All words of a sentence in one array, with a mark ahead of those of each token. A sentence without one of its
    # own has a mark that is a word; else, and where added tokens could reach over it, its tokens are split one by one.
    df = df.withColumn("_whole", F.concat(F.lit(f"{BAR} "), F.array_join(tokens, f" {BAR} ")))
    fast = ~F.exists(tokens, lambda t: t.contains(BAR)) if book.tokens is None else F.lit(False)
    split = lambda t: words_of(t, book.lower, book.tokens)
    words = F.when(F.size(tokens) == 0, F.array().cast("array<string>")).when(
        fast, split(F.col("_whole"))
    ).otherwise(F.flatten(F.transform(tokens, lambda t: F.concat(F.array(F.lit(MARK)), split(t)))))
    known = ~F.exists(tokens, lambda t: t.isNull()) & (F.size(tags) <= F.size(tokens))
    rows = df.withColumn("_words", F.when(known, words)).withColumn("_mark", F.when(fast, BAR).otherwise(MARK))
    ints = F.col(tags).cast("array<int>")
    rows = rows.withColumn("_made", book.labelled(F.col("_words"), F.col("_mark"), ints, None if label_all else IGNORED))
    none = F.array().cast("array<int>")
    ids, labels = F.coalesce("_made.ids", none), F.coalesce("_made.labels", none)
    return rows.select(
        *keys, F.concat(F.array(cls), ids, F.array(sep)).alias("input_ids"),
        F.concat(filled(IGNORED, F.lit(1)), labels, filled(IGNORED, F.lit(1))).alias("labels"),
    )


def offsets_by_row(df: DataFrame, keys: list[str], text: str, vocab: DataFrame | Codebook) -> DataFrame:
    """(keys, pieces): the token spans of a text in order, as a struct of three arrays side by side: ids, s and e."""
    book = codebook(vocab)
    return with_origin(with_spans_of_tokens(df, text, "pieces", book).select(*keys, "pieces"), df, keys, text, book)


def qa_windows(
    examples: DataFrame, questions: DataFrame, contexts: DataFrame, cls: Column, sep: Column, max_len: int = 384,
    stride: int = 128, pad_id: int = 0,
) -> DataFrame:
    """(id, window, input_ids, offsets, c_first, c_count): question and context windows with character offsets.

    ``examples``: (id, question_id, context_id, …); ``questions``: (question_id, ids);
    ``contexts``: (context_id, pieces) of :func:`offsets_by_row`. ``offsets`` is null outside the context; ``c_first``
    is the index of the first context token, ``c_count`` how many there are. Where ``contexts`` come right from
    :func:`offsets_by_row`, texts are joined and their spans worked out behind, since texts take less to move.
    """
    joined = examples.join(questions.withColumnRenamed("ids", "q_ids"), "question_id", "left")
    made = origin(contexts)
    if made and made.keys == ["context_id"]:
        joined = joined.join(made.texts.select("context_id", F.col(made.text).alias("_context")), "context_id", "left")
        joined = with_spans_of_tokens(joined, "_context", "c_pieces", made.book).drop("_context")
    else:
        joined = joined.join(contexts.withColumnRenamed("pieces", "c_pieces"), "context_id", "left")
    # A blank text has no pieces and no row among its kind.
    none = F.array().cast("array<int>")
    joined = joined.withColumn("q_ids", F.coalesce("q_ids", F.array().cast(joined.schema["q_ids"].dataType))).withColumns(
        {name: F.coalesce(f"c_pieces.{name}", none) for name in ("ids", "s", "e")}
    )
    windows = stride_windows(joined, examples.columns, "q_ids", ["ids", "s", "e"], max_len, stride)
    body = F.concat(F.array(cls), F.col("q"), F.array(sep), F.col("ids"), F.array(sep))
    span = "struct<s:int,e:int>"
    nothing = lambda n: F.array_repeat(F.lit(None).cast(span), n.cast("int"))
    before = F.size("q") + 2
    after = F.lit(max_len) - before - F.size("ids")
    return windows.select(
        *examples.columns, "window",
        F.concat(body, filled(pad_id, F.lit(max_len) - F.size(body))).alias("input_ids"),
        F.concat(nothing(before), F.arrays_zip("s", "e"), nothing(after)).alias("offsets"),
        before.cast("int").alias("c_first"), F.size("ids").alias("c_count"),
    )


def _answer_places(offsets: pa.Array, begin: pa.Array, end: pa.Array) -> pa.Array:
    """The last context token of each row that begins at ``begin`` or before, and the first that ends at ``end`` or
    behind; null without them."""
    flat, first = offsets.flatten(), bounds(offsets)
    row = np.repeat(np.arange(len(offsets)), np.diff(first))
    place = np.arange(len(row)) - first[row]
    s, e = pc.struct_field(flat, "s"), pc.struct_field(flat, "e")
    inner = np.flatnonzero(s.is_valid().to_numpy(zero_copy_only=False))
    row, place, s, e = row[inner], place[inner], s.take(pa.array(inner)), e.take(pa.array(inner))
    found = []
    for hit, last in (
        (pc.less_equal(s.cast(pa.int64()), begin.take(pa.array(row))), True),
        (pc.greater_equal(e.cast(pa.int64()), end.take(pa.array(row))), False),
    ):
        hits = np.flatnonzero(pc.fill_null(hit, False).to_numpy(zero_copy_only=False))
        made = np.full(len(offsets), -1 if last else MOST, dtype=np.int64)
        (np.maximum if last else np.minimum).at(made, row[hits], place[hits])
        found.append(pa.array(made, pa.int32(), mask=(made < 0) | (made == MOST)))
    return pa.StructArray.from_arrays(found, ["s", "e"])


def qa_train_features(windows: DataFrame, answer_start: str, answer_text: str) -> DataFrame:
    """Adds ``start_position``/``end_position``: token indexes of the answer, 0 (the [CLS] index) when there
    is no answer or it does not lie inside the window. Only context tokens are searched."""
    begin = F.col(answer_start).cast("bigint")
    end = begin + F.length(answer_text)
    body = lambda offsets, begin, end: _answer_places(offsets, begin, end)
    df = windows.withColumn("_at", F.arrow_udf(body, "struct<s:int,e:int>")(F.col("offsets"), begin, end))
    inside = begin.isNotNull() & F.col("_at.s").isNotNull() & F.col("_at.e").isNotNull()
    return df.withColumns({
        "start_position": F.when(inside, F.col("_at.s")).otherwise(0).cast("int"),
        "end_position": F.when(inside, F.col("_at.e")).otherwise(0).cast("int"),
    }).drop("_at")


def qa_eval_features(windows: DataFrame) -> DataFrame:
    """(id, window, input_ids, offsets): what span choice needs."""
    return windows.select("id", "window", "input_ids", "offsets")


def qa_best_spans(
    features: DataFrame, logits: DataFrame, contexts: DataFrame, n_best: int = 20, max_answer: int = 30,
    no_answer: bool = False,
) -> DataFrame:
    """(id, prediction, score): the best-scoring text span over all windows of an example.

    ``features``: (id, window, offsets), the offsets as they are or by :func:`pack`; ``logits``: (id, window,
    start_logits, end_logits); ``contexts``: (id, context). Per window the ``n_best`` starts meet the ``n_best`` ends
    inside the row, in Arrow batches (``operators/answerspans.py``), so at most n_best squared candidates a window exist
    at a time and only one leaves it. Ties: earlier window, start, end.
    """
    # Only what is needed of either side goes to the join: the spans as bytes, and the best places of the logits.
    spans = features.select("id", "window", F.col("offsets") if dict(features.dtypes)["offsets"] == "binary" else pack("offsets").alias("offsets"))
    best = logits.select("id", "window", ranked("start_logits", n_best).alias("_starts"), ranked("end_logits", n_best).alias("_ends"))
    paired = best_pairs(spans.join(best, ["id", "window"]), "offsets", "_starts", "_ends", max_answer, "_top")
    top = F.struct("_top.score", (-F.col("window")).alias("w"), "_top.a", "_top.b", "_top.s", "_top.e")
    per_window = paired.select(
        "id", (F.col("_starts.first") + F.col("_ends.first")).alias("_null"), F.when(F.col("_top").isNotNull(), top).alias("top")
    )
    per_example = per_window.groupBy("id").agg(F.max("top").alias("top"), F.max("_null").alias("null_score"))
    text = F.substring("context", F.col("top.s") + 1, F.col("top.e") - F.col("top.s"))
    answer = F.when(F.col("top").isNull(), "").otherwise(text)
    if no_answer:
        answer = F.when(F.coalesce(F.col("top.score"), F.lit(0.0)) > F.col("null_score"), answer).otherwise("")
    return contexts.join(per_example, "id", "left").select(
        "id", answer.alias("prediction"), F.coalesce("top.score", F.lit(0.0)).alias("score"), "null_score"
    )


def batch_plan(df: DataFrame, keys: list[str], batch: int, shuffle: bool = True, seed: int = 0) -> DataFrame:
    """Adds ``batch`` and ``pos``: a seeded order (or the order of the keys) cut into fixed batches."""
    if shuffle:
        ranked = hashed_rank(df.withColumn("_u", uniform(seed, "batch", *keys)), "_u", keys, "_rn").drop("_u")
    else:
        ranked = running_total(df, keys[0], F.lit(1), "_rn", ties=keys[1:])
    return ranked.withColumn("batch", F.floor(F.col("_rn") / batch)).withColumn(
        "pos", F.pmod(F.col("_rn"), F.lit(batch))
    ).drop("_rn")


def split_sizes(df: DataFrame, split: str, batch: int, epochs: int) -> DataFrame:
    """(split, rows, steps): full batches per split times epochs."""
    return df.groupBy(split).agg(F.count("*").alias("rows")).withColumn(
        "steps", F.floor(F.col("rows") / batch) * epochs
    )


def score_batches(
    df: DataFrame, make: Callable[[], Callable], schema: str
) -> DataFrame:
    """Runs a user's scorer over Arrow batches of rows: ``make`` loads it once per task, the scorer maps a
    pandas frame to a frame of ``schema`` (pass key columns through)."""
    def run(batches: Iterator) -> Iterator:
        scorer = make()
        for frame in batches:
            yield scorer(frame)

    return df.mapInPandas(run, schema)
