"""Sequences for single texts and pairs: special tokens, truncation, overflow, padding, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.operators.packing import filled
from textmill.operators.tokenize import Codebook, codebook

NONE = "array<int>"


def empty_ids() -> Column:
    return F.array().cast(NONE)


def cuts(a: Column, b: Column | None, remove: Column, strategy: str) -> tuple[Column, Column]:
    """How many tokens come off the end of A and of B, given their lengths.

    ``longest_first`` in closed form: the longer side loses down to the shorter one, then both lose in
    turn, B first. This equals taking one token at a time from A when strictly longer, else from B.
    """
    k = F.greatest(remove, F.lit(0))
    zero = F.lit(0)
    if strategy == "do_not_truncate":
        error = F.raise_error(F.lit("sequence longer than the maximum length; choose a truncation strategy"))
        return F.when(k > 0, error.cast("int")).otherwise(zero), zero
    if strategy == "only_first" or (b is None and strategy == "longest_first"):
        short = F.raise_error(F.lit("first sequence too short to truncate")).cast("int")
        return F.when((k > 0) & (a <= k), short).otherwise(k) if strategy == "only_first" else F.least(k, a), zero
    if strategy == "only_second":
        short = F.raise_error(F.lit("second sequence too short to truncate")).cast("int")
        return zero, F.when((k > 0) & (b <= k), short).otherwise(k)
    if strategy != "longest_first":
        raise ValueError(f"unknown truncation strategy {strategy}")
    gap = F.least(k, F.abs(a - b))
    rest = k - gap
    off_a = F.when(a > b, gap).otherwise(0) + F.floor(rest / 2)
    off_b = F.when(a > b, 0).otherwise(gap) + F.ceil(rest / 2)
    return off_a.cast("int"), off_b.cast("int")


def truncate(
    df: DataFrame, max_len: int, a: str = "a", b: str | None = "b", strategy: str = "longest_first", stride: int = 0
) -> DataFrame:
    """Cuts ``a`` (and ``b``) so that the sequence with its special tokens fits ``max_len``.

    Adds ``overflow`` (the removed tail with up to ``stride`` kept tokens before it) and ``n_removed``.
    With ``longest_first`` only what came off A overflows.
    """
    len_a = F.size(a)
    len_b = F.size(b) if b else None
    total = len_a + (len_b + 3 if b else F.lit(2))
    remove = F.greatest(total - max_len, F.lit(0))
    off_a, off_b = cuts(len_a, len_b, remove, strategy)
    sized = df.withColumn("_off_a", off_a).withColumn("_off_b", off_b).withColumn("n_removed", remove.cast("int"))
    kept_a = F.size(a) - F.col("_off_a")
    if strategy == "only_second":
        window = F.least(F.size(b), F.col("n_removed") + stride)
        overflow = F.slice(F.col(b), F.size(b) - window + 1, window)
    elif strategy == "only_first":
        window = F.least(F.size(a), F.col("n_removed") + stride)
        overflow = F.slice(F.col(a), F.size(a) - window + 1, window)
    else:
        window = F.least(kept_a, F.lit(stride)) + F.col("_off_a")
        overflow = F.slice(F.col(a), F.size(a) - window + 1, window)
    out = sized.withColumn("overflow", F.when(F.col("n_removed") > 0, overflow).otherwise(empty_ids()))
    if b:
        out = out.withColumn(b, F.slice(F.col(b), F.lit(1), F.size(b) - F.col("_off_b")))
    return out.withColumn(a, F.slice(F.col(a), F.lit(1), kept_a)).drop("_off_a", "_off_b")


def with_specials(df: DataFrame, cls: Column, sep: Column, a: str = "a", b: str | None = "b") -> DataFrame:
    """Adds ``input_ids``, ``token_type_ids``, ``attention_mask`` and ``special_tokens_mask``."""
    first = F.size(a) + 2
    second = F.size(b) + 1 if b else F.lit(0)
    ids = F.concat(F.array(cls), F.col(a), F.array(sep), *([F.col(b), F.array(sep)] if b else []))
    marks = F.concat(
        filled(1, F.lit(1)), filled(0, F.size(a)), filled(1, F.lit(1)),
        *([filled(0, F.size(b)), filled(1, F.lit(1))] if b else []),
    )
    return (
        df.withColumn("input_ids", ids)
        .withColumn("token_type_ids", F.concat(filled(0, first), filled(1, second)))
        .withColumn("attention_mask", filled(1, first + second))
        .withColumn("special_tokens_mask", marks)
    )


# What each sequence column is padded with; specials count padding as special.
PAD_VALUES = {"input_ids": 0, "token_type_ids": 0, "attention_mask": 0, "special_tokens_mask": 1, "labels": -100}


def pad(
    df: DataFrame, to: int | str, columns: list[str], side: str = "right", batch: list[str] | None = None,
    values: dict[str, int] | None = None,
) -> DataFrame:
    """Pads array columns to a fixed length, or with ``to='longest'`` to the longest row of the batch.

    The longest length per batch comes from a pre-aggregated join, so a batch is never gathered.
    """
    if side not in ("left", "right"):
        raise ValueError(f"unknown padding side {side}")
    values = {**PAD_VALUES, **(values or {})}
    if to == "longest":
        longest = df.groupBy(*batch).agg(F.max(F.size(columns[0])).alias("_to"))
        df = df.join(longest, batch)
    else:
        df = df.withColumn("_to", F.lit(to))
    padded = {}
    for name in columns:
        fill = filled(values[name], F.col("_to") - F.size(name))
        padded[name] = F.concat(F.col(name), fill) if side == "right" else F.concat(fill, F.col(name))
    return df.withColumns(padded).drop("_to")


def trim_batch(df: DataFrame, batch: list[str], columns: list[str], pad_id: int = 0) -> DataFrame:
    """Drops the columns of a batch that hold padding in every row."""
    used = (
        df.select(*batch, F.posexplode_outer("input_ids").alias("pos", "id"))
        .filter(F.col("id") != pad_id).select(*batch, "pos").distinct()
        .groupBy(*batch).agg(F.sort_array(F.collect_list("pos")).alias("_used"))  # at most one per column
    )
    joined = df.join(used, batch, "left")
    pick = lambda name: F.transform(F.coalesce("_used", empty_ids()), lambda p: F.element_at(F.col(name), p + 1))
    return joined.withColumns({name: pick(name) for name in columns}).drop("_used")


def stride_windows(
    df: DataFrame, keys: list[str], question: str, context: str | list[str], max_len: int = 384, stride: int = 128
) -> DataFrame:
    """(keys, window, start, q, c): overlapping context windows; ``stride`` is the overlap.

    The question is kept whole. The step must be positive; a question that leaves no room fails. Several contexts are
    arrays of one length, cut alike, and keep their names. A window has its part of the context from the start, so
    that no row carries the whole one along.
    """
    contexts = [context] if isinstance(context, str) else context
    names = ["c"] if isinstance(context, str) else context
    room = F.lit(max_len) - F.size(question) - 3
    step = room - stride
    size = F.size(contexts[0])
    checked = F.when(step <= 0, F.raise_error(F.lit("question leaves no room for the stride")).cast("int")).otherwise(step)
    more = F.ceil(F.greatest(size - room, F.lit(0)) / checked).cast("int")

    def window(no: Column) -> Column:
        start = no * F.col("_step")
        cut = [F.slice(c, start + 1, F.greatest(F.col("_room"), F.lit(0))) for c in contexts]
        return F.struct(no.alias("window"), start.alias("start"), *[c.alias(name) for c, name in zip(cut, names, strict=True)])

    made = df.withColumn("_room", room).withColumn("_step", checked).withColumn("_more", more)
    made = made.select(*keys, F.col(question).alias("q"), F.explode(F.transform(F.sequence(F.lit(0), F.col("_more")), window)).alias("_w"))
    return made.select(*keys, "_w.window", "_w.start", "q", *[f"_w.{name}" for name in names])


def pair_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, text_a, text_b): a user turn with the assistant turn right after it."""
    follow = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b")
    )
    asked = conversations.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("text_a"))
    return asked.join(follow, ["conv_id", "turn"])


def encode_pairs(
    df: DataFrame, keys: list[str], a: str, b: str, vocab: DataFrame | Codebook, lower: bool = True
) -> DataFrame:
    """(keys, a, b): the id arrays of two text columns. Inside the row; no shuffle."""
    book = codebook(vocab, lower)
    coded = df.select(*keys, *[book.text_ids(F.col(text)).alias(out) for text, out in ((a, "_a_ids"), (b, "_b_ids"))])
    return coded.select(*keys, *[F.coalesce(out, empty_ids()).alias(side) for out, side in (("_a_ids", "a"), ("_b_ids", "b"))])
