"""Packing encoded lines into fixed-length two-segment examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.draws import uniform

SHORT_TARGET = 0.05
SINGLE_SEGMENT = 0.1
NO_LIMIT = 100_000
CHUNK = 256


def example_target(seed: int, doc: Column, max_len, first: Column) -> Column:
    """The token count an example is filled to: now and then a random shorter one. Drawn by the number of the line
    it begins at, so that it does not depend on the examples before."""
    full = F.lit(max_len) if isinstance(max_len, int) else max_len
    keys = (doc, full, first)
    short = F.lit(5) + F.floor(uniform(seed, "target", *keys) * (full - 4)).cast("int")
    return F.when(uniform(seed, "short", *keys) < SHORT_TARGET, short).otherwise(full)


def documents_of_lines(encoded: DataFrame) -> DataFrame:
    """(doc_id, lines): the encoded lines of a document in order. A document is one input row to begin
    with, so this array is no larger than the cell it was read from (times the width of an id)."""
    return encoded.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "ids"))).alias("lines")
    )


def example_bounds(lines: Column, doc: Column, max_len: Column, seed: int) -> Column:
    """array<struct<ex,first,count,target>>: a running sum with reset over the line lengths.

    Finished bounds move to ``done`` in chunks, which keeps the copying linear for long documents.
    """
    bound = "struct<ex:int,first:int,count:int,target:int>"
    begin = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("tokens"), F.lit(0).alias("ex"), F.lit(0).alias("first"),
        example_target(seed, doc, max_len, F.lit(0)).cast("int").alias("target"),
        F.array().cast(f"array<{bound}>").alias("chunk"),
        F.array().cast(f"array<array<{bound}>>").alias("done"),
    )

    def closed(acc: Column, count: Column) -> Column:
        return F.struct(
            acc["ex"].alias("ex"), acc["first"].alias("first"), count.alias("count"), acc["target"].alias("target")
        )

    def step(acc: Column, line: Column) -> Column:
        tokens = acc["tokens"] + F.size(line["ids"])
        after = acc["at"] + 1
        grown = F.struct(
            after.alias("at"), tokens.alias("tokens"), acc["ex"].alias("ex"), acc["first"].alias("first"),
            acc["target"].alias("target"), acc["chunk"].alias("chunk"), acc["done"].alias("done"),
        )
        listed = F.concat(acc["chunk"], F.array(closed(acc, after - acc["first"])))
        spill = F.size(acc["chunk"]) >= CHUNK - 1
        reset = F.struct(
            after.alias("at"), F.lit(0).alias("tokens"), (acc["ex"] + 1).alias("ex"), after.alias("first"),
            example_target(seed, doc, max_len, after).cast("int").alias("target"),
            F.when(spill, F.array().cast(f"array<{bound}>")).otherwise(listed).alias("chunk"),
            F.when(spill, F.concat(acc["done"], F.array(listed))).otherwise(acc["done"]).alias("done"),
        )
        return F.when(tokens >= acc["target"], reset).otherwise(grown)

    def finish(acc: Column) -> Column:
        # What is left at the document end is an example unless it holds no token.
        rest = F.when(acc["tokens"] > 0, F.array(closed(acc, acc["at"] - acc["first"]))).otherwise(
            F.array().cast(f"array<{bound}>")
        )
        return F.concat(F.flatten(acc["done"]), acc["chunk"], rest)

    return F.aggregate(lines, begin, step, finish)


def pack_lines(documents: DataFrame, lengths: list[int], seed: int = 0) -> DataFrame:
    """(doc_id, max_len, ex, target, lines): the lines of each example, for every wanted length.

    Works inside the document row, so packing needs no shuffle of its own.
    """
    sized = documents.withColumn("max_len", F.explode(F.array(*[F.lit(n) for n in lengths])))
    bounds = sized.select(
        "doc_id", "max_len", "lines",
        F.explode(example_bounds(F.col("lines"), F.col("doc_id"), F.col("max_len"), seed)).alias("b"),
    )
    return bounds.select(
        "doc_id", "max_len", "b.ex", "b.target",
        F.slice("lines", F.col("b.first") + 1, F.col("b.count")).alias("lines"),
    )


def split_segments(packed: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, max_len, ex, a, b): lines dealt to a first and a second segment, untrimmed."""
    doc, length, ex = F.col("doc_id"), F.col("max_len"), F.col("ex")
    single = uniform(seed, "single", doc, length, ex) < SINGLE_SEGMENT
    half = F.floor((F.col("target") - 3) / 2).cast("int")
    none = F.array().cast("array<int>")
    begin = F.struct(none.alias("a"), none.alias("b"), F.when(single, NO_LIMIT).otherwise(half).alias("goal"))

    def step(acc: Column, line: Column) -> Column:
        have, more = F.size(acc["a"]), F.size(line["ids"])
        coin = uniform(seed, "side", doc, length, ex, line["line_no"]) < 0.5
        first = (have == 0) | (have + more < acc["goal"]) | (
            (F.size(acc["b"]) == 0) & (have < acc["goal"]) & coin
        )
        return F.struct(
            F.when(first, F.concat(acc["a"], line["ids"])).otherwise(acc["a"]).alias("a"),
            F.when(first, acc["b"]).otherwise(F.concat(acc["b"], line["ids"])).alias("b"),
            acc["goal"].alias("goal"),
        )

    return packed.select("doc_id", "max_len", "ex", F.aggregate("lines", begin, step).alias("s")).select(
        "doc_id", "max_len", "ex", "s.a", "s.b"
    )


def filled(value, n: Column) -> Column:
    """An array of ``n`` equal ints (empty for n <= 0)."""
    return F.array_repeat(F.lit(value).cast("int") if isinstance(value, int) else value, F.greatest(n, F.lit(0)).cast("int"))


def assemble(segments: DataFrame, cls: Column, sep: Column, pad_id: int = 0) -> DataFrame:
    """(doc_id, max_len, ex, input_ids, input_mask, segment_ids), each of length max_len."""
    length = F.col("max_len")
    trimmed = segments.withColumn("a", F.slice("a", F.lit(1), length - 2)).withColumn(
        "b", F.slice("b", F.lit(1), F.greatest(F.lit(0), length - F.size("a") - 3))
    )
    has_b = F.size("b") > 0
    none = F.array().cast("array<int>")
    n_first = F.size("a") + 2
    n_second = F.when(has_b, F.size("b") + 1).otherwise(0)
    pads = length - n_first - n_second
    tail = F.when(has_b, F.concat(F.col("b"), F.array(sep))).otherwise(none)
    return trimmed.select(
        "doc_id", "max_len", "ex",
        F.concat(F.array(cls), F.col("a"), F.array(sep), tail, filled(pad_id, pads)).alias("input_ids"),
        F.concat(filled(1, n_first + n_second), filled(0, pads)).alias("input_mask"),
        F.concat(filled(0, n_first), filled(1, n_second), filled(0, pads)).alias("segment_ids"),
    )


def token_id(vocab: DataFrame, token: str) -> Column:
    return vocab.filter(F.col("token") == token).agg(F.min("id")).scalar()


def build_examples(
    encoded: DataFrame, vocab: DataFrame, lengths: list[int], seed: int = 0, pad_id: int = 0
) -> DataFrame:
    """Encoded lines (doc_id, line_no, ids) to examples of every wanted length."""
    packed = pack_lines(documents_of_lines(encoded), lengths, seed)
    return assemble(split_segments(packed, seed), token_id(vocab, "[CLS]"), token_id(vocab, "[SEP]"), pad_id)
