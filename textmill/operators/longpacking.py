"""Packing documents of any length: the running sum with reset, without a row or a task for a whole document.

An example that begins at a line ends at the first line where its tokens reach the target, and the next begins behind
it. As the target is drawn by the line an example begins at, that is one pointer a line, whichever examples are
really made: it is found by a search on cumulative lengths. Which lines begin examples is then a matter of following
pointers from a document's first line. Blocks of lines are crossed on their own, so what is left is a graph of places
where pointers come into blocks, and pointer doubling goes through that in a logarithm of rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from textmill.functions.stage import materialize
from textmill.operators.packing import example_target

# Lines whose pointers are followed in one task, and tokens among whose ends one is searched for.
BLOCK, TOKENS = 1 << 16, 1 << 12
# Lines taken at once, at least, where blocks are smaller.
ROWS = 1 << 17
KEYS = ["doc_id", "max_len"]


def placed_lines(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """``lines`` (doc_id, line_no, n, …) with ``pos``, a line's number in its document, and ``before``, the tokens ahead.

    Both are sums inside blocks of line numbers plus the totals of the blocks before.
    """
    cut = lines.withColumn("_cut", F.floor(F.col("line_no") / block))
    totals = cut.groupBy("doc_id", "_cut").agg(F.count("*").alias("_rows"), F.sum("n").alias("_tokens"))
    ahead = Window.partitionBy("doc_id").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "doc_id", "_cut", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum("_tokens").over(ahead), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("doc_id", "_cut").orderBy("line_no")
    sums = cut.withColumn("_nth", F.row_number().over(inside) - 1).withColumn(
        "_sum", F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return sums.join(bases, ["doc_id", "_cut"]).select(
        *lines.columns, (F.col("_pos") + F.col("_nth")).alias("pos"), (F.col("_before") + F.col("_sum")).alias("before")
    )


def pointers(placed: DataFrame, lengths: list[int], seed: int, tokens: int = TOKENS) -> DataFrame:
    """(doc_id, max_len, pos, target, next): where the example after the one that begins at a line begins.

    The end of a line and the token that closes an example meet in a bucket of token numbers; where no line of the
    bucket ends that late, it is the first line of the next bucket that has one. ``next`` is null at the last.
    """
    sized = placed.select("doc_id", "pos", "before", "n", F.explode(F.array(*[F.lit(x) for x in lengths])).alias("max_len"))
    target = example_target(seed, F.col("doc_id"), F.col("max_len"), F.col("pos")).cast("int")
    asked = sized.select(*KEYS, "pos", target.alias("target"), (F.col("before") + target).alias("at"))
    ends = placed.select("doc_id", F.col("pos").alias("closes"), (F.col("before") + F.col("n")).alias("at"))
    ends = ends.withColumn("bucket", F.floor(F.col("at") / tokens))
    later = Window.partitionBy("doc_id").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    first = ends.groupBy("doc_id", "bucket").agg(F.min("closes").alias("_first"))
    # Every bucket that is asked in needs the first line of those behind it, also where none ends in it.
    wanted = asked.select("doc_id", F.floor(F.col("at") / tokens).alias("bucket")).distinct().withColumn("_first", F.lit(None).cast("bigint"))
    behind = first.unionByName(wanted).groupBy("doc_id", "bucket").agg(F.min("_first").alias("_first"))
    behind = behind.select("doc_id", "bucket", F.min("_first").over(later).alias("_behind"))
    none = lambda kind: F.lit(None).cast(kind)
    both = asked.withColumn("bucket", F.floor(F.col("at") / tokens)).withColumn("closes", none("bigint")).unionByName(
        ends.select("doc_id", "closes", "at", "bucket", none("int").alias("max_len"), none("bigint").alias("pos"), none("int").alias("target"))
    )
    # Lines that end late come first, and before what asks for the same token.
    seen = Window.partitionBy("doc_id", "bucket").orderBy(F.desc("at"), F.col("pos").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_here", F.min("closes").over(seen)).filter("pos is not null")
    return found.join(behind, ["doc_id", "bucket"]).select(
        *KEYS, "pos", "target", (F.coalesce("_here", "_behind") + 1).alias("next")
    )


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in order of blocks, many blocks at once and each of them whole, and for each row its block's first row."""
    held, rows, enough = [], 0, ROWS
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= enough:
            table = pa.Table.from_batches(held)
            first = _first_rows(table)
            cut = int(first[-1])
            if cut:
                yield table.slice(0, cut), first[:cut]
            held, rows = table.slice(cut).to_batches(), len(table) - cut
            enough = max(ROWS, 2 * rows)
    if rows:
        table = pa.Table.from_batches(held)
        yield table, _first_rows(table)


def _first_rows(table: pa.Table) -> np.ndarray:
    begins = np.zeros(len(table), dtype=bool)
    begins[0] = True
    for name in (*KEYS, "_block"):
        values = table[name].to_numpy()
        begins[1:] |= values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(begins, np.arange(len(table)), 0))


def _inner(table: pa.Table, first: np.ndarray) -> np.ndarray:
    """The row of the same block that each row's pointer leads to, or the row itself where it leaves the block."""
    pos, at = table["pos"].to_numpy(), np.arange(len(table))
    to = first + pc.fill_null(table["next"], -1).to_numpy() - pos[first]
    place = np.clip(to, 0, len(table) - 1)
    stays = (to > at) & (to < len(table)) & (first[place] == first)
    return np.where(stays, place, at)


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each line of a block where its pointers leave the block, and after how many examples: by pointer doubling."""
    for table, first in _whole_blocks(batches):
        to = _inner(table, first)
        hops = (to != np.arange(len(to))).astype(np.int64)
        while not np.array_equal(to, far := to[to]):
            hops, to = hops + hops[to], far
        out = table.select([*KEYS, "pos"]).append_column("to", table["next"].take(pa.array(to)))
        yield from out.append_column("hops", pa.array(hops + 1)).to_batches()


def block_entries(pointed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, max_len, pos, ex): for each block, the line where a document's examples come into it and its number."""
    cut = pointed.withColumn("_block", F.floor(F.col("pos") / block))
    crossed = _in_order(cut.select(*KEYS, "_block", "pos", "next")).mapInArrow(
        lambda batches: _crossings(batches), "doc_id bigint, max_len int, pos bigint, to bigint, hops bigint"
    )
    # Only lines that a pointer from another block leads to, and a document's first, can be entries.
    come = cut.filter(F.floor(F.col("next") / block) != F.col("_block")).select(*KEYS, F.col("next").alias("pos"))
    start = pointed.filter("pos = 0").select(*KEYS, "pos")
    graph = materialize(crossed.join(come.unionByName(start).distinct(), [*KEYS, "pos"]), "crossings")
    reached = materialize(start.withColumn("ex", F.lit(0).cast("bigint")), "entries")
    while graph.filter("to is not null").limit(1).count():
        ahead = reached.join(graph.filter("to is not null"), [*KEYS, "pos"]).select(
            *KEYS, F.col("to").alias("pos"), (F.col("ex") + F.col("hops")).alias("ex")
        )
        reached = materialize(reached.unionByName(ahead).distinct(), "entries")
        far = graph.select(*KEYS, F.col("pos").alias("to"), F.col("to").alias("_to"), F.col("hops").alias("_hops"))
        graph = materialize(graph.join(far, [*KEYS, "to"], "left").select(
            *KEYS, "pos", F.col("_to").alias("to"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops")
        ), "crossings")
    return reached


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The examples that begin in a block, from its entry on; all blocks go ahead together."""
    for table, first in _whole_blocks(batches):
        to, numbers = _inner(table, first), pc.fill_null(table["ex"], -1).to_numpy()
        at = np.flatnonzero(numbers >= 0)
        ex, rows, found = numbers[at], [], []
        while len(at):
            rows.append(at)
            found.append(ex)
            on = to[at] != at
            at, ex = to[at[on]], ex[on] + 1
        if rows:
            begun = table.select([*KEYS, "pos", "target"]).take(pa.array(np.concatenate(rows)))
            yield from begun.add_column(3, "ex", pa.array(np.concatenate(found), pa.int64())).to_batches()


def _in_order(cut: DataFrame) -> DataFrame:
    """The rows of a block side by side, in order: no group is handed over on its own."""
    return cut.repartition(*KEYS, "_block").sortWithinPartitions(*KEYS, "_block", "pos")


def pack_long(
    encoded: DataFrame, lengths: list[int], seed: int = 0, block: int = BLOCK, tokens: int = TOKENS
) -> DataFrame:
    """(doc_id, max_len, ex, target, lines) from (doc_id, line_no, ids): the rows of ``pack_lines``, where a document
    has more lines than a row or a task can take. Only the lines of one example are ever brought together."""
    sized = encoded.select("doc_id", "line_no", "ids", F.size("ids").alias("n"))
    placed = materialize(placed_lines(sized, block), "placed")
    pointed = materialize(pointers(placed, lengths, seed, tokens), "pointers")
    cut = pointed.withColumn("_block", F.floor(F.col("pos") / block))
    entered = cut.join(block_entries(pointed, block), [*KEYS, "pos"], "left").select(*KEYS, "_block", "pos", "next", "target", "ex")
    begun = _in_order(entered).mapInArrow(
        lambda batches: _starts(batches), "doc_id bigint, max_len int, pos bigint, ex bigint, target int"
    )
    begun = materialize(begun, "starts")
    # A line belongs to the last example that begins at or before it: one of its block's, or the last of those before.
    lasts = begun.groupBy(*KEYS, F.floor(F.col("pos") / block).alias("_block")).agg(F.max(F.struct("ex", "target")).alias("_last"))
    every = cut.select(*KEYS, "_block").distinct().join(lasts, [*KEYS, "_block"], "left")
    ahead = Window.partitionBy(*KEYS).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(*KEYS, "_block", F.max("_last").over(ahead).alias("_carried"))
    inside = Window.partitionBy(*KEYS, "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    owned = cut.select(*KEYS, "pos", "_block").join(begun.select(*KEYS, "pos", F.struct("ex", "target").alias("_own")), [*KEYS, "pos"], "left")
    owned = owned.withColumn("_own", F.max("_own").over(inside)).join(carried, [*KEYS, "_block"])
    owned = owned.select(*KEYS, "pos", F.coalesce("_own", "_carried").alias("e"))
    listed = F.sort_array(F.collect_list(F.struct("line_no", "ids")))
    packed = owned.join(placed.select("doc_id", "pos", "line_no", "ids", "n"), ["doc_id", "pos"]).groupBy(
        *KEYS, F.col("e.ex").cast("int").alias("ex"), F.col("e.target").alias("target")
    ).agg(listed.alias("lines"), F.sum("n").alias("_tokens"))
    return packed.filter("_tokens > 0").drop("_tokens")
