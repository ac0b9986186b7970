"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Documents of equal text are a group that stays together. A group alone is a partial partition: one part has its
bytes and the others none. Differencing takes the two partial partitions of largest spread (greatest part less
least part) and adds them with their parts in opposite order, until one is left. Here this happens in levels:
groups are dealt into buckets of bounded size, each bucket is brought down to one partial partition, whose
part sums are the items of the next level, and so on. A bucket keeps which part each item's parts went to, and
those small tables lead back from the last partition to the shards of all groups.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from textmill.functions.stage import materialize
from textmill.llm.rows import columns, crc32_of


def difference(items: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Part sums, ascending, of the partial partitions ``items`` (each ascending) put together, and for each item
    the part that each of its parts went to. Ties in spread go by the order of ``items``."""
    width = len(items[0])
    sums, built = list(items), [None] * len(items)
    heap = [(parts[0] - parts[-1], i) for i, parts in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heap[0]
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]), strict=True)]
        order = sorted(range(width), key=joined.__getitem__)
        merged = [joined[i] for i in order]
        sums.append(merged)
        built.append((a, b, order))
        heapq.heapreplace(heap, (merged[0] - merged[-1], len(sums) - 1))
        sums[a] = sums[b] = None
    last = len(built) - 1
    parts = sums[last]
    goes: list = [None] * len(built)
    goes[last] = list(range(width))
    for node in range(last, len(items) - 1, -1):
        a, b, order = built[node]
        to = [0] * width
        for place, i in enumerate(order):
            to[i] = goes[node][place]
        goes[a], goes[b], goes[node] = to, to[::-1], None
    return parts, goes[: len(items)]


def _reduce_level(items: DataFrame, shards: int) -> DataFrame:
    """``items`` (bucket, item, parts) to (bucket, item, goes, sums), the bucket's sums on its first item's row."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item", kind="stable")
        sums, goes = difference([[0] * (shards - len(parts)) + list(map(int, parts)) for parts in group["parts"]])
        firsts = [sums, *[None] * (len(group) - 1)]
        return pd.DataFrame({"bucket": group["bucket"].to_numpy(), "item": group["item"].to_numpy(), "goes": goes, "sums": firsts})

    schema = f"bucket long, item {items.schema['item'].dataType.simpleString()}, goes array<int>, sums array<long>"
    return materialize(items.groupBy("bucket").applyInPandas(work, schema), "differencing")


def shard_groups(groups: DataFrame, shards: int, buckets: int, fan: int = 512) -> DataFrame:
    """(item, shard) for the distinct ``item`` of ``groups``, which have ``weight``; ``buckets`` for the first level."""
    bucket = F.pmod(F.xxhash64("item"), F.lit(buckets))
    first = _reduce_level(groups.select(bucket.alias("bucket"), "item", F.array("weight").alias("parts")), shards)
    levels, count = [first], buckets
    while count > 1:
        up = levels[-1].where("sums is not null").select(
            F.floor(F.col("bucket") / fan).alias("bucket"), F.col("bucket").alias("item"), F.col("sums").alias("parts")
        )
        levels.append(_reduce_level(up, shards))
        count = -(-count // fan)
    to = None
    for level in reversed(levels[1:]):  # from the top down: the shards of each bucket's parts
        here = level.select(F.col("item").alias("_bucket"), "bucket", "goes")
        if to is not None:
            above = to.withColumnsRenamed({"_bucket": "bucket", "goes": "_shards"})
            here = here.join(above, "bucket").select(
                "_bucket", F.transform("goes", lambda part: F.element_at("_shards", part + 1)).alias("goes")
            )
        to = here.select("_bucket", "goes")
    # A group's bytes are the last, greatest part of its item.
    part = F.element_at("goes", -1)
    if to is None:
        return first.select("item", part.alias("shard"))
    to = to.withColumnsRenamed({"_bucket": "bucket", "goes": "_shards"})
    return first.join(to, "bucket").select("item", F.element_at("_shards", part + 1).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 16, groups_per_bucket: int = 4096) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is ``bytes``) of each document.

    ``size``: UTF-8 bytes of the text (none if null) and 1. Null texts are equal to each other and to no other.
    Repeated rows have places of their own; a null doc_id is placed like any other; other columns are ignored;
    no rows give no rows. Texts are read once. A group larger than a shard's share gets the least other bytes.

    Slots count a shard's documents in the order of a hash of doc_id, so numbering is spread over as many tasks
    as there are hash buckets, with a small table of totals between them.
    """
    rows = columns(docs, doc_id="long", text="string")
    narrow = materialize(
        rows.select(
            "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            crc32_of(F.col("text")).alias("text_crc32"),
            F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit(b"")).alias("item"),
        ),
        "sizes",
    )
    buckets = max(1, -(-narrow.count() // groups_per_bucket))
    groups = narrow.groupBy("item").agg(F.sum("size").alias("weight"))
    placed = materialize(narrow.join(shard_groups(groups, shards, buckets), "item").drop("item"), "placed")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(buckets))
    placed = placed.withColumn("place", place)
    ahead = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("shard", "place").agg(F.count("*").alias("n"))
    starts = totals.select("shard", "place", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "place").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("within", F.row_number().over(inside) - 1).join(starts, ["shard", "place"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
