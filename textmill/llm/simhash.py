"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprint bits are grouped into parts, correlated bits together, and each part gets a threshold of its own.
If two fingerprints differ in at most ``most`` bits and the thresholds sum to ``most - parts + 1``, then they
differ in at most its threshold in one part (a part of threshold -1 is left out). Dynamic programming finds the
thresholds that cost least, by the candidate pairs and probes they are estimated to make over all fingerprints;
the number of parts is chosen by the same cost. Fingerprints are then probed by part and verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.stage import materialize
from textmill.llm.components import roots
from textmill.llm.rows import columns, map_batches, text_bytes

BITS = 64
PROBE_COST = 4.0  # what a row of an index or a probe costs, in comparisons of two fingerprints


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint as an unsigned number; a bit is 1 if more than half of the shingles' hashes have it."""
    words = text.lower().split()  # bytes: A-Z alone are lowered, and words end at ASCII white space
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        spaced, ends, at = b" ".join(words), [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *[end + 1 for end in ends]]
        hashes = [digest(spaced[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        block = np.array(hashes[i : i + 65536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, row, print): the fingerprint as a signed long, and a digest of doc_id and text that names the row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle, seed) for t in text_bytes(batch.column("text"))], dtype=np.uint64)
        ids = [batch.column("doc_id"), batch.column("row")]
        return pa.RecordBatch.from_arrays([*ids, pa.array(made.view(np.int64))], ["doc_id", "row", "print"])

    rows = columns(docs, doc_id="long", text="string")
    return map_batches(rows.withColumn("row", row_name(F.col("doc_id"), F.col("text"))), work, "doc_id long, row binary, print long")


def row_name(doc_id: Column, text: Column) -> Column:
    parts = F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("none")), F.coalesce(text.cast("string"), F.lit("")))
    return F.unhex(F.md5(parts.cast("binary")))


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and in how many of them each pair of bits is set; 4,096 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, seen = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            raw = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            for i in range(0, len(raw), 65536):
                bits = np.unpackbits(raw[i : i + 65536], axis=1, bitorder="little").astype(np.float64)
                both += (bits.T @ bits).astype(np.int64)
                seen += len(bits)
        if seen:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            cells = [[*i, -1], [*j, -1], [*both.ravel(), seen]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["i", "j", "n"])

    sums = prints.select("print").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    total, both = 0, np.zeros((BITS, BITS))
    for row in sums.collect():
        if row.i < 0:
            total = row.n
        else:
            both[row.i, row.j] = row.n
    return total, both


def group_bits(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of near-equal size; each grows by the bit most correlated with it."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    strength = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for g in range(parts):
        left = sorted(free)
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        free.discard(group[0])
        while len(group) < (BITS * (g + 1)) // parts - (BITS * g) // parts:
            nearest = max(sorted(free), key=lambda b: (strength[b, group].sum(), -b))
            group.append(nearest)
            free.discard(nearest)
        groups.append(sorted(group))
    return groups


def within(share: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Chance that two fingerprints differ in at most 0, 1, .. ``most`` of ``bits``, as if bits were independent."""
    chance = np.array([1.0])
    for b in bits:
        differ = 2 * share[b] * (1 - share[b])
        chance = np.convolve(chance, [1 - differ, differ])
    return list(np.cumsum(chance)[: most + 1])


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Least total cost and thresholds; ``costs[i][t + 1]`` is part i's at threshold t, and thresholds sum to
    ``budget``. Dynamic programming over parts and sums."""
    best = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                option = (cost + more, [*chosen, t])
                if total + t not in new or option < new[total + t]:
                    new[total + t] = option
        best = new
    return best[budget]


@dataclass(frozen=True)
class Plan:
    parts: list[list[int]]
    thresholds: list[int]
    cost: float


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def mask_of(bits: tuple[int, ...] | list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def plan_parts(prints: DataFrame, most: int) -> Plan:
    """The cheapest parts and thresholds for the distinct ``prints``.

    Pairs equal in a part are counted exactly from all fingerprints; how many more a larger threshold adds is
    estimated from the bits' frequencies.
    """
    total, both = bit_statistics(prints)
    share = np.diag(both) / max(total, 1)
    # One part would be probed with all ways to flip `most` bits, which is never cheaper.
    choices = {m: group_bits(total, both, m) for m in range(2, most + 2)}
    named = [(m, i, bits) for m, groups in choices.items() for i, bits in enumerate(groups)]
    cells = [F.struct(F.lit(k).alias("k"), F.col("print").bitwiseAND(F.lit(mask_of(b))).alias("v")) for k, (_, _, b) in enumerate(named)]
    values = prints.select(F.inline(F.array(*cells))).groupBy("k", "v").agg(F.count("*").alias("n"))
    pairs = values.groupBy("k").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    equal = {row.k: float(row.pairs) for row in pairs.collect()}
    plans = []
    for m, groups in choices.items():
        costs = []
        for k, (_, _, bits) in [(k, x) for k, x in enumerate(named) if x[0] == m]:
            chance = within(share, bits, most)
            row = [0.0]
            for t in range(most + 1):
                candidates = max(equal.get(k, 0.0), 1.0) * chance[t] / max(chance[0], 1e-300)
                probes = total * (1 + sum(comb(len(bits), d) for d in range(t + 1)))
                row.append(candidates + PROBE_COST * probes)
            costs.append(row)
        cost, thresholds = allocate(costs, most - m + 1)
        plans.append(Plan(groups, thresholds, cost))
    return min(plans, key=lambda p: p.cost)


def links(prints: DataFrame, most: int) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct ``prints`` that differ in at most ``most`` bits; a pair may stand
    in several rows."""
    plan = plan_parts(prints, most)
    index, probes = [], []
    for k, (bits, t) in enumerate(zip(plan.parts, plan.thresholds, strict=True)):
        if t < 0:
            continue
        here = prints.select(F.lit(k).alias("k"), F.col("print").bitwiseAND(F.lit(mask_of(bits))).alias("v"), "print")
        flips = [mask_of(c) for d in range(t + 1) for c in combinations(bits, d)]
        index.append(here.withColumnRenamed("print", "b"))
        around = F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip")
        tried = here.withColumnRenamed("print", "a").select("k", "v", "a", around) if t else here.withColumn("flip", F.lit(0)).withColumnRenamed("print", "a")
        probes.append(tried.select("k", F.col("v").bitwiseXOR(F.col("flip").cast("long")).alias("v"), "a"))
    join = reduce(DataFrame.unionByName, probes).join(reduce(DataFrame.unionByName, index), ["k", "v"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most
    return join.where((F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row of ``docs`` (doc_id, text).

    Texts without words (null, empty, white space) have fingerprint zero and are linked like any other. Documents
    link at ``most`` or fewer differing bits; component_id is the least doc_id that can be reached. Only distinct
    fingerprints are probed, so copies never form pairs. A null doc_id is linked but never a component's id,
    unless the component has no other. Repeated rows stay; other columns are ignored; no rows give no rows.
    """
    printed = materialize(fingerprints(docs, shingle, seed), "prints")
    rooted = rooted_prints(printed, most)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("print", "component_id")
    joined = printed.join(named, "print")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def rooted_prints(printed: DataFrame, most: int) -> DataFrame:
    """(print, least, root) of each distinct fingerprint: its least doc_id and its component."""
    distinct = materialize(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    root = materialize(roots(links(distinct.select("print"), most)), "roots")
    rooted = distinct.join(root, F.col("print") == F.col("node"), "left")
    return rooted.select("print", "least", F.coalesce("root", "print").alias("root"))


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component.

    It is the row of the least doc_id, and of rows of one doc_id the one whose text has the least digest, so a doc_id
    that stands on unlike texts keeps a row for each component they are in. Rows without a doc_id come last in their
    component. Of rows that repeat doc_id and text one stays, whichever; null texts are empty ones. No rows give none.
    """
    printed = materialize(fingerprints(docs, shingle, seed), "prints")
    grouped = printed.join(rooted_prints(printed, most).select("print", "root"), "print")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    leaders = grouped.groupBy("root").agg(first.alias("lead")).select(F.col("lead.row").alias("_row"))
    copies = printed.groupBy(F.col("row").alias("_row")).agg((F.count("*") > 1).alias("_copies"))
    leaders = materialize(leaders.join(copies, "_row"), "leaders")
    row, copies = [unused(name, docs.columns) for name in ("_row", "_copies")]
    leaders = leaders.select(F.col("_row").alias(row), F.col("_copies").alias(copies))
    kept = docs.withColumn(row, row_name(F.col("doc_id"), F.col("text"))).join(leaders, row)
    single = kept.where(~F.col(copies)).unionByName(kept.where(F.col(copies)).dropDuplicates([row]))
    return single.select(*[F.col(f"`{c}`") for c in docs.columns])


def unused(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name
