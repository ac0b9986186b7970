"""Token ids in ORC files, in ascending document order.

ORC writes the integers of a stripe with its run-length encoding, keeps the least and greatest document id of
each stripe and of each ``row_index_stride`` rows, and a Bloom filter on document ids beside them. Readers take
stripes in parallel, and skip those that cannot hold the documents asked for. Each row also holds how many ids
stand before it in its file, so a position in the whole corpus needs only the files' totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textmill.llm.rows import columns, map_batches, texts
from textmill.llm.token_ids import id_encoder

FILE = "doc_id long, before long, ids array<int>"


def _encode_sorted(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, written, end = id_encoder(path), 0, end_id.to_bytes(2, "little")
        for batch in batches:
            coded = [encode(text) + end for text in texts(batch.column("text"))]
            lengths = np.array([len(c) // 2 for c in coded], dtype=np.int64)
            ends = np.cumsum(lengths)
            ids = pa.array(np.frombuffer(b"".join(coded), dtype="<u2").astype(np.int32))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, ids)
            before = pa.array(written + ends - lengths)
            written += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), before, lists], ["doc_id", "before", "ids"])

    return run


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, files: int | None = None,
    stripe_bytes: int = 64 << 20, row_index_stride: int = 10_000,
) -> None:
    """Encode (doc_id, text), append ``end_id`` to each document and write the ids to ``folder`` in ORC.

    Null texts are empty: they hold the end id alone. Documents are sorted by doc_id, nulls first, then text, so
    repeated ids have a fixed order; other columns are ignored. No rows write an empty table. Texts are
    dealt into ranges of doc_id (by a sample of doc_id) before they are encoded, and file names keep that order.
    ``files``: the session's shuffle partitions if not given.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = columns(docs, doc_id="long", text="string").repartitionByRange(files, "doc_id")
    coded = rows.sortWithinPartitions("doc_id", "text").mapInArrow(_encode_sorted(tokenizer, end_id), FILE)
    (
        coded.write.format("orc")
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", row_index_stride).option("orc.stripe.size", stripe_bytes)
        .option("orc.encoding.strategy", "SPEED").option("compression", "zstd")
        .option("maxRecordsPerFile", 0)  # one file a task: ``before`` counts along it
        .save(folder)
    )


def read_ids(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, before, ids, file) of all documents, or of those ``wanted``, for which other stripes are skipped."""
    rows = spark.read.schema(FILE).orc(folder)
    if wanted is not None:
        rows = rows.where(F.col("doc_id").isin(wanted))
    return rows.withColumn("file", F.col("_metadata.file_name"))


def file_starts(rows: DataFrame) -> DataFrame:
    """(file, first): the ids in all files before each. One row for each file; the window runs over these alone."""
    totals = rows.groupBy("file").agg(F.max(F.col("before") + F.size("ids")).alias("total"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("first"))


def _checksums(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = batch.column("ids")
    raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
    at = lists.offsets.to_pylist()
    crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
    counts = pa.array(np.diff(np.array(at, dtype=np.int64)))
    made = [counts, pa.array(crcs, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in ("doc_id", "before", "file")), *made], ["doc_id", "before", "file", "n_tokens", "ids_crc32"]
    )


def document_positions(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, all from the files in ``folder``."""
    rows = read_ids(spark, folder)
    summed = map_batches(rows, _checksums, "doc_id long, before long, file string, n_tokens long, ids_crc32 long")
    return summed.join(file_starts(rows), "file").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
