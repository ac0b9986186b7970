"""Small helpers shared by the operators: input columns, Arrow batches, tokenizers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The ASCII white space that ends a word.
WORD = r"[^\x20\x09-\x0D]+"


def columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Just the named columns with the named types, so that no other column can clash with an operator's own."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return ["" if value is None else value for value in column.to_pylist()]


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to each Arrow batch. Spark bounds batches by rows and by bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


def crc32_of(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; a null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
