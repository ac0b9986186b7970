"""Vocabulary text files: one token per line, the id is the line index."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def id_gaps(vocab: DataFrame) -> DataFrame:
    """(token, id, gap): ids that do not follow the one before. A vocabulary is bounded, so one sort is fine."""
    before = F.lag("id", 1, -1).over(Window.partitionBy(F.lit(0)).orderBy("id"))
    return vocab.select("token", "id", (F.col("id") != before + 1).cast("int").alias("gap"))


def write_vocab(vocab: DataFrame, path: str) -> None:
    gaps = id_gaps(vocab).filter("gap = 1").limit(1).count()
    if gaps:
        logging.getLogger(__name__).warning("vocabulary ids are not consecutive; check that it is not corrupted")
    vocab.orderBy("id").select("token").coalesce(1).write.text(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) of a single-file vocabulary; line order inside the file is kept."""
    lines = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("id", "token")
    )
    return lines.select("token", "id")
