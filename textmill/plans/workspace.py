"""Input tables and the intermediate tables that several jobs share."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from textmill.functions.stage import materialize
from textmill.operators.packing import build_examples
from textmill.operators.tokenize import Codebook, encode_rows
from textmill.operators.vocabulary import (
    alphabet, assemble_vocab, frequent_pieces, learn_wordpiece, ranked_merges, word_counts,
)
from textmill.session import DEAL, configure
from textmill.sources.corpus import corpus_lines

VOCAB_SIZE = 2000


class Workspace:
    """One corpus folder. Vocabulary and encoded lines are written once and read by the jobs that need them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder
        usual = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        self.deal = int(spark.conf.get(DEAL, None) or usual)

    def stored(self, name: str) -> DataFrame:
        """A table that is not dealt out, for jobs that deal its whole rows out by a key first."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return self.stored(name).repartition(self.deal)

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def word_counts(self) -> DataFrame:
        return word_counts(self.documents.select("text"))

    @cached_property
    def vocab(self) -> DataFrame:
        counts = materialize(self.word_counts, "word-counts")
        built = assemble_vocab(alphabet(counts), frequent_pieces(counts), VOCAB_SIZE)
        return materialize(built, "vocab").hint("broadcast")

    @cached_property
    def learned_vocab(self) -> DataFrame:
        """Merges learned over all words, up to ``VOCAB_SIZE`` tokens."""
        counts = materialize(self.word_counts, "word-counts")
        merges = ranked_merges(learn_wordpiece(counts, size=VOCAB_SIZE))
        return materialize(assemble_vocab(alphabet(counts), merges, VOCAB_SIZE), "learned-vocab").hint("broadcast")

    @cached_property
    def learned_book(self) -> Codebook:
        return Codebook(self.learned_vocab)

    @cached_property
    def book(self) -> Codebook:
        return Codebook(self.vocab)

    @cached_property
    def lines(self) -> DataFrame:
        return corpus_lines(self.documents.select("doc_id", "text"), ["doc_id"])

    @cached_property
    def encoded(self) -> DataFrame:
        return materialize(encode_rows(self.lines, ["doc_id", "line_no"], "line", self.book), "encoded")

    def examples(self, lengths: list[int] | None = None) -> DataFrame:
        return build_examples(self.encoded, self.vocab, lengths or [128])


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Workspace(spark, folder)
    return _open[key]


def forget() -> None:
    """Drop all shared tables, so that the next query builds its own (used for timing)."""
    _open.clear()
