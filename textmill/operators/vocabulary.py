"""Vocabulary learning, assembly, extension and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textmill.functions.arrays import let
from textmill.functions.prefix import running_total
from textmill.functions.text import SPECIAL_TOKENS, is_plain_run, runs_of
from textmill.operators.merges import learn_merges
from textmill.operators.splitting import counter, letter_counter, piece_counter


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Count word runs and punctuation runs of the folded text, first inside the slices of an Arrow batch."""
    plain = is_plain_run(text)
    none = F.array().cast("array<string>")  # no null, as in plain_or_words
    parts = df.select(F.when(plain, F.col(text)).alias("text"), F.when(plain, none).otherwise(let(F.col(text), runs_of)).alias("runs"))
    return parts.mapInArrow(counter(runs=True), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def alphabet(counts: DataFrame) -> DataFrame:
    """The characters of words, every one but the first with the continuation prefix."""
    words = counts.select("word", F.col("n").cast("bigint"))
    return words.mapInArrow(letter_counter, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def frequent_pieces(counts: DataFrame, longest: int = 100) -> DataFrame:
    """Word heads and tails of 2 to ``longest`` characters with their occurrence counts.

    A one-pass stand-in for merge learning where many vocabularies are wanted quickly. Words over 100 characters are
    unknown as a whole, so longer pieces would never be used. Pieces are summed in Arrow batches of words first.
    """
    words = counts.select("word", F.col("n").cast("bigint"))
    return words.mapInArrow(piece_counter(longest), "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def assemble_vocab(alphabet_counts: DataFrame, pieces: DataFrame, size: int) -> DataFrame:
    """Special tokens, then the alphabet, then the most frequent pieces up to ``size`` tokens.

    The alphabet is a floor, so the result may be larger. It is at most ``size`` tokens plus two forms of
    each Unicode character, which is why the broadcast hint it carries is safe at any corpus size.
    """
    spark = pieces.sparkSession
    special = spark.createDataFrame(
        [(t, 0, -i) for i, t in enumerate(SPECIAL_TOKENS)], "token string, grp int, n bigint"
    )
    letters = alphabet_counts.select("token", F.lit(1).alias("grp"), "n")
    top = (
        pieces.orderBy(F.desc("n"), "token").limit(size)
        .select("token", F.lit(2).alias("grp"), "n")
        .join(letters.select("token"), "token", "left_anti")
    )
    ranked = Window.partitionBy(F.lit(0)).orderBy("grp", F.desc("n"), "token")
    return (
        special.unionByName(letters).unionByName(top)
        .withColumn("id", (F.row_number().over(ranked) - 1).cast("int"))
        .filter((F.col("grp") < 2) | (F.col("id") < size))
        .select("token", "id", F.element_at(F.array(F.lit("special"), F.lit("letter"), F.lit("piece")),
                                            F.col("grp") + 1).alias("source"))
        .hint("broadcast")
    )


def ranked_merges(vocab_merges: DataFrame) -> DataFrame:
    """Learned merges as pieces for :func:`assemble_vocab`: earlier merges rank first; a token counts once."""
    return vocab_merges.groupBy("token").agg((-F.min("merge_no")).cast("bigint").alias("n"))


def learn_wordpiece(counts: DataFrame, merges: int | None = None, size: int | None = None) -> DataFrame:
    """Pair merging over the distinct-word table (word, n): (merge_no, a, b, token, n).

    Each merge is the most frequent pair of neighbours, weighted by word count (ties: count descending, then pair).
    Stops after ``merges``, or when special tokens, alphabet and merged tokens are ``size``. A token can come from
    several merges; it counts once. Only pairs and merges pass through the driver.
    """
    if merges is None and size is None:
        raise ValueError("say how many merges, or the size of the vocabulary")
    learned = learn_merges(counts, alphabet(counts), size and max(size - len(SPECIAL_TOKENS), 0), merges)
    rows = [(i + 1, *m) for i, m in enumerate(learned)]
    return counts.sparkSession.createDataFrame(rows, "merge_no int, a string, b string, token string, n bigint")


def add_tokens(vocab: DataFrame, new: DataFrame, order: str, lower: bool = False) -> DataFrame:
    """Append unknown tokens (first occurrence order), with ids from the current size on."""
    token = F.col("token")
    if lower:
        token = F.when(token.isin(SPECIAL_TOKENS), token).otherwise(F.lower(token))
    fresh = (
        new.select(token.alias("token"), F.col(order).alias("_o"))
        .groupBy("token").agg(F.min("_o").alias("_o"))
        .join(vocab.select("token"), "token", "left_anti")
    )
    size = vocab.agg(F.count("*")).scalar()
    numbered = running_total(fresh, "_o", F.lit(1), "_before", ties=["token"]).select(
        "token", (F.col("_before") + size).cast("int").alias("id"), F.lit("added").alias("source")
    )
    return vocab.select("token", "id", "source").unionByName(numbered)


def coverage_report(words: DataFrame, codes: DataFrame, by: list[str]) -> DataFrame:
    """Pieces per word and share of unknown words, with subtotals.

    ``words``: (*by, word, n) already counted; ``codes``: (word, pieces).
    """
    known = words.join(codes.select("word", "pieces"), "word", "left")
    unknown = F.element_at("pieces", 1) == "[UNK]"
    whole = F.size("pieces") == 1
    return known.rollup(*by).agg(
        F.sum("n").alias("words"),
        F.sum(F.size("pieces") * F.col("n")).alias("pieces"),
        F.sum(F.when(unknown, F.col("n")).otherwise(0)).alias("unknown"),
        F.sum(F.when(whole & ~unknown, F.col("n")).otherwise(0)).alias("whole"),
    )


