"""Placement of rows: shards, workers, output files, training batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.functions.draws import uniform, uniform_index
from textmill.functions.prefix import hashed_rank, running_total


def shard(df: DataFrame, n: int = 2048, by: str = "doc", seed: int = 0) -> DataFrame:
    """Adds ``shard`` to (doc_id, line_no, …) rows.

    ``by='doc'`` keeps a document together. ``by='line'`` deals line i of the corpus (documents in id
    order) to shard i mod n: line counts per document are summed up in buckets, whatever the type of doc_id.
    """
    if by == "doc":
        return df.withColumn("shard", uniform_index(n, seed, "shard", "doc_id").cast("int"))
    if by != "line":
        raise ValueError(f"unknown sharding {by}")
    counts = df.groupBy("doc_id").agg(F.count("*").alias("_lines"))
    offsets = running_total(counts, "doc_id", F.col("_lines"), "_before").drop("_lines")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")) - 1  # one document's lines
    return (
        df.withColumn("_nth", nth).join(offsets, "doc_id")
        .withColumn("shard", F.pmod(F.col("_before") + F.col("_nth"), F.lit(n)).cast("int"))
        .drop("_nth", "_before")
    )


def assign_files(files: DataFrame, n_workers: int, name: str = "file") -> DataFrame:
    """(file, worker): sorted names dealt to workers. A file listing is small by nature."""
    index = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(name)) - 1
    return files.select(name, F.pmod(index, F.lit(n_workers)).cast("int").alias("worker"))


def place_examples(
    examples: DataFrame, n_files: int, n_jobs: int, seed: int = 0, within: list[str] | None = None
) -> DataFrame:
    """Adds ``job``, ``seq`` (number of the example within its job) and ``out_file``.

    Job j owns the files i with i mod n_jobs = j and deals its examples to them in turn, by doc_id and then by the
    columns ``within``, which tell a document's examples apart: by default those of max_len and ex that are there.
    Document ids may be of any type that sorts.
    """
    within = within or [c for c in ("max_len", "ex") if c in examples.columns]
    jobs = examples.withColumn("job", uniform_index(n_jobs, seed, "job", "doc_id"))
    counts = jobs.groupBy("job", "doc_id").agg(F.count("*").alias("_n"))
    offsets = running_total(counts, "doc_id", F.col("_n"), "_before", ["job"]).drop("_n", "job")
    writers = F.ceil((F.lit(n_files) - F.col("job")) / n_jobs)
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*within)) - 1  # one document's examples
    return (
        jobs.withColumn("_nth", nth).join(offsets, "doc_id")
        .withColumn("seq", F.col("_before") + F.col("_nth"))
        .withColumn("out_file", F.col("job") + n_jobs * F.pmod(F.col("seq"), writers))
        .drop("_before", "_nth")
    )


def write_examples(
    examples: DataFrame, path: str, n_files: int, n_jobs: int, seed: int = 0, within: list[str] | None = None
) -> None:
    """Parquet, one folder per output file number; rows of a file are shuffled together before writing."""
    placed = place_examples(examples, n_files, n_jobs, seed, within)
    placed.repartition("out_file").write.partitionBy("out_file").parquet(path)


def training_batches(
    examples: DataFrame, keys: list[str], file_no: Column, batch: int, world: int, seed: int = 0, epochs: int = 1
) -> DataFrame:
    """(keys, epoch, rank, batch, pos): file i goes to rank i mod world; each rank reads its examples in a
    seeded order, in full batches and one rest, once per epoch."""
    order = uniform(seed, "order", "epoch", *keys)
    ranked = (
        examples.select(*keys, F.pmod(file_no, F.lit(world)).cast("int").alias("rank"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_u", order)
    )
    numbered = hashed_rank(ranked, "_u", keys, "_rn", ["epoch", "rank"])
    return numbered.select(
        *keys, "epoch", "rank", F.floor(F.col("_rn") / batch).alias("batch"),
        F.pmod(F.col("_rn"), F.lit(batch)).alias("pos"),
    )
