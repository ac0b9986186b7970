"""Running totals and ranks over whole tables without a one-task window.

A window without ``partitionBy`` (or over a few huge groups) sorts everything in one task. Here rows are first put
into ordered buckets, the totals of the buckets are summed up, and the fine window runs inside one bucket only.
Buckets are cut at splitters drawn from the keys themselves, so the order may be by any number of columns of any type
that sorts, and there are as many buckets as the rows need: a group with most of the rows has most of the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_ROWS = 1_000_000  # in the mean
SAMPLES = 64  # drawn for each bucket; so many keep the largest of 100,000 buckets below twice the mean


def splitters(df: DataFrame, keys: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row, one column: the splitters in order, as an array of arrays of about equal length.

    A key is drawn by its hash, so a task that runs again draws the same ones. 64 keys for each ``bucket_rows`` rows
    come together in one task; the splitters are a 64th of them.
    """
    drawn = F.pmod(F.xxhash64(*keys), F.lit(bucket_rows)) < SAMPLES
    sample = df.where(drawn).agg(F.sort_array(F.collect_set(F.struct(*keys))).alias("s"))
    cut = sample.select(F.filter("s", lambda _, i: i % SAMPLES == SAMPLES - 1).alias("s"))
    sized = cut.select("s", F.greatest(F.ceil(F.sqrt(F.size("s"))), F.lit(1)).cast("int").alias("w"))
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("s") / F.col("w")), F.lit(1)).cast("int") - 1)
    return sized.select(F.transform(blocks, lambda i: F.slice("s", i * F.col("w") + 1, F.col("w"))).alias("nested"))


def with_bucket(df: DataFrame, keys: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``_bucket``, which grows with ``keys``: found among the blocks of splitters, then in one block."""
    key = F.struct(*keys)
    df = df.withColumn("_nested", splitters(df, keys, bucket_rows).scalar())
    df = df.withColumn("_block", F.size(F.filter("_nested", lambda b: F.get(b, F.lit(0)) <= key)))
    inside = F.size(F.filter(F.get("_nested", F.col("_block") - 1), lambda s: s <= key))
    whole = (F.col("_block") - 1) * F.size(F.get("_nested", F.lit(0)))
    return df.withColumn("_bucket", F.when(F.col("_block") == 0, 0).otherwise(whole + inside)).drop("_nested", "_block")


def running_total(
    df: DataFrame, order: str, value: Column, out: str, group: list[str] | None = None,
    ties: list[str] | None = None, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the rows that come before in ``order`` and then ``ties``, which together are unique
    within a group. Nulls come first. Rows whose group holds a null are left out."""
    group = group or []
    fine = [order, *(ties or [])]
    df = with_bucket(df.withColumn("_v", value), [*group, *fine], bucket_rows)
    ahead = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # a row for each bucket, and so few
        df.groupBy(*group, "_bucket")
        .agg(F.sum("_v").alias("_total"))
        .withColumn("_base", F.coalesce(F.sum("_total").over(ahead), F.lit(0)))
        .drop("_total")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*fine).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inner", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .join(bases, [*group, "_bucket"])
        .withColumn(out, F.col("_base") + F.col("_inner"))
        .drop("_bucket", "_v", "_base", "_inner")
    )


def hashed_rank(
    df: DataFrame, draw: str, ties: list[str], out: str, group: list[str] | None = None, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Zero-based rank by a draw, ties broken by ``ties``."""
    return running_total(df, draw, F.lit(1).cast("bigint"), out, group, ties, bucket_rows)
