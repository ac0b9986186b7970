"""Rollups of training metric logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def percent_if_accuracy(metric: Column, value: Column) -> Column:
    return F.when(metric.contains("accuracy"), value * 100).otherwise(value)


def metric_windows(log: DataFrame, freq: int = 10) -> DataFrame:
    """(rank, metric, step, value): the mean of every ``freq`` steps, reported at the last of them."""
    step = (F.ceil(F.col("step") / freq) * freq).cast("bigint")
    return log.groupBy("rank", "metric", step.alias("step")).agg(
        percent_if_accuracy(F.col("metric"), F.avg("value")).alias("value")
    )


def merge_rank_logs(log: DataFrame, world: int) -> DataFrame:
    """(line_no, type, step, metric, value, ranks, status): line n of all ranks as one record.

    ``log``: (rank, line_no, type, step, data map). Values are averaged over ranks; lines that are not
    step records are taken from rank 0. ``status`` tells lines missing in some rank and lines whose type or
    step disagree, where the merge by position would stop or fail.
    """
    heads = log.groupBy("line_no").agg(
        F.count("*").alias("ranks"), F.min("type").alias("type"), F.min("step").alias("step"),
        (F.max("type") == F.min("type")).alias("one_type"),
        F.coalesce(F.max("step") == F.min("step"), F.lit(True)).alias("one_step"),
        F.coalesce(F.max("step") == "PARAMETER", F.lit(False)).alias("parameter"),
    )
    status = (
        F.when(F.col("ranks") < world, "unmatched").when(~F.col("one_type"), "type differs")
        .when((F.col("type") == "LOG") & ~F.col("one_step"), "step differs").otherwise("merged")
    )
    values = log.select("line_no", "rank", F.explode_outer("data").alias("metric", "v")).groupBy("line_no", "metric").agg(
        F.avg("v").alias("mean"), F.max(F.when(F.col("rank") == 0, F.col("v"))).alias("first")
    )
    as_is = (F.col("type") != "LOG") | F.col("parameter")
    return heads.join(values, "line_no").select(
        "line_no", "type", "step", "metric",
        F.when(as_is, F.col("first")).otherwise(F.col("mean")).alias("value"), "ranks", status.alias("status"),
    )


def final_metrics(log: DataFrame) -> DataFrame:
    """(metric, value): mean over ranks of each rank's last value, with the derived run summary.

    ``log``: (rank, step, metric, value, ts).
    """
    last = log.groupBy("rank", "metric").agg(F.max_by("value", "step").alias("value"))
    means = last.groupBy("metric").agg(percent_if_accuracy(F.col("metric"), F.avg("value")).alias("value"))
    derived = means.select(
        F.when(F.col("metric") == "train_perf", "training_sequences_per_second")
        .when(F.col("metric") == "total_loss", "final_loss").alias("metric"), "value",
    ).filter(F.col("metric").isNotNull())
    micros = F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))
    elapsed = log.agg(F.lit("e2e_train_time").alias("metric"), (micros / 1e6).alias("value"))
    return means.unionByName(derived).unionByName(elapsed)


def previous_value(df: DataFrame, group: list[str], order: str, value: str, out: str, block: int = 100_000) -> DataFrame:
    """The value of the row before, without sorting a whole group in one task.

    Rows are cut into blocks of the order value; only the last value of each block crosses over.
    """
    cut = df.withColumn("_block", F.floor(F.col(order) / block))
    ends = cut.groupBy(*group, "_block").agg(F.max_by(value, order).alias("_end"))
    carried = ends.withColumn(
        "_carried", F.lag("_end").over(Window.partitionBy(*group).orderBy("_block"))
    ).drop("_end")
    inside = Window.partitionBy(*group, "_block").orderBy(order)
    return (
        cut.join(carried, [*group, "_block"])
        .withColumn(out, F.coalesce(F.lag(value).over(inside), F.col("_carried")))
        .drop("_block", "_carried")
    )


def throughput_eta(steps: DataFrame, batch: int, world: int, total_steps: int, block: int = 100_000) -> DataFrame:
    """(rank, step, seconds, per_second, eta): speed of each step and time left from the mean step time.

    ``steps``: (rank, step, ts), one row per step.
    """
    clock = F.unix_micros("ts") / F.lit(1e6)
    timed = previous_value(steps.withColumn("_t", clock), ["rank"], "step", "_t", "_before", block)
    starts = steps.groupBy("rank").agg(F.min("step").alias("_s0"), (F.min(F.unix_micros("ts")) / F.lit(1e6)).alias("_t0"))
    seconds = F.col("_t") - F.col("_before")
    done = F.col("step") - F.col("_s0")
    return timed.join(starts, "rank").select(
        "rank", "step", seconds.alias("seconds"),
        F.when(seconds > 0, batch * world / seconds).alias("per_second"),
        F.when(done > 0, (F.col("_t") - F.col("_t0")) / done * (total_steps - F.col("step"))).alias("eta"),
    )
