"""Queries over training logs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textmill.functions.prefix import running_total
from textmill.functions.stage import let_go, materialize
from textmill.operators import traininglog as L
from textmill.plans.corpus import metric_log
from textmill.plans.examples import EXAMPLE_SQL
from textmill.plans.report import shown
from textmill.plans.sqlparts import PART, query
from textmill.plans.workspace import VOCAB_SIZE, workspace
from textmill.session import new_folder
from textmill.streaming.idle import run_until_idle
from textmill.streaming.packing import pack_lines_stream, stream_examples
from textmill.streaming.traininglog import metric_windows_stream

QUERIES, SQL = {}, {}


def S(name, sql=None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: shown(fn(workspace(spark, folder)))
        if sql:
            SQL[name] = sql
        return fn

    return keep


PERCENT = "CASE WHEN metric LIKE '%accuracy%' THEN 100 ELSE 1 END"


@S("metric_windows", query(f"""
  SELECT rank, metric, (ceil(step / 10.0) * 10)::BIGINT AS step, round(avg(value) * {PERCENT}, 6) AS value
  FROM metric_log GROUP BY 1, 2, 3"""))
def _(w):
    return L.metric_windows(metric_log(w), 10)


PART["rank_log"] = """
  SELECT rank, line_no, CASE WHEN line_no % 50 = 0 THEN 'META' ELSE 'LOG' END AS type,
         CASE WHEN line_no % 40 = 1 THEN 'PARAMETER' WHEN event_id % 97 = 0 THEN (line_no * 10 + 1)::VARCHAR
              ELSE (line_no * 10)::VARCHAR END AS step, value
  FROM (SELECT event_id, user_id % 4 AS rank, value,
               row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS line_no FROM events)"""


def rank_log(w):
    numbered = running_total(
        w.table("events").select("event_id", F.pmod("user_id", F.lit(4)).alias("rank"), "value"),
        "event_id", F.lit(1), "line_no", ["rank"],
    )
    line = F.col("line_no")
    step = F.when(line % 40 == 1, "PARAMETER").when(F.col("event_id") % 97 == 0, (line * 10 + 1).cast("string")).otherwise(
        (line * 10).cast("string"))
    return numbered.select(
        "rank", "line_no", F.when(line % 50 == 0, "META").otherwise("LOG").alias("type"), step.alias("step"),
        F.create_map(F.lit("total_loss"), "value", F.lit("train_perf"), F.col("value") * 2).alias("data"),
    )


@S("merge_rank_logs", query("""
  SELECT h.line_no, type, step, metric, round(value, 6) AS value, ranks,
         CASE WHEN ranks < 4 THEN 'unmatched' WHEN NOT one_type THEN 'type differs'
              WHEN type = 'LOG' AND NOT one_step THEN 'step differs' ELSE 'merged' END AS status FROM (
    SELECT l.line_no, count(*) AS ranks, min(type) AS type, min(step) AS step, count(DISTINCT type) = 1 AS one_type,
           count(DISTINCT step) = 1 AS one_step FROM rank_log l GROUP BY l.line_no) h
  JOIN (
    SELECT line_no, metric, CASE WHEN min(type) <> 'LOG' OR max(step) = 'PARAMETER'
                                 THEN max(v) FILTER (rank = 0) ELSE avg(v) END AS value FROM (
      SELECT line_no, rank, type, step, 'total_loss' AS metric, value AS v FROM rank_log
      UNION ALL SELECT line_no, rank, type, step, 'train_perf', value * 2 FROM rank_log) GROUP BY line_no, metric) m
  ON m.line_no = h.line_no"""))
def _(w):
    return L.merge_rank_logs(materialize(rank_log(w), "rank-log"), 4)


PART["log_mean"] = f"""
  SELECT metric, avg(value) * {PERCENT} AS value FROM (
    SELECT rank, metric, arg_max(value, step) AS value FROM metric_log GROUP BY rank, metric) GROUP BY metric"""


@S("final_metrics", query(f"""
  SELECT metric, round(value, 6) AS value FROM log_mean
  UNION ALL SELECT 'training_sequences_per_second', round(value, 6) FROM log_mean WHERE metric = 'train_perf'
  UNION ALL SELECT 'final_loss', round(value, 6) FROM log_mean WHERE metric = 'total_loss'
  UNION ALL SELECT 'e2e_train_time', round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) FROM metric_log"""))
def _(w):
    return L.final_metrics(metric_log(w))


@S("throughput_eta", query("""
  SELECT rank, step, round(seconds, 4) AS seconds, round(CASE WHEN seconds > 0 THEN 32 * 4 / seconds END, 4) AS per_second,
         round(CASE WHEN step > s0 THEN (t - t0) / (step - s0) * (1000000 - step) END, 2) AS eta FROM (
    SELECT rank, step, t, t - lag(t) OVER (PARTITION BY rank ORDER BY step) AS seconds,
           min(t) OVER (PARTITION BY rank) AS t0, min(step) OVER (PARTITION BY rank) AS s0
    FROM (SELECT rank, step, epoch_us(ts) / 1e6 AS t FROM metric_log))"""))
def _(w):
    eta = L.throughput_eta(metric_log(w).select("rank", "step", "ts"), 32, 4, 1_000_000, block=1000)
    return eta.select("rank", "step", F.round("seconds", 4).alias("seconds"), F.round("per_second", 4).alias("per_second"),
                      F.round("eta", 2).alias("eta"))


IDLE_MS = 3000


def run_to_end(w, stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over the files that are there, until its timers have let the last rows go."""
    path, state = new_folder(w.spark, name), new_folder(w.spark, name + "-state")
    job = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", state)
        .outputMode("append").trigger(processingTime="200 milliseconds").start()
    )
    run_until_idle(job, 2 * IDLE_MS / 1000)
    return w.spark.read.schema(stream.schema).parquet(path)


def line_stream(w) -> DataFrame:
    """The encoded lines as a stream of several micro-batches, in which lines come out of order."""
    order = Window.partitionBy("doc_id").orderBy("line_no")  # the lines of one document
    # Ids below the size of the vocabulary take two bytes while lines are moved.
    moved = w.encoded.withColumn("ids", F.col("ids").cast("array<smallint>")) if VOCAB_SIZE < 1 << 15 else w.encoded
    lines = moved.select(
        "doc_id", (F.row_number().over(order) - 1).alias("i"), "line_no", "ids",
        F.lead("line_no").over(order).isNull().alias("is_last"),
    )
    path = new_folder(w.spark, "line-stream")
    dealt = lines.withColumn("part", F.pmod(F.col("i"), F.lit(3))).repartition("part", "doc_id").drop("part")
    lines = dealt.withColumn("ids", F.col("ids").cast("array<int>"))
    lines.write.parquet(path)
    let_go(w.spark)
    per_batch = max(1, len(w.spark.read.parquet(path).inputFiles()) // 3)
    return w.spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


@S("pack_lines_stream", query("""
  SELECT doc_id, max_len::BIGINT AS max_len, ex::BIGINT AS ex, target::BIGINT AS target, first_line, n_lines FROM segments"""))
def _(w):
    packed = run_to_end(w, pack_lines_stream(line_stream(w), idle_ms=100 * IDLE_MS), "packed-stream")
    return packed.select(
        "doc_id", "max_len", "ex", "target", F.element_at("lines", 1)["line_no"].alias("first_line"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )


@S("stream_examples", query(EXAMPLE_SQL))
def _(w):
    ids = [F.lit(w.vocab.filter(F.col("token") == t).first().id) for t in ("[CLS]", "[SEP]")]
    return run_to_end(w, stream_examples(line_stream(w), *ids, idle_ms=100 * IDLE_MS), "example-stream")


@S("metric_windows_stream", query(f"""
  SELECT rank, metric, (ceil(step / 10.0) * 10)::BIGINT AS step, round(avg(value) * {PERCENT}, 6) AS value,
         count(value) AS n, 0::BIGINT AS late
  FROM metric_log GROUP BY 1, 2, 3"""))
def _(w):
    log = metric_log(w).select("rank", "metric", "step", "value")
    path = new_folder(w.spark, "log-stream")
    last, files = log.agg(F.max("step")).scalar(), w.deal
    # The log comes in three parts, one after the other, each of as many files as tables are dealt to.
    for i in range(3):
        part = F.least(F.floor(3 * F.col("step") / (last + 1)), F.lit(2))
        log.filter(part == i).repartition(files).write.mode("append").parquet(path)
    per_batch = max(1, len(w.spark.read.parquet(path).inputFiles()) // 3)
    source = w.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", per_batch).parquet(path)
    return run_to_end(w, metric_windows_stream(source, idle_ms=IDLE_MS), "log-windows")
