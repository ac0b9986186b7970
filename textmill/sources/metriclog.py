"""Training metric logs: five prefix characters and a JSON record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

PREFIX = "DLLL "


def parse_metric_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Adds ``type``, ``step`` (text; training steps are numbers), ``data`` and ``texts`` from a log line.

    A record's values can be of any kind. ``data`` holds its numbers as doubles (null for a null), ``texts`` all others
    as text, JSON where they are nested. A line that is no JSON has nulls.
    """
    record = F.try_parse_json(F.substring(F.col(line), len(PREFIX) + 1, 1 << 30))
    get = lambda path, kind: F.try_variant_get("_r", path, kind)
    values = F.col("_values")
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    number = lambda v: kind(v).isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT", "SMALLINT", "TINYINT", "VOID")
    rows = df.withColumn("_r", record).withColumn("_values", get("$.data", "map<string,variant>"))
    return rows.select(
        *[c for c in df.columns if c != line], get("$.type", "string").alias("type"), get("$.step", "string").alias("step"),
        F.transform_values(F.map_filter(values, lambda _, v: number(v)), lambda _, v: F.try_variant_get(v, "$", "double")).alias("data"),
        F.transform_values(F.map_filter(values, lambda _, v: ~number(v)), lambda _, v: F.try_variant_get(v, "$", "string")).alias("texts"),
    )


def read_metric_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, type, step, data); lines are numbered along each file (as rank logs are merged)."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("_at"),
        F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line"),
    )
    inside = Window.partitionBy("file", "_block").orderBy("_at")
    sizes = raw.groupBy("file", "_block").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    numbered = raw.withColumn("_nth", F.row_number().over(inside) - 1).join(bases, ["file", "_block"])
    return parse_metric_lines(
        numbered.select("file", (F.col("_base") + F.col("_nth")).alias("line_no"), "line")
    )


def format_metric_lines(df: DataFrame) -> DataFrame:
    """(…, line): records written the same way."""
    record = F.to_json(F.struct("type", "step", "data"))
    return df.select(*[c for c in df.columns if c not in ("type", "step", "data")], F.concat(F.lit(PREFIX), record).alias("line"))
