"""Nested JSON task files, label maps, column preparation and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def rows_of_field(df: DataFrame, json: str, field: str, schema: str) -> DataFrame:
    """Rows of the array under a top-level ``field`` of a JSON text column."""
    parsed = F.from_json(F.col(json), f"{field} array<struct<{schema}>>")
    return df.select(F.inline(parsed[field]))


def read_nested_json(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """Rows under a top-level field of JSON files, with the schema given (no inference pass)."""
    whole = spark.read.schema(f"{field} array<struct<{schema}>>").json(path, multiLine=True)
    return whole.select(F.inline(field))


def label_map(lists: DataFrame, column: str = "label_list") -> DataFrame:
    """(id, label) from one list of labels, in list order."""
    return lists.select(F.posexplode(column).alias("id", "label"))


def label_list(df: DataFrame, column: str) -> DataFrame:
    """One row with the sorted distinct labels; a label set is the classes of one task."""
    return df.select(column).distinct().agg(F.sort_array(F.collect_list(column)).alias("label_list"))


def to_label(df: DataFrame, labels: DataFrame, id_column: str, out: str = "label") -> DataFrame:
    names = labels.select(F.col("id").alias(id_column), F.col("label").alias(out))
    return df.join(names, id_column, "left")


def to_label_id(df: DataFrame, labels: DataFrame, label_column: str, out: str = "label_id") -> DataFrame:
    ids = labels.select(F.col("label").alias(label_column), F.col("id").alias(out))
    return df.join(ids, label_column, "left")


def prepare_columns(
    df: DataFrame, drop: list[str] | None = None, rename: dict[str, str] | None = None, as_string: list[str] | None = None
) -> DataFrame:
    df = df.drop(*(drop or [])).withColumnsRenamed(rename or {})
    return df.withColumns({c: F.col(c).cast("string") for c in as_string or []})


def flatten_columns(df: DataFrame, delim: str = "_") -> DataFrame:
    """Struct columns become one column per field, named prefix, delimiter, field."""
    out: list[Column] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            out += [F.col(field.name)[k].alias(field.name + delim + k) for k in field.dataType.names]
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def nest_columns(df: DataFrame, prefixes: list[str], delim: str = "_") -> DataFrame:
    """The opposite: columns that start with a prefix and the delimiter gather in one struct.

    A column goes to the first prefix it matches; the others stay at top level.
    """
    groups: dict[str, list[Column]] = {}
    order: list[str] = []
    plain: list[str] = []
    for name in df.columns:
        prefix = next((p for p in prefixes if name.startswith(p + delim)), None)
        if prefix is None:
            plain.append(name)
            continue
        if prefix not in groups:
            groups[prefix] = []
            order.append(prefix)
        groups[prefix].append(F.col(name).alias(name[len(prefix) + len(delim):]))
    return df.select(*plain, *[F.struct(*groups[p]).alias(p) for p in order])
