"""Shapes results for comparison: wide integers, rounded doubles, arrays as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from textmill.functions.text import joined


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, T.ArrayType):
            column = joined(column)
        out.append(column.alias(field.name))
    return df.select(*out)
