"""What a table was made of row by row, for operators that can bring less to the rows instead of all of them elsewhere."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Origin(NamedTuple):
    """A table's texts, and what its operator was given beside them."""

    texts: DataFrame
    keys: list[str]
    text: str
    book: object


def with_origin(made: DataFrame, texts: DataFrame, keys: list[str], text: str, book) -> DataFrame:
    """``made`` itself, with a note of its origin. Anything done to it gives a table without the note."""
    made._textmill_origin = Origin(texts, keys, text, book)
    return made


def origin(made: DataFrame) -> Origin | None:
    return getattr(made, "_textmill_origin", None)
