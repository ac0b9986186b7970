"""Repeatable draws: a uniform number in [0, 1) from a hash of seed, tag and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def uniform(seed: int, tag: str, *keys) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *[as_column(k).cast("string") for k in keys])
    digits = F.substring(F.md5(text), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def uniform_index(n, seed: int, tag: str, *keys) -> Column:
    """A whole number in [0, n)."""
    return F.floor(uniform(seed, tag, *keys) * n).cast("bigint")
