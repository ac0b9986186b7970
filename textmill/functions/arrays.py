"""Array helpers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from textmill.functions.draws import as_column

BLOCK = 32
LEVELS = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _inside(block: Column) -> Column:
    return F.transform(block, lambda _, i: F.aggregate(F.slice(block, F.lit(1), i), F.lit(0), lambda a, n: a + n))


def starts(lengths: Column, levels: int = LEVELS) -> Column:
    """For each length, the sum of those before it (int).

    Inside blocks of ``BLOCK`` the sums are made one by one; the totals of blocks are summed up the same way, level
    by level. Only the last level is quadratic, and it has ``BLOCK ** (levels - 1)`` times fewer elements.
    """
    if levels == 1:
        return let(as_column(lengths), _inside)

    def cut(all_: Column) -> Column:
        count = F.ceil(F.size(all_) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)))
        totals = lambda cuts: F.transform(cuts, lambda c: F.aggregate(c, F.lit(0), lambda a, n: a + n))
        return F.when(F.size(all_) <= BLOCK, _inside(all_)).otherwise(let(blocks, lambda cuts: F.flatten(
            F.zip_with(cuts, starts(totals(cuts), levels - 1), lambda c, base: F.transform(_inside(c), lambda n: n + base))
        )))

    return let(as_column(lengths), cut)
