"""Work on long arrays inside a row, in linear or sorting time.

Looking something up in an array or a map walks all of it, so a look-up per element is
quadratic.  Sorted runs and running values answer the same questions in one walk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.sqltext import let

#: Elements of a block of ``running``; a fold copies what it has built, at most this much.
BLOCK = 256


def _counted(n: Column) -> Column:
    """0 .. n - 1, empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def runs(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """The parts of equal ``key`` (null equal to null) of an array that is sorted by it."""

    def cut(rows: Column) -> Column:
        starts = F.filter(
            _counted(F.size(rows)),
            lambda i: (i == 0) | ~key(F.get(rows, i - 1)).eqNullSafe(key(F.get(rows, i))),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, k: F.transform(
                    F.sequence(start, F.coalesce(F.get(s, k + 1), F.size(rows)) - 1), lambda i: F.get(rows, i)
                ),
            ),
        )

    return let(ordered, cut)


def _folded(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    def step(done: Column, v: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        return F.concat(done, F.array(F.when(last.isNull(), v).otherwise(combine(last, v))))

    return F.aggregate(values, F.slice(values, 1, 0), step)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` over all elements up to each one; it is associative, and no element is null."""

    def by_blocks(rows: Column) -> Column:
        blocks = F.transform(
            _counted(F.ceil(F.size(rows) / BLOCK).cast("int")), lambda b: _folded(F.slice(rows, b * BLOCK + 1, BLOCK), combine)
        )

        def joined(own: Column) -> Column:
            ends = F.transform(own, lambda block: F.get(block, F.size(block) - 1))
            return let(
                _folded(ends, combine),
                lambda before: F.flatten(
                    F.transform(
                        own,
                        lambda block, b: let(
                            F.get(before, b - 1),
                            lambda head: F.when(head.isNull(), block).otherwise(
                                F.transform(block, lambda v: combine(head, v))
                            ),
                        ),
                    )
                ),
            )

        return let(blocks, joined)

    return let(values, by_blocks)
