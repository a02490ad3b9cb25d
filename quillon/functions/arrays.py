"""Array helpers that replace a shuffle by work inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression captured by a lambda would be computed again for each
    element; going through a one-element ``transform`` fixes its value.
    """
    return F.transform(F.array(value), body)[0]


def counted(values: Column, key: str, count: str) -> Column:
    """Histogram of an array: ``array<struct<key, count bigint>>``, sorted by key.

    Sorts the array and measures its runs: O(n log n) inside the row, where
    ``explode`` + ``groupBy`` would shuffle every token of the corpus.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return bind(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(ordered, p).alias(key),
                    (F.coalesce(F.get(st, j + 1), F.size(ordered)) - p)
                    .cast("bigint")
                    .alias(count),
                ),
            ),
        )

    empty = F.expr(f"cast(array() as array<struct<{key}:string,{count}:bigint>>)")
    return bind(
        F.sort_array(values), lambda v: F.when(F.size(v) > 0, runs(v)).otherwise(empty)
    )
