"""Aggregates kept as states that can be merged: what is stored per part of the data adds up to the aggregate of all of it.

A state table has one row per part and key. When a part changes, only its rows are made again; the aggregate is the merge
of all rows, so facts of other parts are not read. Sums, counts, maxima, minima and sets merge; everything that the reports derive
from them (rates, totals, last dates) is computed after the merge.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.columns import quoted


def _merged(kind: str, col: Column) -> Column:
    if kind in ("sum", "count"):
        return F.sum(col)
    if kind == "max":
        return F.max(col)
    if kind == "min":
        return F.min(col)
    if kind == "set":  # of few different values, such as spellings or file names
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(col))))
    raise ValueError(f"{kind!r} does not merge; known are sum, count, max, min and set")


def _made(kind: str, col: Column) -> Column:
    if kind == "count":
        return F.count(col)
    return F.array_sort(F.collect_set(col)) if kind == "set" else _merged(kind, col)


def states(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One state per key: ``measures`` names each measure's kind and the column that goes into it."""
    return df.groupBy(*map(quoted, keys)).agg(*[_made(kind, col).alias(name) for name, (kind, col) in measures.items()])


def merge(found: DataFrame, keys: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """The states of all parts put together."""
    return found.groupBy(*map(quoted, keys)).agg(*[_merged(kind, quoted(name)).alias(name) for name, kind in kinds.items()])
