"""The previous value of a group without gathering the group: range partitions, and the last row of each carried over the border.

A window over a group sorts the group in one task. Here rows are dealt by range of (group, order), so a group of any size spreads over as
many tasks as it needs, and only the first row of a partition lacks what is before it: the last row of the partition before.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.columns import quoted
from lamina.session import write_out


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: ``value`` of the row before in its group, null for the first. Rows that tie in ``order`` follow each other in any order."""
    sort = [*[F.asc_nulls_first(quoted(g)) for g in group], *order]
    placed = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_place", F.monotonically_increasing_id())
    placed = write_out(placed, "ranged").withColumn("_part", F.shiftright("_place", 33))  # written rows keep their place, also after a lost executor
    inside = Window.partitionBy("_part", *map(quoted, group)).orderBy("_place")
    key = F.struct(*map(quoted, group), quoted(value).alias("_value"))
    # One row per partition: small enough for one window and for a broadcast.
    ends = placed.groupBy("_part").agg(F.max_by(key, "_place").alias("_end"))
    ends = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_before"))
    same = F.lit(True)
    for g in group:
        same = same & F.col("_before").getField(g).eqNullSafe(quoted(g))
    first = F.row_number().over(inside) == 1
    found = placed.select("*", F.lag(quoted(value)).over(inside).alias("_inside"), first.alias("_first")).join(F.broadcast(ends), "_part")
    carried = F.when(F.col("_before").isNotNull() & same, F.col("_before._value"))
    return found.select(*[quoted(c) for c in df.columns], F.when(F.col("_first"), carried).otherwise(F.col("_inside")).alias(name))
