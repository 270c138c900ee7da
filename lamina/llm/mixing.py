"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of their ids, form blocks of ``block_bytes``. Block i of a source with weight w is
released at slot floor(i / w) and due by slot ceil((i + 1) / w). Of the released blocks the one with the earliest
deadline takes the next slot, and so, up to every slot, each source has had its share to within less than one block.
Weights are whole numbers of slots per period. The period (at least 1000 slots) grows until its rounding moves no source by more than
an eighth of a block over all its blocks. One period of the schedule, as far as there are blocks, is worked out
once, by a heap step per slot on the driver, written in pieces if it is long, and joined to the blocks. A source whose documents are used up
leaves its slots empty; the others go on in their order. No document is dropped: a consumer takes as long a prefix as it needs.

Running sums use no window over a source: rows are range-partitioned by source and id, summed within
(partition, source), and moved on by the totals of the partitions before, one row per partition and source.

A null source is the source ''. Empty and null texts take up no room and fall in the block of their place. Null ids come
last. Repeated rows are documents of their own. Sources without a target weight come after all slots, with null block and slot.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.common import NO_ID, stored, table
from lamina.session import scratch_path

PERIOD, PIECE = 1000, 40_000  # slots at least, and blocks of the schedule that are held at once


def slots_per_period(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots for each weight, by largest remainders, at least one for each; they sum to the period."""
    weights = {s: w for s, w in weights.items() if w > 0}
    if not weights:
        return {}
    period, total = max(period, 4 * len(weights)), math.fsum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    slots = {s: max(1, math.floor(x)) for s, x in exact.items()}
    by = sorted(exact, key=lambda s: (slots[s] - exact[s], s))
    while (rest := period - sum(slots.values())) != 0:
        for s in by[:rest] if rest > 0 else [s for s in reversed(by) if slots[s] > 1][:-rest]:
            slots[s] += 1 if rest > 0 else -1
    return slots


def fitting_slots(weights: dict[str, float], blocks: dict[str, int]) -> dict[str, int]:
    """Whole slots for each weight, of a period so long that no source is off by more than 1/8 block when its blocks are used up."""
    total, period = math.fsum(w for w in weights.values() if w > 0), PERIOD
    while True:
        slots = slots_per_period(weights, period)
        whole = sum(slots.values())
        if all(8 * abs(n - weights[s] / total * whole) * blocks.get(s, 0) <= n for s, n in slots.items()):
            return slots
        period = 2 * whole


def dealt(slots: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of one period, as far as the sources have blocks: earliest deadline first among the released ones."""
    period, left = sum(slots.values()), sum(min(n, blocks.get(s, 0)) for s, n in slots.items())
    later = [(0, s, 0) for s in sorted(slots)]  # (release, source, block)
    heapq.heapify(later)
    ready: list[tuple[int, str, int]] = []
    for slot in range(period):
        if left == 0:
            return
        while later and later[0][0] <= slot:
            _, s, i = heapq.heappop(later)
            heapq.heappush(ready, (-(-(i + 1) * period // slots[s]), s, i))
        _, s, i = heapq.heappop(ready)
        if i < blocks.get(s, 0):
            left -= 1
            yield s, i, slot
        if i + 1 < slots[s]:
            heapq.heappush(later, ((i + 1) * period // slots[s], s, i + 1))


def one_period(slots: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of a whole period."""
    return list(dealt(slots, slots))


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("p")).select("p.*")


def _plan(spark: SparkSession, entries: Iterator[tuple[str, int, int]]) -> DataFrame:
    """source, k and at of the schedule: within the plan if it is short, else in files."""
    schema, path = "source: string, k: long, at: long", None
    while True:
        part = _rows(spark, [{"source": s, "k": i, "at": t} for s, i, t in itertools.islice(entries, PIECE)], schema)
        following = next(entries, None)
        if path is None and following is None:
            return F.broadcast(part)
        path = path or scratch_path(spark, "llm-mix-plan")
        part.coalesce(1).write.mode("append").parquet(path)
        if following is None:
            return spark.read.schema(part.schema).parquet(path)
        entries = itertools.chain([following], entries)


def _hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _ranged(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df`` sorted over partitions and stored with its partition as ``part`` (range order) and its place there as ``place``."""
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), name)


def _before(parts: DataFrame, keys: list[str], size: str) -> DataFrame:
    """The totals of ``size`` in the partitions before, one row per key and partition."""
    window = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*keys, "part", F.coalesce(F.sum(size).over(window), F.lit(0)).alias("before"))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = 65_536, power: float = 0.5) -> DataFrame:
    """doc_id (null: the last key), text_hash, source, block, release, deadline, slot and position, the place in the mix.

    Without ``weights`` a source's weight is the ``power`` of its bytes. The driver holds a row per source.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        _hash().alias("text_hash"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    )
    rows = _ranged(rows, "mix-sizes", "source", "doc_id", "text_hash")
    totals = {r["source"]: r["size"] for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    if weights is None:
        weights = {s: max(1, size) ** power for s, size in totals.items()}
    blocks = {s: size // block_bytes + 1 for s, size in totals.items()}
    slots = fitting_slots(weights, blocks)
    period = sum(slots.values())
    plan = _plan(spark, dealt(slots, blocks))
    counts = _rows(spark, [{"source": s, "n": n} for s, n in slots.items()], "source: string, n: long")

    within = Window.partitionBy("part", "source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = _before(rows.groupBy("source", "part").agg(F.sum("size").alias("size")), ["source"], "size")
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(before, ["source", "part"])
    rows = rows.withColumn("block", F.expr(f"(before + inside) div {block_bytes}"))
    rows = rows.join(F.broadcast(counts), "source", "left")  # a row per source
    rows = rows.withColumns({"block": F.when(F.col("n").isNotNull(), F.col("block")), "k": F.col("block") % F.col("n")})
    rows = rows.join(plan, ["source", "k"], "left")
    rows = rows.select(
        "doc_id", "text_hash", "source", "block", F.expr(f"block * {period} div n").alias("release"),
        F.expr(f"((block + 1) * {period} + n - 1) div n").alias("deadline"), F.expr(f"block div n * {period} + at").alias("slot"),
    )
    last = F.coalesce("slot", F.lit(NO_ID))
    rows = _ranged(rows.withColumn("order", last), "mix-slots", "order", "source", "doc_id", "text_hash")
    firsts = rows.groupBy("part").agg(F.count("*").alias("size"), F.min("place").alias("first"))
    offsets = _before(firsts.withColumn("all", F.lit(0)), ["all"], "size").join(firsts.select("part", "first"), "part")
    return rows.join(offsets.select("part", "before", "first"), "part").select(
        "doc_id", "text_hash", "source", "block", "release", "deadline", "slot", (F.col("before") + F.col("place") - F.col("first")).alias("position"),
    )


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """All documents with their own columns, range-partitioned and sorted by their place in the mix.

    Written as files, their order is the mix. Rows that share id and text stand together, at the first of their places.
    """
    place = schedule(docs, weights).groupBy("doc_id", "text_hash").agg(F.min("position").alias("_position"))
    rows = docs.withColumns({"_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_hash": _hash()})
    rows = rows.join(place, (F.col("_key") == place["doc_id"]) & (F.col("_hash") == place["text_hash"])).select(*(docs[c] for c in docs.columns), "_position")
    return rows.repartitionByRange("_position").sortWithinPartitions("_position").select(*docs.columns)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    found = schedule(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "source", "block", "release", "deadline", "slot", "position")
