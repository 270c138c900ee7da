"""Parallel scans of single large files whose records do not end at line breaks: CSV with breaks inside values, JSON arrays.

Spark's text reader cuts a file into blocks and each block into pieces that end at a character which closes many records, a line
break or a brace. Whether such an end closes a record depends on everything before it in the file. A first pass sums up what each block does
to the state (is a quote open, how deep is the nesting); summed over the blocks before, this gives the state at the start of each. With it a second pass
puts records together within blocks, and what reaches over the border of blocks (at most two pieces a block) is joined
afterwards. No data is shuffled but these. Records are then read by Spark's own functions, so values and rejects are those of ``files``.

Blocks are known by where they start. If the two passes were cut differently, because the cluster has another number of cores meanwhile, a
block is not found and the scan fails rather than reading it wrongly.
"""

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.session import share_package
from lamina.sources import files

#: The state of a block: quotes that are open (0 or 1), and the depth it adds if none, or one, is open at its start.
STATE = ["quotes", "depth", "depth_open"]


def _pieces(spark: SparkSession, paths: Sequence[str], end: str) -> DataFrame:
    share_package(spark)
    text = spark.read.text(list(paths), lineSep=end, recursiveFileLookup=True)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The pieces of each block in a batch, in order."""
    files_, blocks = batch.column("file").to_pylist(), batch.column("block").to_numpy()
    cuts = [0, *[i for i in range(1, len(files_)) if blocks[i] != blocks[i - 1] or files_[i] != files_[i - 1]], len(files_)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield files_[a], int(blocks[a]), batch.column("value").slice(a, b - a)


def _quotes_of_csv(pieces: pa.Array) -> np.ndarray:
    return pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _quotes_of_json(pieces: pa.Array) -> np.ndarray:
    return _quotes_of_csv(pc.replace_substring_regex(pieces, r"\\.", ""))


def _depths(pieces: pa.Array, is_open: np.ndarray) -> np.ndarray:
    """What each piece of JSON adds to the depth outside of strings."""
    plain = pc.replace_substring_regex(pieces, r"\\.", "")
    plain = pc.if_else(pa.array(is_open.astype(bool)), pc.binary_join_element_wise('"', plain, ""), plain)
    outside = pc.replace_substring_regex(plain, r'"[^"]*("|$)', "")
    count = lambda c: pc.count_substring(outside, c).to_numpy(zero_copy_only=False).astype(np.int64)
    return count("{") + count("[") - count("]")


def _is_object(pieces: pa.Array) -> bool:
    """A document of one record counts as if it stood in an array."""
    return re.match("\ufeff?\\s*{", pieces[0].as_py()) is not None


def _states(pieces: DataFrame, quotes: Callable, nested: bool) -> dict[tuple[str, int], tuple[int, int]]:
    """By file and block: is a quote open at its start, and how deep is it. One row per block comes to the driver."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for file, block, values in _runs(batch):
                state = found.setdefault((file, block), [0, 0, 0])
                if nested and block == 0 and not any(state) and _is_object(values):
                    state[1:] = [1, 1]
                n = quotes(values)
                before = np.r_[0, np.cumsum(n)[:-1]] + state[0]
                if nested:  # every piece but the last of a file ends with a brace, which counts if no quote is open
                    for k in (0, 1):
                        added = _depths(values, (before + k) % 2)
                        state[1 + k] += int((added - ((before + n + k) % 2 == 0)).sum())
                state[0] += int(n.sum())
        rows = [(*key, *state) for key, state in found.items()]
        kinds = [pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["file", "block", *STATE])

    blocks = pieces.mapInArrow(of, "file string, block long, quotes long, depth long, depth_open long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("is_open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    added = F.when(F.col("is_open") == 0, F.col("depth")).otherwise(F.col("depth_open"))
    deep = opened.withColumn("deep", F.coalesce(F.sum(added).over(before), F.lit(0)))
    return {(r["file"], r["block"]): (r["is_open"], r["deep"]) for r in deep.select("file", "block", "is_open", "deep").collect()}


def _records(pieces: DataFrame, states: dict, closes, end: str) -> DataFrame:
    """file, record and ``first`` (it begins its file): pieces put together to records, also over the borders of blocks."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None  # the block that is being read
        state, held, whole, first = (0, 0), [], False, False

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["file", "block", "kind", "record", "first"])

        def left() -> list[tuple]:
            """What the block leaves open, for the next one."""
            return [(*now, "tail" if whole else "middle", end.join(held), first)] if now and held else []

        for batch in batches:
            rows = []
            for file, block, values in _runs(batch):
                if now != (file, block):
                    rows += left()
                    now, held = (file, block), []
                    if now not in states:
                        raise RuntimeError(f"{file} was cut differently before; read it again")
                    state, first = states[now], block == 0
                    if block == 0:
                        state = closes.begin(values, *state)
                    whole = block == 0 or closes.starts(*state)
                ended, *state = closes(values, *state)
                texts = values.to_pylist()
                for at in range(len(texts)):
                    held.append(texts[at])
                    if ended[at]:
                        rows.append((file, block, "whole" if whole else "head", closes.finished(end.join(held), ended[at]), first and whole))
                        held, whole, first = [], True, False
            yield batch_of(rows)
        yield batch_of(left())

    parts = pieces.mapInArrow(of, "file string, block long, kind string, record string, first boolean")
    return _joined(parts, end)


def _joined(parts: DataFrame, end: str) -> DataFrame:
    """Whole records, and those that were cut by blocks, in the order of their blocks."""
    cut = parts.filter("kind <> 'whole'")
    place = F.when(F.col("kind") == "tail", 1).otherwise(0)  # a tail follows the head of its block, and begins a record
    # the number of tails up to a part names its record
    so_far = Window.partitionBy("file").orderBy("block", place).rowsBetween(Window.unboundedPreceding, 0)
    named = cut.withColumn("n", F.sum(place).over(so_far)).withColumn("place", place)
    joined = named.groupBy("file", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "record"))), lambda x: x["record"]), end).alias("record"), F.max("first").alias("first"))
    return parts.filter("kind = 'whole'").select("file", "record", "first").unionByName(joined.select("file", "record", "first"))


class _CsvEnds:
    """A line ends a record if no quote is open after it."""

    def begin(self, _values: pa.Array, is_open: int, deep: int) -> tuple[int, int]:
        return is_open, deep

    def starts(self, is_open: int, _deep: int) -> bool:
        return is_open == 0

    def finished(self, text: str, _how: int) -> str:
        return text

    def __call__(self, values: pa.Array, is_open: int, deep: int) -> tuple[np.ndarray, int, int]:
        after = (np.cumsum(_quotes_of_csv(values)) + is_open) % 2
        return after == 0, int(after[-1]), deep


class _JsonEnds:
    """A brace ends a record if it leads back to the depth of the outer array; the last piece of a document has no brace."""

    def begin(self, values: pa.Array, is_open: int, deep: int) -> tuple[int, int]:
        return is_open, deep + _is_object(values)

    def starts(self, is_open: int, deep: int) -> bool:
        return is_open == 0 and deep <= 1

    def finished(self, text: str, how: int) -> str:
        return text + "}" if how == 1 else text.rstrip().removesuffix("]")

    def __call__(self, values: pa.Array, is_open: int, deep: int) -> tuple[np.ndarray, int, int]:
        n = _quotes_of_json(values)
        after = np.cumsum(n) + is_open
        at = np.cumsum(_depths(values, (after - n) % 2) - (after % 2 == 0)) + deep
        return np.where((after % 2 == 0) & (at <= 1), np.where(at == 1, 1, 2), 0), int(after[-1] % 2), int(at[-1])


def scan_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, null_mark: str | None = None) -> files.Routed:
    """As ``files.route_csv`` with ``multi_line``, but a file is read by as many tasks as it has blocks.

    Quotes stand around whole values and are doubled inside them; files with a quote in the middle of a plain value are for ``route_csv``. Lines
    end with a line feed, or with a carriage return before it; a carriage return inside a value stays, while the one-task reader drops it in files
    whose lines end with one. The header is the first record of each file.
    """
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else paths, "\n")
    records = _records(pieces, _states(pieces, _quotes_of_csv, False), _CsvEnds(), "\n")
    rows = records.filter(~F.col("first")).select("file", F.regexp_replace("record", "\r$", "").alias("record")).filter(F.trim("record") != "")
    options = {k: str(v) for k, v in files.CSV_FORMAT.items() if k != "header"} | {"multiLine": "true", "columnNameOfCorruptRecord": files.CORRUPT}
    if null_mark is not None:
        options |= {"nullValue": null_mark, "emptyValue": ""}
    kind = files.with_corrupt(schema)
    parsed = rows.select(F.from_csv("record", _ddl(kind), options).alias("r"), F.col("file").alias(files.FILE))
    return files.Routed(parsed.select(*[F.col("r").getField(f.name).alias(f.name) for f in kind], files.FILE))


def _ddl(kind: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)


def scan_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> files.Routed:
    """As ``files.route_json``, but a document is read by as many tasks as it has blocks.

    Records are judged one by one: that a document is broken between them, or ends too early, is not noticed.
    """
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else paths, "}")
    records = _records(pieces, _states(pieces, _quotes_of_json, True), _JsonEnds(), "}")
    body = F.regexp_replace(F.regexp_replace("record", "^\ufeff", ""), r"^\s*\[?\s*,?\s*", "")
    elements = records.select("file", F.regexp_replace(body, r"\s*,?\s*$", "").alias("body")).filter(F.col("body") != "").select(
        "file", F.explode(F.coalesce(F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>"), F.array("body"))).alias("element"))
    return files.Routed(files.parsed_elements(elements.withColumnRenamed("file", files.FILE), files.with_corrupt(schema)))
