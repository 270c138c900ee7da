"""Reading, scratch tables and vectorised words, shared by the operators."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import scratch_path

MB = 1024 * 1024
#: Rows without an id take part under this key and get their null back in the result.
NO_ID = 2**63 - 1
#: What Spark's statistics say at least about rows that come from no file.
UNKNOWN = 2**60
SPACE = r"[\x20\x09-\x0D]+"


def at_hand(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver has it; other machines have it installed or by --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    at_hand(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later steps reread it, also after an executor is lost.

    The shuffles behind the table are not needed any more. Spark deletes their files when the driver collects its garbage,
    which on a quiet driver can take until the disks are full, so it is asked to.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.scratch = path
    return read


def unstore(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again, as what was built on them is stored itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """What Spark's own statistics say about the size of the input."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, per_bucket: int, least: int = 1) -> int:
    """A power of two of buckets, of about ``per_bucket`` input bytes each."""
    return 2 ** max(math.ceil(math.log2(least)), math.ceil(math.log2(max(1.0, input_bytes(df) / per_bucket))))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (null: the last key) and the whole text as UTF-8 bytes (null: empty)."""
    at_hand(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more,
    )


def packed(docs: DataFrame) -> DataFrame:
    """keyed(docs) with compressed texts, which halves what the joins shuffle."""

    def compressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        small = zstandard.ZstdCompressor(level=3)
        for rows in batches:
            yield rows.assign(text=[small.compress(t) for t in rows["text"]])

    return keyed(docs).mapInPandas(compressed, "doc_id long, text binary")


def id_back(name: str = "doc_id") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or a single longer row."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


# ---------------------------------------------------------------- words as 64-bit hashes

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20250101).integers(0, 2**64, 256, dtype=np.uint64)
_BASE, _SEGMENT = 0x9E3779B97F4A7C15 | 5, 2 * MB
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverses modulo 2**64, for i < n."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, _SEGMENT + 1024)
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers[:] = both
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _segments(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Groups of texts of about two megabytes; longer texts are cut at white space."""
    group, rows, total = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while True:
            cut = len(text)
            if cut - at > _SEGMENT and (found := re.compile(rb"[ \t-\r]").search(text, at + _SEGMENT)):
                cut = found.start()
            group.append(text[at:cut] if at or cut < len(text) else text)
            rows.append(row)
            total += cut - at
            if total >= _SEGMENT:
                yield group, rows
                group, rows, total = [], [], 0
            at = cut
            if at >= len(text):
                break
    if group:
        yield group, rows


def word_hashes(texts: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts in order, and the row of each word.

    A word is read eight bytes at a time; each of these numbers is mixed with a key of its place before they are added up, so
    that no pattern of letters cancels out. Hashes by different seeds are independent.
    """
    hashes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    key, odd = np.uint64((seed + 1) * _BASE % 2**64), np.uint64(_BASE)
    for group, row in _segments(texts):
        data = np.frombuffer(b" " + b" ".join(group) + b" " * 8, np.uint8)
        space = _IS_SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        if len(start):
            eights = (end - start + 7) >> 3
            first = np.cumsum(eights) - eights
            place = np.arange(int(eights.sum())) - np.repeat(first, eights)
            at = np.repeat(start, eights) + 8 * place
            value = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[at]
            beyond = 8 - np.minimum(np.repeat(end, eights) - at, 8)  # bytes of the number behind the word
            value &= np.uint64(2**64 - 1) >> (8 * beyond).astype(np.uint64)
            value = mixed(value ^ mixed(place.astype(np.uint64) * odd + key))
            hashes.append(mixed(np.add.reduceat(value, first) + (end - start).astype(np.uint64) * odd))
        at = np.cumsum([1, *(len(x) + 1 for x in group[:-1])])
        rows.append(np.asarray(row, np.int64)[np.searchsorted(at, start, "right") - 1])
    return np.concatenate(hashes), np.concatenate(rows)


def window_hashes(words: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp hash of each run of ``size`` words, by Horner's rule over shifted arrays."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(base) + words[i : i + n]
    return mixed(out)
