"""Document fingerprints by Order MinHash, whose likeness falls with the edit distance and not only with the shared content.

A k-mer is a run of eight UTF-8 bytes, which is a 64-bit number as it stands, together with its occurrence number: the third
"the same" of a text is another element than its first. Each of ``sketches`` hash functions orders these elements; the
``tuple_size`` smallest are taken, put back into the order in which they stand in the text, and their k-mers are hashed to one
16-bit component. Two texts agree in a component if the same k-mers were least *and* stand in the same order, so that moving
text lowers the likeness too. The likeness of two fingerprints is the share of equal components.

Texts are compressed and dealt by range of doc_id (descending), sorted, and read one after the other, so each text is moved once and
a task holds one batch of rows, whatever their number. A task also returns the texts of its first and its last row; these few
rows are paired with those of the next range afterwards. Rows of one id are spread by a hash of their text.

Null texts are empty. A text of fewer than eight bytes has one k-mer, filled up with zeros, to which its length is mixed; the
empty text has it as well. Texts with fewer elements than a tuple takes use those they have. Texts of any length are read whole,
a block of their k-mers at a time. Equal texts have equal fingerprints. Rows without an id come after all others; rows that share an id follow each
other by the hash of their text. The next row after the last is the first, so a single row is followed by itself. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, UNKNOWN, at_hand, input_bytes, mixed, stored, table

K, SKETCHES, TUPLE = 8, 64, 2
BLOCK = 4096


def odd_factors(n: int) -> np.ndarray:
    return np.random.default_rng(13).integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def occurrences(kmers: np.ndarray) -> np.ndarray:
    """How often each value stands before its place."""
    n = len(kmers)
    if n < 2**20:
        key = np.sort(mixed(kmers) & np.uint64(2**64 - 2**20) | np.arange(n, dtype=np.uint64))
        order, key = (key & np.uint64(2**20 - 1)).astype(np.int64), key >> np.uint64(20)
        inside = np.r_[False, key[1:] == key[:-1]]
        again = np.flatnonzero(inside)
        mistaken = (kmers[order[again]] != kmers[order[again - 1]]).any()
    if n >= 2**20 or mistaken:  # long, or two values with the same upper 44 bits
        order = np.argsort(kmers, kind="stable")
        inside = np.r_[False, kmers[order][1:] == kmers[order][:-1]]
    seen = np.zeros(n, np.uint64)
    if inside.any():
        at = np.arange(n)
        seen[order] = at - np.maximum.accumulate(np.where(inside, 0, at))
    return seen


def elements(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The k-mers of a text by position, and a hash of each with its occurrence number."""
    if len(data) < K:
        kmers = np.frombuffer(data.ljust(K, b"\0"), "<u8") + np.array([len(data)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return kmers, mixed(kmers)
    raw = np.frombuffer(data, np.uint8)
    kmers = np.ndarray(len(raw) - K + 1, "<u8", raw, strides=(1,)).copy()
    return kmers, mixed(kmers ^ mixed(occurrences(kmers) * np.uint64(0xD6E8FEB86659FD93)))


def fingerprint(data: bytes, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """One 16-bit component per hash function."""
    kmers, h = elements(data)
    factors, size = odd_factors(sketches)[:, None], min(size, len(h))
    h = (h >> np.uint64(32)).astype(np.uint32)
    top = np.uint32(2**32 - 1)
    values, places = np.empty((sketches, 0), np.uint32), np.empty((sketches, 0), np.int64)
    rows = np.arange(sketches)
    for first in range(0, len(h), BLOCK):
        keys = h[first : first + BLOCK] * factors
        found = []
        for _ in range(min(size, keys.shape[1])):
            least = keys.argmin(axis=1)
            found.append((keys[rows, least], least + first))
            keys[rows, least] = top
        values = np.column_stack([values, *(v for v, _ in found)])
        places = np.column_stack([places, *(p for _, p in found)])
        if values.shape[1] > size:
            keep = np.argsort(values, axis=1, kind="stable")[:, :size]
            values, places = np.take_along_axis(values, keep, 1), np.take_along_axis(places, keep, 1)
    chosen = kmers[np.sort(places, axis=1)]
    out = np.arange(sketches, dtype=np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + chosen[:, i])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def as_hex(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, sketches: int = SKETCHES, size: int = TUPLE) -> DataFrame:
    """doc_id and fingerprint of each row."""
    at_hand(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            made = [as_hex(fingerprint(t, sketches, size)) for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(of, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def with_half_of(text: str, following: str) -> str:
    """The text with its last half replaced by the first code points of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(), "near_next": pa.float64(),
}
ENDS = {"part": pa.int32(), "end": pa.string(), "text": pa.binary()}
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def _row(doc_id: int | None, text: str, own: np.ndarray, following: str, its: np.ndarray, sketches: int, size: int) -> tuple:
    data = with_half_of(text, following).encode()
    edited = fingerprint(data, sketches, size)
    return doc_id, len(text), hashlib.sha256(data).hexdigest(), as_hex(own), as_hex(edited), likeness(own, edited), likeness(own, its)


def compared(docs: DataFrame, sketches: int = SKETCHES, size: int = TUPLE) -> DataFrame:
    """The columns of RESULT: each row beside its edited text and beside the next row, by descending doc_id."""
    spark = at_hand(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for rows in batches:
            texts = pa.array([pack.compress(t) for t in rows.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("h"), texts], ["doc_id", "h", "text"])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, part, last, data = zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), None, b""
        kinds, none = RESULT | ENDS, (None,) * (len(RESULT) - 1)
        for rows in batches:
            done = []
            for doc_id, data in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                raw = unpack.decompress(data)
                now = (doc_id, raw.decode("utf-8", "replace"), fingerprint(raw, sketches, size))
                done.append((doc_id, *none, part, "first", data) if last is None else (*_row(*last, *now[1:], sketches, size), None, None, None))
                last = now
            yield _batch(done, kinds)
        if last is not None:
            yield _batch([(last[0], *none, part, "last", data)], kinds)

    def at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for rows in batches:
            done = []
            for doc_id, *both in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                one, two = ((raw.decode("utf-8", "replace"), fingerprint(raw, sketches, size)) for raw in map(unpack.decompress, both))
                done.append(_row(doc_id, *one, *two, sketches, size))
            yield _batch(done, RESULT)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    parts, size_known = int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs)
    if size_known < UNKNOWN:
        parts = max(parts, math.ceil(size_known / (64 * MB)))
    order = [F.desc("doc_id"), F.asc("h")]
    dealt = texts.mapInArrow(packed, "doc_id long, h long, text binary").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = stored(dealt.select("doc_id", "text").mapInArrow(in_order, f"{_SCHEMA}, part int, end string, text binary"), "order-minhash")
    ends = found.where(F.col("end").isNotNull())
    numbers = sorted(r["part"] for r in ends.where("end = 'first'").select("part").collect())  # one number per task
    follow = spark.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1], strict=True)), "part int, next_part int")
    pairs = ends.where("end = 'last'").select("doc_id", "part", "text").join(follow, "part").join(
        ends.where("end = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part")
    rest = pairs.select("doc_id", "text", "following").mapInArrow(at_borders, _SCHEMA)
    return found.where(F.col("end").isNull()).select(*RESULT).unionByName(rest)


def op13_order_minhash(spark, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents").select("doc_id", "text"))
