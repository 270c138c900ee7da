"""Token ids of whole texts in binary blocks.

Ids are replaced by their rank in the corpus (the most frequent id is 0) and written in byte-aligned variable length:
two bits in a control byte give the length, 1 to 4 bytes, of each of four values, and the value bytes follow apart from
them. A reader looks the lengths of four values up by control byte, sums them to offsets, and gathers with numpy.

A block is one row of a Parquet table ``blocks`` (so that any store Spark writes to will do):

    b"LTK1", documents u32, ids u64, doc_id i64 each, ids of each document u32, control bytes, value bytes

all little-endian. ``part`` and ``seq`` order the blocks, ``part_start`` counts the ids of the part before the block, and
the table ``ranks`` has the id of each rank. Documents are in ascending order of doc_id (rows without an id come last, rows
with equal ids in the order of a hash of their text) or, if asked for, in the order of the files they come from. Null and empty texts have only the end id. Repeated rows are kept.

The text is cut before each single space that precedes a word, which is always a boundary of the byte-level
pre-tokenizer, so each distinct word is encoded by the library once for a while and then found in a table of the worker.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import id_back, keyed, stored, table, unstore

MAGIC, HEAD = b"LTK1", struct.Struct("<4sIQ")
BLOCK_IDS, CACHED, KNOWN = 1 << 18, 600_000, 50_000
_ID = attrgetter("id")
_SPACES = "\t-\r \x85\xa0  -     　"


# ---------------------------------------------------------------- variable-length coding

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and value bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[: len(v)] = size - 1
    control = code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    most = int(size.max(initial=1))  # bytes that no value reaches are not looked at
    data = v.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most, dtype=np.uint8) < size[:, None]]
    return np.bitwise_or.reduce(control, axis=1).tobytes() if len(v) else b"", data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """``n`` values: lengths by table, offsets by a running sum, values by gathering."""
    size = _LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if len(longer) == 0:
            break
        out[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out & _MASK[size]


def block(doc_ids: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> bytes:
    return b"".join([HEAD.pack(MAGIC, len(doc_ids), len(values)), doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes(), *pack(values)])


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, lengths and values of a block."""
    magic, docs, n = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    lengths = np.frombuffer(data, "<u4", docs, at + 8 * docs)
    raw = np.frombuffer(data, np.uint8, offset=at + 12 * docs)
    controls = -(-n // 4)
    return doc_ids, lengths, unpack(raw[:controls], raw[controls:], n)


# ---------------------------------------------------------------- encoding

class Encoder(dict):
    """Token ids, as little-endian 32-bit bytes, by piece of text; unknown pieces are encoded by the library.

    A full table becomes the old one, and what is still in use moves back from there.
    """

    cut = re.compile(f" (?=[^{_SPACES}])")
    odd = re.compile(f" (?:[{_SPACES}]|$)")
    plain = re.compile("[ -~\n¡-ɏ]*")

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        before = self.whole.pre_tokenizer
        # only a pre-tokenizer known to cut before each such space can be given pieces
        self.pieces = "ByteLevel" in repr(before) and self.whole.normalizer is None
        self.parts = regex.compile(public_tokenizers.PATTERN).findall
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.space = self.letters[32]
        self.model, self.before, self.old, self.known = self.whole.model, before, {}, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            stem = piece.rstrip(".,!%&*$#|")
            if stem == piece and stem.isalpha():  # one piece
                if piece.isascii():  # letters that stand for themselves
                    ids = self._named(self.space + piece)
                else:
                    ids = self._one(" " + piece)
            elif stem.isalpha():  # letters and signs are always pieces of their own
                ids = self[stem] + self._ids(piece[len(stem) :])
            else:
                ids = self._ids(" " + piece)
        if len(piece) <= 64:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _named(self, letters: str) -> bytes:
        return array("I", map(_ID, self.model.tokenize(letters))).tobytes()

    def _one(self, part: str) -> bytes:
        return self._named(part.encode().decode("latin-1").translate(self.letters))

    def _part(self, part: str) -> bytes:
        """Of one piece; words are kept in the table, signs and the rest apart from it."""
        if part[0] == " " and part[1:].isalpha():
            return self[part[1:]]
        ids = self.known.get(part)
        if ids is None:
            ids = self._one(part)
            if len(part) <= 64:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[part] = ids
        return ids

    def _ids(self, text: str) -> bytes:
        if len(text) == 1:  # a sign behind a word
            return self._part(text)
        parts = self.parts(text) if self.plain.fullmatch(text) else [text[a:b] for _, (a, b) in self.before.pre_tokenize_str(text)]
        return b"".join(map(self._part, parts))

    def encode(self, text: str) -> bytes:
        if not self.pieces or any(a in text for a in self.added):  # the library finds its added tokens before it cuts
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        rest = text.split(" ") if not self.odd.search(text) else self.cut.split(text)
        first = np.array(self.whole.encode(rest[0], add_special_tokens=False).ids, "<u4").tobytes() if rest[0] else b""
        return first + b"".join(map(self.__getitem__, rest[1:]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One table per worker, kept from task to task."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _blocks(ids: Iterator[tuple[int, bytes]], end: bytes) -> Iterator[dict]:
    """Documents, in order, gathered to rows of about BLOCK_IDS ids."""
    part, seq, before = TaskContext.get().partitionId(), 0, 0
    docs, texts, size = [], [], 0
    for doc, found in ids:
        docs.append(doc)
        texts.append(found + end)
        size += len(found) // 4 + 1
        if size >= BLOCK_IDS:
            yield {"part": part, "seq": seq, "part_start": before, "docs": docs, "texts": texts, "size": size}
            seq, before, docs, texts, size = seq + 1, before + size, [], [], 0
    if docs:
        yield {"part": part, "seq": seq, "part_start": before, "docs": docs, "texts": texts, "size": size}


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, name: str = "tokens", in_file_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """Encode every text, append ``end_id`` and write the blocks; returns the stored ``blocks`` and ``ranks``.

    With ``in_file_order`` documents come in the order of the files they are read from, else by doc_id.
    The driver holds one row per rank (the size of the vocabulary at most).
    """
    small = "<u2" if end_id < 2**16 and _vocabulary(tokenizer) <= 2**16 else "<u4"
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(tokenizer)
        rows = ((doc, code.encode(text.decode())) for b in batches for doc, text in zip(b["doc_id"], b["text"], strict=True))
        for b in _blocks(rows, end):
            ids = np.frombuffer(b"".join(b["texts"]), "<u4")
            yield pd.DataFrame([{
                "part": b["part"], "seq": b["seq"], "part_start": b["part_start"], "n_ids": b["size"],
                "doc_ids": np.array(b["docs"], "<i8").tobytes(), "lengths": np.array([len(t) // 4 for t in b["texts"]], "<u4").tobytes(),
                "ids": ids.astype(small).tobytes(),
            }])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for ids in (x for b in batches for x in b["ids"]):
            n = np.bincount(np.frombuffer(ids, small))
            total = np.pad(total, (0, max(0, len(n) - len(total))))
            total[: len(n)] += n
        found = np.flatnonzero(total)
        yield pd.DataFrame({"id": found, "n": total[found]})

    if in_file_order:
        rows, order = keyed(docs, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")), ["file", "row"]
    else:
        rows, order = keyed(docs, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie")), ["doc_id", "tie"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    raw = stored(sorted_rows.mapInPandas(encoded, "part int, seq int, part_start long, n_ids long, doc_ids binary, lengths binary, ids binary"), f"{name}-raw")
    counts = raw.select("ids").mapInPandas(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    docs.sparkSession.sparkContext._jvm.System.gc()  # the shuffled texts are held until another job has run: see ``stored``
    ids = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], np.int64)
    rank = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    rank[ids] = np.arange(len(ids))

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [block(np.frombuffer(d, "<i8"), np.frombuffer(n, "<u4"), rank[np.frombuffer(i, small)]) for d, n, i in zip(rows["doc_ids"], rows["lengths"], rows["ids"], strict=True)]
            yield rows[["part", "seq", "part_start", "n_ids"]].assign(block=made)

    blocks = stored(raw.mapInPandas(ranked, "part int, seq int, part_start long, n_ids long, block binary"), f"{name}-blocks")
    unstore(raw)
    spark = docs.sparkSession
    ranks = stored(spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(ids)), "id": ids}), "rank long, id long").coalesce(1), f"{name}-ranks")
    return blocks, ranks


def _vocabulary(tokenizer: str) -> int:
    return max(encoder(tokenizer).whole.get_vocab().values()) + 1


def read_tokens(blocks: DataFrame, ranks: DataFrame) -> DataFrame:
    """doc_id (null: the last key), start, n_tokens and ids (little-endian 32-bit) of each document, from the files.

    The driver holds one row per rank and one per part.
    """
    ids = np.array([r["id"] for r in ranks.orderBy("rank").collect()], "<u4")
    parts = sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    first = dict(zip([r["part"] for r in parts], np.cumsum([0, *(r["n"] for r in parts)]).tolist(), strict=False))

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part, before, data in zip(rows["part"], rows["part_start"], rows["block"], strict=True):
                doc_ids, lengths, ranked = read_block(data)
                found, ends = ids[ranked].tobytes(), np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                yield pd.DataFrame({
                    "doc_id": doc_ids, "start": first[part] + before + starts, "n_tokens": lengths.astype(np.int64),
                    "ids": [found[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
                })

    return blocks.select("part", "part_start", "block").mapInPandas(decoded, "doc_id long, start long, n_tokens long, ids binary")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def digest(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, in_file_order: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and the CRC of the ids of each document, as the written files have them."""
    found = read_tokens(*write_tokens(docs, tokenizer or tokenizer_path(), end_id, in_file_order=in_file_order))
    return found.select(id_back(), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"))
