"""Repeated word windows: each window of a fixed number of words is hashed, counted in Spark and cut from later documents.

A task hashes all windows of its texts by Rabin-Karp (Horner's rule over word hashes modulo 2**64, mixed). Hashes are dealt to
buckets by their top bits, packed in binary columns, and with each travels a check of 24 bits, of other word hashes and another
base, so the shuffle carries about 12 bytes a window. Before that a task keeps one entry per hash and chunk of texts, that of the
smallest document: a window that a third of all documents share reaches its bucket once per chunk. The other documents of
the chunk have to drop the window in any case; they do not meet in its bucket but are spread by document. A bucket finds the smallest
document of each hash and returns the hashes that other documents have to drop; these meet the texts again by doc_id, overlapping
windows merge into maximal intervals, and the words inside go.

Windows are equal if their hashes and checks, 88 bits, are: among 10**12 different windows (10 TB) a false match has a chance of
about one in 600, among 10**13 of one in six. Words are hashed eight bytes at a time, each mixed with its place, so that no pattern of letters makes them collide.
Memory: a bucket holds about ``per_bucket`` bytes of input, as the number of buckets follows Spark's statistics, and a text is
held whole.

Null, empty and short texts have no windows and lose nothing. Texts of any length are hashed whole. A window that is repeated within
one document only stays. Of repeated rows the one with the smallest id keeps its words; those with the same id all keep them. Rows without
an id count as after all others and do not remove words from each other, nor do rows that share an id. An empty table gives an empty
result. Other columns, of whatever name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, buckets_for, chunks, id_back, keyed, mixed, packed, table, window_hashes, word_hashes

CHUNK = 6 * MB
CHECK_BASE = 0xD6E8FEB86659FD93


def hashed(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows within each text, and the row of each."""
    words, row = word_hashes(texts)
    windows = window_hashes(words, size)
    inside = row[: len(windows)] == row[size - 1 :][: len(windows)]
    return windows[inside], row[: len(windows)][inside]


def checked(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashed``, and a check of each window that does not depend on its hash."""
    words, row = word_hashes(texts, seed=1)
    windows = window_hashes(words, size, base=CHECK_BASE)
    inside = row[: len(windows)] == row[size - 1 :][: len(windows)]
    return *hashed(texts, size), (windows[inside] >> np.uint64(40)).astype(np.uint32)


def _low(values: np.ndarray, width: int) -> bytes:
    """The low bytes of each number; of a hash seven, as the top byte follows from the bucket."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _whole(data: bytes, width: int, top: int = 0) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    out[:, 7] = top
    return out.reshape(-1).view("<u8")


def _steps(ids: np.ndarray) -> bytes:
    """Ascending ids as differences, byte by byte of all, which compresses well."""
    return np.diff(ids, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _ids(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").reshape(-1))


def bucket_bits(docs: DataFrame, per_bucket: int = 4 * MB) -> int:
    return max(8, int(np.log2(buckets_for(docs, per_bucket))))


def _cuts(values: np.ndarray) -> list[tuple[int, int]]:
    """The runs of equal values."""
    at = np.r_[0, np.flatnonzero(np.diff(values)) + 1, len(values)].tolist() if len(values) else [0]
    return list(zip(at[:-1], at[1:], strict=True))


def _sorted(h: np.ndarray, check: np.ndarray, then: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The order by hash, check and ``then`` (else as they come), and where in it another window begins."""
    by = np.lexsort((check, h) if then is None else (then, check, h))
    return by, np.r_[True, (h[by][1:] != h[by][:-1]) | (check[by][1:] != check[by][:-1])] if len(h) else np.empty(0, bool)


def repeats(docs: DataFrame, hash_texts, bits: int, everyone: bool = False) -> DataFrame:
    """bucket, doc_id and ``hashes`` (eight bytes each) that repeat, of ``hash_texts(texts)``: the hashes, their rows and, if any, their checks.

    Returned to a document are the hashes that a document with a smaller id has too, some in buckets below zero, which go by
    document; with ``everyone`` all hashes that occur twice or more, in one or several documents, each once.
    """

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts, ids = rows["text"].tolist(), rows["doc_id"].to_numpy(np.int64)
            for a, b in chunks(list(map(len, texts)), CHUNK):
                order = a + np.argsort(ids[a:b], kind="stable")
                h, row, *checks = hash_texts([texts[i] for i in order])
                if len(h) == 0:
                    continue
                check = checks[0] if checks else np.zeros(len(h), np.uint32)
                doc = ids[order][row]
                by, new = _sorted(h, check)  # ties stay in the order of ids
                group = np.cumsum(new) - 1
                told = np.bincount(group)[group] > 1 if everyone else doc[by] > doc[by][new][group]
                top = (h >> np.uint64(64 - bits)).astype(np.int64)
                spread = top if everyone else -1 - (mixed(doc.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
                for kind, places, bucket in ((0, np.sort(by[new]), top), (1, np.sort(by[told]), spread)):
                    places = places[np.argsort(bucket[places], kind="stable")]
                    if len(places):
                        yield pd.DataFrame([
                            {
                                "bucket": int(bucket[places[x]]), "kind": kind, "hashes": _low(h[places[x:y]], 7 if bucket[places[x]] >= 0 else 8),
                                "checks": _low(check[places[x:y]], 3) if checks and kind == 0 else b"", "ids": _steps(doc[places[x:y]]),
                            }
                            for x, y in _cuts(bucket[places])
                        ])

    def judged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top, told = key[0] >> (bits - 8), ([np.empty(0, np.uint64)], [np.empty(0, np.int64)])
        first = ([np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint32)])
        for kind, hashes, checks, ids in zip(rows["kind"], rows["hashes"], rows["checks"], rows["ids"], strict=True):
            into = told if kind else first
            into[0].append(_whole(hashes, 7, top) if key[0] >= 0 else np.frombuffer(hashes, "<u8"))
            into[1].append(_ids(ids))
            if not kind:
                first[2].append(_whole(checks, 3).astype(np.uint32) if checks else np.zeros(len(into[0][-1]), np.uint32))
        h, doc, check = map(np.concatenate, first)
        by, new = _sorted(h, check, doc)
        h, doc = h[by], doc[by]
        group = np.cumsum(new) - 1
        later = new if len(h) == 0 else np.bincount(group)[group] > 1 if everyone else doc > doc[new][group]
        h, doc = np.concatenate([h[later], *told[0]]), np.concatenate([doc[later], *told[1]])
        by = np.lexsort((h, doc))
        h, doc = h[by], doc[by]
        once = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
        h, doc = h[once], doc[once]
        cuts = _cuts(doc)
        return pd.DataFrame({"bucket": key[0], "doc_id": doc[[x for x, _ in cuts]] if cuts else doc, "hashes": [h[x:y].tobytes() for x, y in cuts]})

    found = keyed(docs).mapInPandas(dealt, "bucket long, kind int, hashes binary, checks binary, ids binary")
    return found.groupBy("bucket").applyInPandas(judged, "bucket long, doc_id long, hashes binary")


def intervals(hashes: np.ndarray, repeated: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of words under repeated windows."""
    at = np.flatnonzero(np.isin(hashes, repeated))
    if len(at) == 0:
        return at, at
    cut = np.flatnonzero(np.diff(at) > size)
    return at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + size


def remove_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """doc_id (null: the last key), n_words, n_removed, the removed ``spans`` (words, end exclusive) and the kept words as ``kept`` bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = zstandard.ZstdDecompressor()
        for rows in batches:
            for a, b in chunks([3 * len(t) for t in rows["text"]], CHUNK):  # packed to about a third
                out = []
                for text, found in zip(map(plain.decompress, rows["text"].iloc[a:b]), rows["found"].iloc[a:b], strict=True):
                    words, spans = text.split(), []
                    n, kept = len(words), words
                    if found is not None and len(found):
                        starts, ends = intervals(hashed([text], size)[0], np.frombuffer(b"".join(found), np.uint64), size)
                        spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
                        keep = np.ones(n, bool)
                        for x, y in spans:
                            keep[x:y] = False
                        kept = [w for w, k in zip(words, keep, strict=True) if k]
                    out.append((n, n - len(kept), [{"start": x, "end": y} for x, y in spans], b" ".join(kept)))
                yield pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "kept"]).assign(doc_id=rows["doc_id"].iloc[a:b].to_numpy())

    found = repeats(docs, lambda texts: checked(texts, size), bucket_bits(docs)).groupBy("doc_id").agg(F.collect_list("hashes").alias("found"))
    return packed(docs).join(found, "doc_id", "left").mapInPandas(cut, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


def op5_windows(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(id_back(), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
