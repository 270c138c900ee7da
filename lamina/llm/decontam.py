"""Benchmark decontamination by latent semantic retrieval.

1. Words (lower-cased, signs at their ends cut off) become one of ``TERMS`` ids by hash; stored once per document. The share of
   all 32-word passages that hold a term gives its inverse document frequency, counted over the whole corpus.
2. A randomised singular value decomposition of the TF-IDF matrix of all passages: each task multiplies its rows A
   with a fixed random matrix and returns the terms' sums of A'A R, a matrix of TERMS x RANK, block by block; Spark adds them up.
   The driver turns the sum into an orthogonal basis of latent dimensions (Nystroem's formula).
3. Windows of the documents and of the benchmark items are projected to the latent space: 32 words long for items of at least
   so many words, 16 words long for shorter ones, at every half of their length in documents and every quarter in items. Pairs with a cosine
   of ``cosine`` or more are candidates, if half of the window's words are words of the item.
4. Each candidate is settled by the longest common subsequence of words between the item and the text around the window: at least
   ``similar`` (0.8) of the item's words, or ``answered`` of them if the item's answer, its last words, also occurs in one piece.
   So altered, dropped or inserted words do not hide a copy.

Benchmark items are taken in slices of ``SLICE`` so that what is broadcast, item vectors and item words, has a fixed bound.
Items of fewer than ``LEAST_WORDS`` words prove nothing and match no document. Null and empty texts match nothing; a null
item_id or doc_id is kept as it is in the result. Repeated rows and items each give their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, NO_ID, chunks, id_back, keyed, stored, table, word_hashes

TERMS, RANK, PASSAGE, SHORT, SLICE, LEAST_WORDS, ANSWER = 1 << 15, 32, 32, 16, 2000, 8, 5
_EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SIGNS = bytes.maketrans(_EDGE + bytes(range(65, 91)), b" " * len(_EDGE) + bytes(range(97, 123)))


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The term of each word, and the row it is in. Signs of ASCII separate words."""
    h, row = word_hashes([t.translate(_SIGNS) for t in texts])
    return (h & np.uint64(TERMS - 1)).astype(np.uint16), row


def passages(blobs: list[bytes]) -> np.ndarray:
    """Consecutive passages of PASSAGE words of each document, the last one filled up with TERMS."""
    n = np.array([len(b) // 2 for b in blobs], np.int64)
    out = np.full(int((-(-n // PASSAGE) * PASSAGE).sum()), TERMS, np.uint16)
    start = np.cumsum(-(-n // PASSAGE) * PASSAGE) - -(-n // PASSAGE) * PASSAGE
    out[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())] = np.frombuffer(b"".join(blobs), np.uint16)
    return out.reshape(-1, PASSAGE)


def documents_as_terms(docs: DataFrame) -> DataFrame:
    """doc_id (null: the last key) and the terms of the whole text, two bytes each, stored."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = rows["text"].tolist()
            for a, b in chunks([len(t) for t in texts], 2 * MB):
                t, row = terms(texts[a:b])
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                yield pd.DataFrame({"doc_id": rows["doc_id"].iloc[a:b].to_numpy(), "terms": [t[x:y].tobytes() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]})

    return stored(keyed(docs).mapInPandas(made, "doc_id long, terms binary"), "terms")


def _groups(batches: Iterator[pd.DataFrame], words: int = 400_000) -> Iterator[pd.DataFrame]:
    """The rows of the batches in groups of about so many words."""
    for rows in batches:
        for a, b in chunks([len(t) // 2 for t in rows["terms"]], words):
            yield rows.iloc[a:b]


def idf(corpus: DataFrame) -> np.ndarray:
    """Inverse document frequency of each term over all passages of the corpus; 0 for the filling."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(TERMS + 1, np.int64), 0
        for rows in _groups(batches):
            w = np.sort(passages(rows["terms"].tolist()), axis=1)
            first = np.c_[np.ones(len(w), bool), w[:, 1:] != w[:, :-1]]
            total += np.bincount(w[first], minlength=TERMS + 1)
            n += len(w)
        found = np.flatnonzero(total[:TERMS])
        yield pd.DataFrame({"term": np.r_[found, TERMS], "n": np.r_[total[found], n]})

    rows = corpus.mapInPandas(counted, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # TERMS + 1 rows at most
    n = np.zeros(TERMS + 1)
    for r in rows:
        n[r["term"]] = r["n"]
    out = np.log((n[TERMS] + 1) / (n + 1)) + 1e-3
    out[TERMS] = 0
    return out.astype(np.float32)


def _weights(w: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The TF-IDF weight of each word over the length of its passage's row."""
    order = np.sort(w, axis=1)
    ends = np.flatnonzero(np.c_[np.ones(len(w), bool), order[:, 1:] != order[:, :-1]].ravel())
    times = np.diff(np.r_[ends, order.size])  # a term that occurs k times has the weight k * idf
    squares = (weight[order.ravel()[ends]] * times) ** 2
    length = np.sqrt(np.maximum(np.bincount(ends // PASSAGE, squares, len(w)), 1e-12))
    return weight[w] / length[:, None].astype(np.float32)


def basis(corpus: DataFrame, weight: np.ndarray, seed: int = 3) -> np.ndarray:
    """TERMS + 1 rows: the right singular vectors over their singular values.

    Without that division the first dimensions, those of the languages and of common words, would make most cosines large.
    """
    rng = np.random.default_rng(seed)
    random = np.r_[rng.standard_normal((TERMS, RANK)), np.zeros((1, RANK))].astype(np.float32)

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((TERMS + 1, RANK), np.float64)
        for rows in _groups(batches):
            w = passages(rows["terms"].tolist())
            x = _weights(w, weight)
            for d in range(RANK):  # one dimension at a time: its column of the random matrix stays in the cache
                y = (random[:, d][w] * x).sum(1)
                total[:, d] += np.bincount(w.ravel(), (y[:, None] * x).ravel(), TERMS + 1)
        for at in range(0, TERMS, 1024):
            yield pd.DataFrame([{"block": at // 1024, "sums": total[at : at + 1024].astype(np.float32).tobytes()}])

    def added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s, np.float32).astype(np.float64) for s in rows["sums"]], axis=0)
        return pd.DataFrame([{"block": key[0], "sums": total.tobytes()}])

    blocks = corpus.mapInPandas(multiplied, "block int, sums binary").groupBy("block").applyInPandas(added, "block int, sums binary").collect()
    z = np.zeros((TERMS, RANK))
    for r in blocks:
        z[r["block"] * 1024 : (r["block"] + 1) * 1024] = np.frombuffer(r["sums"]).reshape(-1, RANK)
    # A'A is about z (R'z)^-1 z': with z = q t the core is t (R'z)^-1 t', whose eigenvectors turn q to the singular vectors
    q, t = np.linalg.qr(z)
    core = t @ np.linalg.pinv(random[:TERMS].astype(np.float64).T @ z) @ t.T
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    least = max(values[-1] * 1e-6, 1e-12)
    v = q @ vectors[:, values > least] / np.sqrt(values[values > least])
    v = np.c_[v, np.zeros((TERMS, RANK - v.shape[1]))]
    return np.r_[v, np.zeros((1, RANK))].astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors over the item."""
    place: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        place[t] = place.get(t, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for t in text.tolist():
        hit = row & place.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def _holds(text: np.ndarray, part: np.ndarray) -> bool:
    return part.tobytes() in text.tobytes() and any((text[i : i + len(part)] == part).all() for i in range(len(text) - len(part) + 1))


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.62, similar: float = 0.8, answered: float = 0.6) -> DataFrame:
    """doc_id (null: the last key), item_id, first and last word of the place, cosine, share (of the item's words in common) and answer."""
    spark = docs.sparkSession
    corpus = documents_as_terms(docs)
    weight = idf(corpus)
    matrix = spark.sparkContext.broadcast(np.ascontiguousarray((weight[:, None] * basis(corpus, weight)).T))  # RANK x TERMS
    schema = "doc_id long, item_id string, first long, last long, cosine double, share double, answer boolean"
    found = None
    for items in _slices(benchmark):
        words = [(i, terms([(t or "").encode()])[0]) for i, t in items]
        words = [(i, t) for i, t in words if len(t) >= LEAST_WORDS]
        if not words:
            continue
        shared = spark.sparkContext.broadcast((words, [_sought(words, matrix.value, size) for size in (PASSAGE, SHORT)]))  # SLICE items

        def searched(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            words, sought = shared.value
            for rows in _groups(batches, 100_000):
                blobs, ids = rows["terms"].tolist(), rows["doc_id"].to_numpy(np.int64)
                out = []
                for (doc, item), place in _candidates(blobs, words, sought, matrix.value, cosine).items():
                    name, own = words[item]
                    best = max(_settle(own, np.frombuffer(blobs[doc], np.uint16), at, near, similar, answered) for at, near in place.items())
                    if best[0]:
                        _, share, near, first, last, answer = best
                        out.append((int(ids[doc]), name, first, last, near, share, answer))
                if out:
                    yield pd.DataFrame(out, columns=["doc_id", "item_id", "first", "last", "cosine", "share", "answer"])

        part = corpus.mapInPandas(searched, schema)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], schema)


def _sought(words: list[tuple], matrix: np.ndarray, size: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """size, unit vectors of the windows of the items that this size serves, their items and offsets."""
    vectors, owner, offset = [], [], []
    for k, (_, own) in enumerate(words):
        if (len(own) >= PASSAGE) != (size == PASSAGE):
            continue
        starts = sorted({*range(0, max(1, len(own) - size + 1), size // 4), max(0, len(own) - size)})
        vectors += [matrix[:, own[s : s + size]].sum(1) for s in starts]
        owner += [k] * len(starts)
        offset += starts
    return size, _unit(np.array(vectors, np.float32).reshape(-1, len(matrix))), np.array(owner, np.int64), np.array(offset, np.int64)


def _candidates(blobs: list[bytes], words: list[tuple], sought: list[tuple], matrix: np.ndarray, cosine: float) -> dict[tuple[int, int], dict[int, float]]:
    """(document, item): the places where the item would begin, and their cosines; places close to each other count once."""
    n = np.array([len(b) // 2 for b in blobs], np.int64)
    ends = np.cumsum(n)
    flat = np.frombuffer(b"".join(blobs), np.uint16)
    total = np.zeros((len(flat) + 1, len(matrix)))  # a window is the difference of two rows of running sums
    np.cumsum(np.ascontiguousarray(matrix.T)[flat], axis=0, out=total[1:])
    found: dict[tuple[int, int], dict[int, float]] = {}
    longs = np.array([len(own) for _, own in words])
    has = np.zeros((len(words), TERMS), bool)
    for k, (_, own) in enumerate(words):
        has[k, own] = True
    for size, vectors, owner, offset in sought:
        if len(vectors) == 0 or len(flat) == 0:
            continue
        # every half of the size from the start of each document on; a window ends with its document at the latest
        steps = -(-n // (size // 2))
        doc = np.repeat(np.arange(len(n)), steps)
        start = (np.arange(len(doc)) - (np.cumsum(steps) - steps)[doc]) * (size // 2)
        first = (ends - n)[doc] + start
        last = np.minimum(first + size, ends[doc])
        for at in range(0, len(doc), 4096):
            part = slice(at, at + 4096)
            near = _unit((total[last[part]] - total[first[part]]).astype(np.float32)) @ vectors.T
            x, y = np.divmod(np.flatnonzero(near.ravel() >= np.float32(cosine)), len(vectors))
            # half of the shorter one's words must be words of the item: a bound that any settled pair meets
            inside = first[part][x, None] + np.arange(size)
            hits = has[owner[y, None], flat[np.minimum(inside, len(flat) - 1)]] & (inside < last[part][x, None])
            enough = 2 * hits.sum(1) >= np.minimum(longs[owner[y]], last[part][x] - first[part][x])
            for x, y in zip(x[enough].tolist(), y[enough].tolist(), strict=True):
                item = int(owner[y])
                places = found.setdefault((int(doc[at + x]), item), {})
                place = int(start[at + x]) - int(offset[y])
                if not any(abs(place - p) < max(4, int(longs[item]) // 4) for p in places):
                    places[place] = float(near[x, y])
    return found


def _settle(own: np.ndarray, text: np.ndarray, place: int, near: float, similar: float, answered: float) -> tuple:
    """Whether the text has the item near ``place``, the share of its words in common, the cosine, the words looked at and the answer."""
    n = len(own)
    first, last = max(0, place - n // 2 - SHORT), min(len(text), place + n + n // 2 + SHORT)
    around = text[first:last]
    share = common_subsequence(own, around) / n
    answer = share >= answered and _holds(around, own[-ANSWER:])
    return share >= similar or answer, share, near, first, last, answer


def _slices(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items in slices of at most SLICE, by a hash of their id and text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("words"))
    n = -(-items.count() // (SLICE // 2))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(max(1, n))))
    for k in range(n):
        yield [(r["item_id"], r["words"]) for r in items.where(F.col("part") == k).collect()]


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with their own columns. Rows without an id share their verdict."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.withColumn("_key", key).join(bad, F.col("_key") == F.col("_leaked"), "left_anti").select(*docs.columns)


def op4_decontam(spark, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(id_back(), "item_id", "first", "last", F.round("cosine", 4).alias("cosine"), F.round("share", 4).alias("share"), "answer")
