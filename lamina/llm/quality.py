"""Text quality by compression: zstandard dictionaries of good and of bad text, and a calibrated score.

A text is cut into short pieces, and each is compressed with the dictionary of either class. The difference of the two
sizes over the raw size says which class it resembles. Short pieces matter: a long one soon becomes its own dictionary.
A logistic curve over the difference (of the whole text, and of the pieces at either end), fitted on labelled rows that the
dictionaries have not seen, gives the score.

Dictionaries and curve are fitted on a bounded sample of labelled rows (``sample_rows`` per class and use); scoring
reads every text whole. Null and empty texts have no bytes to compare: they get the score of ``EMPTY_SCORE``. Rows with
null ids can be scored but are never learned from. Repeated rows are scored alike. With fewer than two labelled rows of
either class (one for the dictionary, one for the curve) nothing can be learned: every score is the share of label 1 (or 0.5 without
any labels), and ``keep_good`` keeps all documents. Very long texts are scored piece by piece. A column called ``score`` is
replaced by ``score`` and left alone by ``keep_good``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import at_hand, held_out, table

PIECE, EMPTY_SCORE = 384, 0.0


@dataclass
class Model:
    good: bytes
    bad: bytes
    center: list[float]
    scale: list[float]
    weights: list[float]  # of the features, the intercept last
    constant: float | None = None  # score of every text if there was nothing to learn


class Sizes:
    """Compressed sizes of pieces with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=3, dict_data=self._dict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (good, bad)]

    @staticmethod
    def _dict(data: bytes) -> zstandard.ZstdCompressionDict:
        made = zstandard.ZstdCompressionDict(data)
        made.precompute_compress(level=3)
        return made

    def features(self, text: bytes) -> list[float]:
        """The normalised difference of the whole text, and the least and the greatest of its pieces."""
        view = memoryview(text)
        good, bad = self.by
        raw, g, b = [], [], []
        for at in range(0, len(text), PIECE):
            piece = view[at : at + PIECE]
            raw.append(len(piece))
            g.append(len(good.compress(piece)))
            b.append(len(bad.compress(piece)))
        raw, g, b = (np.array(x, float) for x in (raw, g, b))
        each = (b - g) / raw
        weight = raw / raw.sum()
        long = raw >= PIECE / 2
        ends = each[long] if long.any() else each
        return [float((each * weight).sum()), float(ends.min()), float(ends.max())]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    keep = np.r_[np.full(x.shape[1] - 1, ridge * len(y) ** 0.5), 1e-6]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _expand(x: np.ndarray) -> np.ndarray:
    """The features with their squares."""
    return np.c_[x, x**2]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 600, sample_bytes: int = 16_384, dict_bytes: int = 65_536) -> Model:
    """Learn from labelled rows that are not held out.

    Of each class the rows with the smallest hashes of their ids are taken: ``sample_rows`` for the dictionaries and as
    many for the curve; of a text for the dictionaries at most ``sample_bytes`` count, in pieces spread over the whole text.
    """
    rows = (
        docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0) & ~held_out()).select("doc_id")
        .join(labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("_quality")), "doc_id")
    )
    taken = {
        r["doc_id"]: quality for quality in (1, 0)
        for r in rows.where(F.col("_quality") == quality).orderBy(F.xxhash64(F.col("doc_id"), F.lit(9)), "doc_id").limit(2 * sample_rows).collect()
    }
    texts = docs.where(F.col("doc_id").isin(list(taken)) & (F.length("text") > 0)).groupBy("doc_id").agg(F.max(F.col("text").cast("binary")).alias("_text")).collect() if taken else []
    texts = {r["doc_id"]: bytes(r["_text"]) for r in texts}
    found = [(quality, texts[doc]) for doc, quality in taken.items()]
    shares = rows.groupBy("_quality").count().collect()
    total, good = sum(r["count"] for r in shares), sum(r["count"] for r in shares if r["_quality"] == 1)
    by = {q: [t for k, t in found if k == q] for q in (0, 1)}
    if min(map(len, by.values())) < 2:
        return Model(b"", b"", [], [], [], good / total if total else 0.5)
    dicts = {}
    for q, texts in by.items():
        pieces = [t[at : at + PIECE] for t in texts[::2] for at in range(0, len(t), PIECE * max(1, -(-len(t) // sample_bytes)))]
        try:
            dicts[q] = zstandard.train_dictionary(dict_bytes, pieces, level=3).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself serves
            dicts[q] = b"".join(pieces)[-dict_bytes:]
    sizes = Sizes(dicts[1], dicts[0])
    x = _expand(np.array([sizes.features(t) for q in (1, 0) for t in by[q][1::2]]))
    y = np.array([q for q in (1, 0) for _ in by[q][1::2]], float)
    center, scale = x.mean(0), x.std(0) + 1e-9
    w = _logistic((x - center) / scale, y)
    taken = y.mean()  # the classes were taken alike; the intercept goes back to their true shares
    w[-1] += np.log(good / (total - good)) - np.log(taken / (1 - taken))
    return Model(dicts[1], dicts[0], center.tolist(), scale.tolist(), w.tolist())


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the calibrated score of each whole text as a last column (replacing one of that name)."""
    at_hand(docs.sparkSession)
    docs = docs.drop(name) if name in docs.columns else docs
    if model.constant is not None:
        return docs.withColumn(name, F.lit(float(model.constant)))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = Sizes(model.good, model.bad)
        center, scale, w = np.array(model.center), np.array(model.scale), np.array(model.weights)
        for texts in batches:
            out = np.full(len(texts), EMPTY_SCORE)
            for i, t in enumerate(texts):
                if t:
                    x = (_expand(np.array([sizes.features(t)])) - center) / scale
                    out[i] = 1 / (1 + np.exp(-np.clip(x[0] @ w[:-1] + w[-1], -30, 30)))
            yield pd.Series(out)

    return docs.withColumn(name, scored(F.col(text).cast("binary")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns; all of them if nothing could be learned."""
    model = fit(docs, labels)
    if model.constant is not None:
        return docs
    scored = score(docs, model, name="_score")
    return scored.where(F.col("_score") >= threshold).select(*docs.columns)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
