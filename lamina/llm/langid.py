"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased, everything but letters becomes one space, and the counts of all four-letter sequences of all
training texts are summed in Spark, first per task. From them come the discounts, continuation counts and back-off
weights of the interpolated model, for all languages at once: a sorted array of the keys (four UTF-16 units, so exact; a letter
beyond the basic plane is two units) of all sequences, and beside it their log-probabilities in each language. A text is looked up
once by binary search; sequences that no language knows back off to sorted arrays of three, two and one letters.

The language of lowest cross-entropy per letter wins. Its score is a softmax over minus the cross-entropies, whose
temperature is fitted on a bounded sample of labelled texts that the counts leave out (``held_rows``). ``rejected`` marks
texts that none of the models fits: their score is below ``reject`` or their cross-entropy above nearly all of the sample.

The model is built on the driver from all counts and broadcast, with a number per sequence and language: it grows with the letters
and languages of the input, and no sequence is left out.
Texts that are null or have no letter are ``und`` with score 0, as is everything if no row has a language.
Training ignores rows with a null id, language or text; repeated rows count each time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, at_hand, chunks, held_out, stored, table

ORDER, SPACE_UNIT = 4, 32
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))
    return _letters[0]


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of the normalised texts, each after a space, and the place where each text starts."""
    points = [np.frombuffer((" " + t.lower()).encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    start = np.cumsum([0, *map(len, points)])[:-1] if points else np.empty(0, np.int64)
    c = np.concatenate(points) if points else np.empty(0, np.uint32)
    word = letters()[c]
    word[start] = False
    first = np.zeros(len(c), bool)
    first[start] = True
    keep = word | first | np.r_[True, word[:-1]]  # a run of others leaves one space, and each text keeps its first
    place = np.cumsum(keep) - keep
    units, place = np.where(word, c, SPACE_UNIT)[keep], place[start]
    wide = units > 0xFFFF
    if wide.any():
        place = place + (np.cumsum(wide) - wide)[place]
        low = 0xDC00 + (units[wide] & 0x3FF)
        units = np.insert(np.where(wide, 0xD7C0 + (units >> 10), units), np.flatnonzero(wide) + 1, low)
    return units.astype(np.uint16), place


def grams(u: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of the sequence that ends at each unit that is not a text's first, and the text of each.

    Before a text stand spaces.
    """
    text = np.zeros(len(u), np.int64)
    text[start] = 1
    text = np.cumsum(text) - 1
    key, at = u.astype(np.uint64), np.arange(len(u))
    for k in range(1, ORDER):
        before = np.where(at - k >= start[text], np.roll(u, k), SPACE_UNIT) if len(u) else u
        key |= before.astype(np.uint64) << np.uint64(16 * k)
    inner = at != start[text] if len(u) else np.empty(0, bool)
    return key[inner], text[inner]


@dataclass
class Model:
    """For n = 4 down to 1: sorted keys, log-probabilities by language, and of their contexts keys and log back-off weights."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    unseen: np.ndarray
    temperature: float = 1.0
    worst: float = np.inf


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 0:
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def build(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model from the keys and counts of each language."""
    top = [np.unique(np.concatenate([k for k, _ in counts]))]
    mask = [np.uint64(2 ** (16 * n) - 1) if n < 4 else np.uint64(2**64 - 1) for n in range(5)]
    for n in range(ORDER - 1, 0, -1):
        top.append(np.unique(top[-1] & mask[n]))
    model = Model(langs, top, [np.zeros((len(k), len(langs)), np.float64) for k in top], [], [], np.zeros(len(langs)))
    for _ in range(ORDER):
        model.contexts.append(np.empty(0, np.uint64))
        model.weights.append(np.empty((0, len(langs))))
    levels = []  # of each language: keys and (continuation) counts, from four to one
    for keys, n in counts:
        level = [(keys, n.astype(np.float64))]
        for m in range(ORDER - 1, 0, -1):
            short, times = np.unique(level[-1][0] & mask[m], return_counts=True)
            level.append((short, times.astype(np.float64)))
        levels.append(level)
    for i in range(ORDER):
        model.contexts[i] = np.unique(top[i] >> np.uint64(16))
        model.weights[i] = np.zeros((len(model.contexts[i]), len(langs)))
    size = max(2, len(top[-1]))
    for x, level in enumerate(levels):
        lower = None
        for i in range(ORDER - 1, -1, -1):
            keys, n = level[i]
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))
            context, inverse, kinds = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
            total = np.bincount(inverse, n, len(context)) if len(keys) else np.empty(0)
            weight = np.zeros(len(model.contexts[i]))  # contexts that this language has not seen back off for free
            at, _ = _place(model.contexts[i], context)
            weight[at] = np.log(discount * kinds / total)
            model.weights[i][:, x] = weight
            own = np.zeros(len(top[i]))
            at, _ = _place(top[i], keys)
            own[at] = (n - discount) / total[inverse]
            if lower is None:
                below = np.full(len(top[i]), 1 / size)
                model.unseen[x] = -np.log(size)
            else:
                at, _ = _place(top[i + 1], top[i] & mask[ORDER - 1 - i])
                below = np.exp(lower[at])
            at, _ = _place(model.contexts[i], top[i] >> np.uint64(16))
            lower = np.log(np.maximum(own + np.exp(weight[at]) * below, 1e-300))
            model.logp[i][:, x] = lower
    model.logp = [a.astype(np.float32) for a in model.logp]
    model.weights = [a.astype(np.float32) for a in model.weights]
    return model


def log_probabilities(model: Model, keys: np.ndarray) -> np.ndarray:
    """Of each sequence in each language; what is not in an array backs off to the next."""
    at, hit = _place(model.keys[0], keys)
    out = model.logp[0][at] if len(model.keys[0]) else np.zeros((len(keys), len(model.langs)), np.float32)
    miss = np.flatnonzero(~hit)
    if len(miss):
        out[miss] = 0
    for i in range(1, ORDER + 1):
        if len(miss) == 0:
            break
        n = ORDER + 1 - i  # units of the level that did not know them
        short = keys[miss] & np.uint64(2 ** (16 * n) - 1) if n < 4 else keys[miss]
        at, found = _place(model.contexts[i - 1], short >> np.uint64(16))
        out[miss[found]] += model.weights[i - 1][at[found]]
        if i == ORDER:
            out[miss] += model.unseen.astype(np.float32)
            break
        at, found = _place(model.keys[i], short & np.uint64(2 ** (16 * (n - 1)) - 1))
        out[miss[found]] += model.logp[i][at[found]]
        miss = miss[~found]
    return out


def entropies(model: Model, texts: list[str]) -> np.ndarray:
    """Cross-entropy per unit of each text in each language; NaN for texts without a letter."""
    out = np.full((len(texts), len(model.langs)), np.nan)
    for a, b in chunks([len(t) for t in texts], MB):
        u, start = units(texts[a:b])
        keys, text = grams(u, start)
        if len(keys) == 0:
            continue
        has, first, n = np.unique(text, return_index=True, return_counts=True)
        sums = np.add.reduceat(log_probabilities(model, keys), first, axis=0, dtype=np.float64)
        letter = np.add.reduceat((keys & np.uint64(0xFFFF)) != SPACE_UNIT, first, dtype=np.int64) > 0
        out[a + has[letter]] = -(sums / n[:, None])[letter]
    return out


def _softmax(entropy: np.ndarray, temperature: float) -> np.ndarray:
    e = np.exp(-(entropy - entropy.min(1, keepdims=True)) * temperature)
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, held_rows: int = 2000) -> Model | None:
    """Counts from all rows with a language that are not held out, but for a bounded sample that fits the temperature."""
    spark = at_hand(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    total = rows.count()
    order = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1_000_000))
    share = 1_000_000 * min(0.1, held_rows / max(1, total))
    sample = rows.where(order < share).select("lang", "text").limit(2 * held_rows).collect()

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, list] = {}

        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        for batch in batches:
            for lang, part in batch.groupby("lang"):
                texts = part["text"].tolist()
                for a, b in chunks([len(t) for t in texts], 2 * MB):
                    keys = np.sort(grams(*units(texts[a:b]))[0])
                    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
                    parts = found.setdefault(lang, [])
                    parts.append((keys[new], np.diff(np.r_[new, len(keys)])))
                    if sum(len(k) for k, _ in parts) > 3_000_000:
                        parts[:] = [summed(parts)]
        for lang, parts in found.items():
            keys, n = summed(parts)
            for at in range(0, len(keys), 50_000):
                yield pd.DataFrame({"lang": lang, "key": keys[at : at + 50_000].view(np.int64), "n": n[at : at + 50_000]})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                yield pd.DataFrame([{"lang": lang, "keys": part["key"].to_numpy(np.int64).tobytes(), "counts": part["n"].to_numpy(np.int64).tobytes()}])

    sums = rows.where(order >= share).select("lang", "text").mapInPandas(counted, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    parts = stored(sums, "grams").mapInPandas(packed, "lang string, keys binary, counts binary").collect()
    langs = sorted({r["lang"] for r in parts})
    if not langs:
        return None
    counts = []
    for lang in langs:
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in parts if r["lang"] == lang])
        n = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in parts if r["lang"] == lang])
        by = np.argsort(keys)
        counts.append((keys[by], n[by]))
    model = build(langs, counts)
    found = [(langs.index(r["lang"]), r["text"]) for r in sample if r["lang"] in langs]
    e = entropies(model, [t for _, t in found])
    known = ~np.isnan(e[:, 0]) if len(found) else np.empty(0, bool)
    if known.any():
        right, e = np.array([k for k, _ in found])[known], e[known]
        tries = np.geomspace(0.1, 100, 61)
        likely = [np.log(np.maximum(_softmax(e, t)[np.arange(len(e)), right], 1e-12)).mean() for t in tries]
        model.temperature = float(tries[int(np.argmax(likely))])
        model.worst = float(np.quantile(e.min(1), 0.999)) + 0.5
    return model


def identify(docs: DataFrame, model: Model | None, reject: float = 0.5) -> DataFrame:
    """``docs`` with lang_pred, score, entropy and rejected."""
    spark = at_hand(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "entropy", "rejected")
    if model is None:
        return docs.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"))
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, entropy double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            e = entropies(m, ["" if t is None else t for t in texts])
            known = ~np.isnan(e[:, 0]) if len(e) else np.empty(0, bool)
            safe = np.where(known[:, None], e, 0.0)
            best = safe.argmin(1)
            score = np.where(known, _softmax(safe, m.temperature)[np.arange(len(e)), best], 0.0)
            least = np.where(known, safe.min(1), np.nan)
            yield pd.DataFrame({
                "lang_pred": np.where(known, np.array(m.langs, object)[best], "und"), "score": score,
                "entropy": pd.Series(least).astype(object).where(known, None), "rejected": ~known | (score < reject) | (least > m.worst),
            })

    return docs.withColumn("_found", predicted("text")).select("*", "_found.*").drop("_found")


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")
