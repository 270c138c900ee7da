"""Phrase collocation mining on a weighted de Bruijn graph.

Edges are the runs of ``longest`` words within a piece, weighted by their occurrences; an edge leads from the node of its first
``longest - 1`` words to that of its last ones. Only edges are counted in the text, and the ends of pieces, which are all that the edges do
not show: the last words of a piece (one, two, ... up to ``longest - 1``) begin no longer run. The count of a shorter
phrase is the flow through its node, the weights of the edges (or longer nodes) that begin with it plus the pieces that end with it.

1. A task makes the graph of a few megabytes of text with numpy: equal edges are added up, and the flows of nodes and words follow from
   them and from the ends. Sums of such graphs are the graph of the corpus, so what is dealt out is an entry per phrase and graph.
2. Entries are dealt to buckets by a hash of the whole phrase, so a hot language, word or node spreads over all buckets; they travel
   compressed, many to a row. A bucket compares the phrases themselves, not their hashes, and keeps words and frequent phrases.
3. Unary paths of frequent edges are compacted by pointer doubling: where a node has as much flow as the edge before and the edge behind it, no other edge
   and no piece begins or ends there, and the edges are one path with one weight. A cycle cannot be unary, as the pieces in it end somewhere.
   Inner nodes have the weight of their path. They never stand alone as a phrase, as a longer one has all their occurrences.
4. Candidates are cut, the parts looked up in the counts, and the lowest score taken, in exact decimal arithmetic.

Memory: a task holds the graph of ``CHUNK`` bytes of text, a bucket the entries of about ``PER_BUCKET`` bytes of input, a path is at most as
long as one piece. The first rows of a language are chosen within many hashed parts first, then among these.

Null texts are empty and give nothing; null languages are ``und``, also together with rows that say ``und``. Repeated rows count each time. Texts of
any length are read whole, cut between pieces. Ties are ordered to the end: score, count, then the phrase by its bytes.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import MB, UNKNOWN, at_hand, buckets_for, input_bytes, mixed, stored, table

CHUNK, PER_BUCKET = 6 * MB, 4 * MB
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
KIND[[0x20, 0x09]] = 1
KIND[np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)] = 2
_BORDER = re.compile(rb"[.,;:!?\x0a-\x0d]")


def words_of(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a text in order, and the number of the piece of each."""
    raw = np.frombuffer(data, np.uint8)
    kind = KIND[raw]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    start, end = edge[::2], edge[1::2]
    place = np.r_[0, np.cumsum(end - start)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(place), pa.py_buffer(LOWER[raw[inside]])])
    return words, np.cumsum(kind == 2)[start]


def graph(data: bytes, longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Of a text, from edges to words: the number of words, the phrases, how often they occur, and a hash of each."""
    words, piece = words_of(data)
    n = len(words)
    if n == 0:
        return
    coded = words.dictionary_encode()
    word, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()], np.uint64)
    closing = np.r_[piece[1:] != piece[:-1], True]
    # node[m]: by place, the node of the m words that start there; first[m]: a place of each node; ends[m]: pieces that end with it
    node, first, ends, place = [np.zeros(n, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], np.arange(n)
    for m in range(1, longest + 1):
        place = place[~closing[place + m - 2]] if m > 1 else place
        found, at, ids = np.unique(node[-1][place] * len(names) + word[place + m - 1], return_index=True, return_inverse=True)
        node.append(np.zeros(n, np.int64))
        node[m][place] = ids
        first.append(place[at])
        last = closing[place + m - 1]
        ends.append(np.bincount(ids[last], minlength=len(found)))
    count = np.bincount(node[longest][place], minlength=len(first[longest])) if len(place) else np.zeros(0, np.int64)
    for m in range(longest, 0, -1):
        at = first[m]
        if len(at):
            h = np.zeros(len(at), np.uint64)
            for i in range(m):
                h = mixed(h + hashes[word[at + i]])
            yield m, pc.binary_join_element_wise(*(names.take(pa.array(word[at + i])) for i in range(m)), pa.scalar(b" ", pa.large_binary())), count, h
        flow = ends[m - 1].copy()
        np.add.at(flow, node[m - 1][at], count)
        count = flow


def _blocks(phrases: pa.Array, counts: np.ndarray, cuts: list[int]) -> list[bytes]:
    """Phrases and counts between the cuts as compressed blocks: lengths and counts byte by byte of all, then the text."""
    pack, place = zstandard.ZstdCompressor(1), np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
    text, size, counts = memoryview(phrases.buffers()[2]), np.diff(place).astype("<i4"), counts.astype("<i8")
    return [
        pack.compress(b"".join([(b - a).to_bytes(8, "little"), *(x[a:b].view(np.uint8).reshape(b - a, -1).T.tobytes() for x in (size, counts)), text[place[a] : place[b]]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def _unpack(block: bytes) -> tuple[pa.Array, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(data, np.uint8)
    size = np.ascontiguousarray(raw[8 : 8 + 4 * n].reshape(4, n).T).view("<i4").reshape(-1)
    counts = np.ascontiguousarray(raw[8 + 4 * n : 8 + 12 * n].reshape(8, n).T).view("<i8").reshape(-1)
    place = np.r_[0, np.cumsum(size, dtype=np.int64)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(place), pa.py_buffer(data[8 + 12 * n :])]), counts


def _texts(texts: pa.Array, rows: np.ndarray) -> Iterator[bytes]:
    """Texts put together to about CHUNK bytes, with a border between them; longer ones are cut at a border of pieces."""
    group, total = [], 0
    for row in rows.tolist():
        text, at = texts[row].as_py(), 0
        while True:
            found = _BORDER.search(text, at + CHUNK) if len(text) - at > CHUNK else None
            cut = found.start() if found else len(text)
            group.append(text[at:cut])
            total += cut - at
            if total >= CHUNK:
                yield b"\n".join(group)
                group, total = [], 0
            at = cut
            if not found:
                break
    if group:
        yield b"\n".join(group)


COUNTS = {"lang": pa.string(), "phrase": pa.string(), "words": pa.int32(), "n": pa.int64()}


def counts(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """lang, phrase, words (their number) and n, the occurrences: all words, and phrases of 2 to ``longest`` words with ``least`` or more."""
    at_hand(docs.sparkSession)
    bits = int(np.log2(buckets_for(docs, PER_BUCKET, 8))) if input_bytes(docs) < UNKNOWN else 10

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                for data in _texts(batch.column("text"), np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == code)):
                    for words, phrases, n, h in graph(data, longest):
                        bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
                        order = np.argsort(bucket, kind="stable")
                        phrases, n, bucket = phrases.take(pa.array(order)), n[order], bucket[order]
                        cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)].tolist()
                        blocks = _blocks(phrases, n, cuts)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(bucket[cuts[:-1]]), pa.array([lang] * len(blocks), pa.string()), pa.array([words] * len(blocks), pa.int32()), pa.array(blocks, pa.binary()),
                        ], ["bucket", "lang", "words", "block"])

    def added(rows: pa.Table) -> pa.Table:
        kinds: dict[tuple, list] = {}
        for lang, words, block in zip(*(rows.column(c).to_pylist() for c in ("lang", "words", "block")), strict=True):
            kinds.setdefault((lang, words), []).append(_unpack(block))
        out = []
        for (lang, words), parts in kinds.items():
            coded = pa.concat_arrays([p for p, _ in parts]).dictionary_encode()
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, coded.indices.to_numpy(zero_copy_only=False), np.concatenate([n for _, n in parts]))
            keep = np.flatnonzero((total >= least) | (words == 1))
            phrase = coded.dictionary.take(pa.array(keep)).cast(pa.binary()).cast(pa.string())
            out.append(pa.Table.from_arrays([pa.array([lang] * len(keep), pa.string()), phrase, pa.array([words] * len(keep), pa.int32()), pa.array(total[keep])], list(COUNTS)))
        return pa.concat_tables(out)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    blocks = texts.mapInArrow(dealt, "bucket long, lang string, words int, block binary")
    return stored(blocks.groupBy("bucket").applyInArrow(added, "lang string, phrase string, words int, n long"), "phrase-counts")


def _first(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def paths(found: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, words and n of the unary paths of ``counts``, single edges included: the longest repeated phrases without a branch."""
    edges = found.where(F.col("words") == longest).select("lang", F.col("phrase").alias("edge"), _first("phrase", longest - 1).alias("head"), F.substring_index("phrase", " ", -(longest - 1)).alias("tail"), "n")
    nodes = found.where(F.col("words") == longest - 1).select("lang", F.col("phrase").alias("tail"), "n")
    before = edges.select("lang", F.col("edge").alias("before"), "tail", "n").join(nodes, ["lang", "tail", "n"])  # all the flow of the node comes by one edge ...
    before = before.withColumnRenamed("tail", "head")
    linked = stored(edges.join(before, ["lang", "head", "n"], "left").select("lang", "edge", "n", "before"), "phrase-edges")  # ... and leaves by one
    chain = linked.select("lang", "edge", "n", F.coalesce("before", "edge").alias("origin"), F.col("before").isNotNull().cast("long").alias("steps"))
    while True:
        known = chain.select("lang", F.col("edge").alias("origin"), F.col("origin").alias("further"), F.col("steps").alias("more")).where("more > 0")
        chain = stored(chain.join(known, ["lang", "origin"], "left").select("lang", "edge", "n", F.coalesce("further", "origin").alias("origin"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("more").isNotNull().alias("moved")), "phrase-paths")
        if chain.where("moved").isEmpty():
            break
    last = F.struct("steps", F.substring_index("edge", " ", -1).alias("word"))
    one = chain.where("steps > 0").groupBy("lang", "origin", "n").agg(F.array_sort(F.collect_list(last)).alias("rest"))
    long = one.select("lang", F.concat_ws(" ", "origin", F.col("rest.word")).alias("phrase"), (F.size("rest") + longest).alias("words"), "n")
    heads = chain.where("steps = 0").select("lang", F.col("edge").alias("phrase"), "n").join(one.select("lang", F.col("origin").alias("phrase")), ["lang", "phrase"], "left_anti")
    return stored(long.unionByName(heads.select("lang", "phrase", F.lit(longest).alias("words"), "n")), "phrase-unary")


def _windows(words: int, trim: int = 0) -> Column:
    """The runs of so many words in the array ``w``, without the first and the last ``trim``."""
    return F.expr(f"transform(sequence(1 + {trim}, size(w) - {words - 1 + trim}), i -> concat_ws(' ', slice(w, i, {words})))")


def candidates(found: DataFrame, unary: DataFrame, longest: int, least: int, share: int) -> DataFrame:
    """lang, phrase, words, n of the phrases that no longer candidate has in ``share`` per cent of their occurrences."""
    w = unary.withColumn("w", F.split("phrase", " ", -1))
    edges = w.select("lang", F.explode(_windows(longest)).alias("phrase"), "n").withColumn("words", F.lit(longest))
    inner = w.where(F.size("w") > longest).select("lang", F.explode(_windows(longest - 1, 1)).alias("phrase"))  # as frequent as the edges around them
    shorter = found.where((F.col("words") > 1) & (F.col("words") < longest) & (F.col("n") >= least)).select("lang", "phrase", "words", "n")
    edges = edges.select("lang", "phrase", "words", "n")
    every = edges.unionByName(shorter)
    sub = [every.where(F.col("words") > m).select("lang", "n", F.explode(F.expr(f"transform(sequence(1, words - {m - 1}), i -> concat_ws(' ', slice(split(phrase, ' ', -1), i, {m})))")).alias("phrase")) for m in range(2, longest)]
    kept = shorter.join(inner, ["lang", "phrase"], "left_anti") if longest > 2 and share <= 100 else shorter
    if sub:
        around = reduce(DataFrame.unionByName, sub).groupBy("lang", "phrase").agg(F.max("n").alias("around"))
        kept = kept.join(around, ["lang", "phrase"], "left").where("around IS NULL OR 100 * CAST(around AS DECIMAL(20)) < " + f"{share} * CAST(n AS DECIMAL(20))").drop("around")
    return kept.unionByName(edges)


def score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)) of three columns, exact for counts below 10**16."""
    a, l, r = (f"CAST({x} AS DECIMAL(18))" for x in (a, l, r))  # noqa: E741
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7)) * ({a} * {a})) DIV ({l} * {r}) AS BIGINT)")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` collocations of each language."""
    found = counts(docs, longest, least)
    chosen = candidates(found, paths(found, longest), longest, least, share)
    cut = chosen.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "words")
    cut = cut.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    known = found.where(F.col("n") >= least)
    cut = cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    best = F.min(F.struct(score("a", "l", "r").alias("score"), "k", "l", "r"))
    scored = cut.groupBy("lang", "phrase", "a").agg(best.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("part"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    few = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = found.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    return few.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


# The same rows by plain counting.
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(w) AS phrase, 1 AS words FROM words
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM words
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM words
), f AS (SELECT lang, phrase, words, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, phrase, words, a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10),
around AS (
  SELECT lang, phrase, max(a) AS b FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE words = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE words = 3
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN around USING (lang, phrase) WHERE words = 3 OR b IS NULL OR 100 * b < 50 * c.a
), cuts AS (
  SELECT lang, phrase, a, w[1] AS x, array_to_string(w[2:], ' ') AS y, 1 AS k FROM kept
  UNION ALL SELECT lang, phrase, a, w[1] || ' ' || w[2], w[3], 2 FROM kept WHERE words = 3
), scored AS (
  SELECT lang, cuts.phrase, cuts.a, p.a AS l, q.a AS r, k,
    CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(p.a AS HUGEINT) * q.a) AS BIGINT) AS score
  FROM cuts JOIN f p USING (lang) JOIN f q USING (lang) WHERE p.phrase = x AND q.phrase = y
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN total USING (lang) QUALIFY rank <= 2000
"""
