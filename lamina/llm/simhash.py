"""Near-duplicates by SimHash fingerprints, linked exactly through vantage-point trees.

Fingerprints of whole texts are reduced to the distinct ones, so copies cost nothing further. Of radius + c blocks of bits, two
fingerprints within the radius agree in c at least (``block_masks``). So for each choice of c blocks a vantage-point tree over a bounded
sample cuts the space of these bits into shards by Hamming distance. In it the search radius is 0, so that no fingerprint has to be a guest
beyond a boundary, and each goes to one shard per choice: what is shuffled grows like the input. The trees' nodes
(a value and a radius each) are all that is sent along with the tasks. Within a shard, fingerprints that agree in the blocks meet; a second
vantage-point tree over all their bits prunes by triangle bounds until few candidates are left, which are compared exactly. A shard sends on
a spanning forest of its links, never all pairs: a ball of n mutual neighbours costs n - 1 links. Links of all shards are
joined into components by star contraction in Spark, each round written to the shared folder.

``keep_one`` also links documents whose sets of shingles have a Jaccard similarity of 4/5 or more (``similar_sets``), since
most of them differ in more bits than can be searched.

Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id take part, and their
component has the smallest id that is not null (null if there is none). Repeated rows and ties are copies. Very long texts are hashed
whole, in parts. Other columns, whatever their names, are not looked at and are returned by ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, NO_ID, at_hand, chunks, id_back, keyed, mixed, stored, table, unstore, window_hashes, word_hashes

SAMPLE = 8192  # fingerprints that the tree of shards is fitted on
SAMPLED, COMMON = 20_000, 200_000  # texts that show which shingles are common, and how many of these are told apart
PLACED = 1 << 20  # entries of prefixes that meet in one bucket, on average
PLACE = 1000  # sets that meet the set of one key in one place
DEEPEST = 9  # levels of a tree of shards; further shards are told apart by a hash of the blocks
SMALL = 64  # fingerprints with blocks in common that are compared without a tree
_LEAF = 1 << 15  # pairs that are compared without a further vantage point


# ---------------------------------------------------------------- fingerprints

def text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash of a text, over shingles of ``size`` lower-cased words, repeats included."""
    words = text.lower().split()  # of bytes: lowers A-Z only, splits at the six white-space bytes
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    total, counts = 0, np.zeros(64, np.int64)
    h = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    for at in range(0, len(h), 65_536):
        part = h[at : at + 65_536]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id (null: the last key), a hash of the text, and fp, the fingerprint as a signed long."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            fp = np.array([fingerprint(t, size) for t in rows["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "text_hash": rows["text_hash"], "fp": fp})

    return keyed(docs, text_hash().alias("text_hash")).mapInPandas(made, "doc_id long, text_hash long, fp long")


# ---------------------------------------------------------------- a tree of shards

def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def plant(sample: np.ndarray, depth: int, seed: int = 1) -> list[tuple[int, int]]:
    """A complete tree of ``depth`` levels, as (vantage point, radius) in heap order; the radius is the median distance."""
    rng = np.random.default_rng(seed)
    nodes, level = [], [sample]
    for _ in range(depth):
        below = []
        for points in level:
            if len(points) == 0:
                nodes.append((0, 32))
                below += [points, points]
                continue
            vantage = points[rng.integers(len(points))]
            d = _distance(points, vantage)
            radius = int(np.median(d))
            nodes.append((int(vantage), radius))
            below += [points[d <= radius], points[d > radius]]
        level = below
    return nodes


def route(fp: np.ndarray, nodes: list[tuple[int, int]], depth: int, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, is home) of each place a fingerprint goes to.

    At a node a fingerprint at home goes to its own side, and one from outside the radius also as a guest to the
    inside if a neighbour may be there. Guests go wherever a neighbour may be.
    """
    row, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
    vantage, radius = np.array([n[0] for n in nodes] or [0], np.uint64), np.array([n[1] for n in nodes] or [0], np.int64)
    for _ in range(depth):
        d = _distance(fp[row], vantage[node]).astype(np.int64)
        inside, near_in, near_out = d <= radius[node], d - r <= radius[node], d + r > radius[node]
        to_in = np.where(home, inside, near_in)
        to_out = np.where(home, ~inside, near_out)
        guest = home & ~inside & near_in
        row = np.concatenate([row[to_in], row[to_out], row[guest]])
        new = np.concatenate([2 * node[to_in] + 1, 2 * node[to_out] + 2, 2 * node[guest] + 1])
        home = np.concatenate([home[to_in], home[to_out], np.zeros(guest.sum(), bool)])
        node = new
    return row, node - (2**depth - 1), home


# ---------------------------------------------------------------- links within a shard

class Forest:
    """Components over places 0..n-1, and the links that joined them."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))

    def one(self, places: np.ndarray) -> bool:
        """Whether all places are in one component."""
        root = self.find(int(places[0]))
        return all(self.find(int(p)) == root for p in places[1:])


def link(fp: np.ndarray, home: np.ndarray, r: int, seed: int = 1) -> list[tuple[int, int]]:
    """Links that join all places at ``r`` or fewer differing bits, of two homes or of a home and a guest."""
    rng, forest = np.random.default_rng(seed), Forest(len(fp))
    homes, guests = np.flatnonzero(home), np.flatnonzero(~home)
    todo = [(homes, None)]
    if len(guests):
        todo.append((homes, guests))
    while todo:
        a, b = todo.pop()
        if len(a) == 0 or (len(a) < 2 if b is None else len(b) == 0):
            continue
        if len(a) * (len(a) if b is None else len(b)) <= _LEAF:
            other = a if b is None else b
            i, j = np.nonzero(_distance(fp[a][:, None], fp[other][None, :]) <= r)
            x, y = a[i], other[j]
            if len(x) > 2 * (len(a) + len(other)):  # a dense ball: only pairs that are not joined yet
                root = {p: forest.find(p) for p in [*a.tolist(), *other.tolist()]}
                apart = np.array([root[p] for p in x.tolist()]) != np.array([root[p] for p in y.tolist()])
                x, y = x[apart], y[apart]
            for p, q in zip(x.tolist(), y.tolist(), strict=True):
                forest.join(p, q)
            continue
        places = a if b is None else np.concatenate([a, b])
        v = a[rng.integers(len(a))]
        da = _distance(fp[a], fp[v]).astype(np.int64)
        db = da if b is None else _distance(fp[b], fp[v]).astype(np.int64)
        far = int(max(da.max(), db.max()))
        for d, side in ((da, a),) if b is None else ((da, a), (db, b)):
            for x in side[d <= r].tolist():
                forest.join(x, int(v))
        if far <= r or (far <= 2 * r and forest.one(places)):  # all joined through the vantage point, or already
            continue
        radius = int(np.median(da))
        if da.min() == da.max():  # no cut by this point: halve and compare
            todo += _halves(a, b)
            continue
        if radius == da.max():
            radius -= 1
        ain, aout = da <= radius, da > radius
        if b is None:
            todo += [(a[ain], None), (a[aout], None), (a[ain & (da + r > radius)], a[aout & (da - r <= radius)])]
        else:
            todo += [(a[ain], b[db - r <= radius]), (a[aout], b[db + r > radius])]
    return forest.links


def _halves(a: np.ndarray, b: np.ndarray | None) -> list:
    h = len(a) // 2
    if b is None:
        return [(a[:h], None), (a[h:], None), (a[:h], a[h:])]
    if len(a) >= len(b):
        return [(a[:h], b), (a[h:], b)]
    h = len(b) // 2
    return [(a, b[:h]), (a, b[h:])]


def block_masks(n: int, radius: int) -> list[int]:
    """Choices of bits: two fingerprints at ``radius`` or fewer differing bits agree in all bits of one of them at least.

    ``radius`` bits spoil as many blocks at most, so of radius + c blocks c are the same. More blocks mean more choices and fewer
    fingerprints that agree by chance; the cheapest number for ``n`` fingerprints is taken.
    """
    def cost(c: int) -> float:
        return math.comb(radius + c, c) * (1 + n / 2 ** (64 * c / (radius + c)) / SMALL)

    c = min(range(1, max(1, min(6, 64 - radius)) + 1), key=cost)
    edges = [64 * i // (radius + c) for i in range(radius + c + 1)]
    blocks = [2**b - 2**a for a, b in itertools.pairwise(edges)]
    return [sum(some) for some in itertools.combinations(blocks, c)]


def link_agreeing(fp: np.ndarray, mask: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints at ``r`` or fewer differing bits that agree in the bits of the mask."""
    fp = fp[np.argsort(fp & np.uint64(mask), kind="stable")]
    same, forest, links = fp & np.uint64(mask), Forest(len(fp)), []
    first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
    size = np.diff(np.r_[first, len(fp)])
    small = np.repeat(size <= SMALL, size)
    for step in range(1, min(SMALL, int(size.max()))):
        near = small[step:] & (same[step:] == same[:-step]) & (_distance(fp[step:], fp[:-step]) <= r)
        for i in np.flatnonzero(near).tolist():
            forest.join(i, i + step)
    for at, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        links += [(at + a, at + b) for a, b in link(fp[at : at + n], np.ones(n, bool), r)]
    pairs = np.array(forest.links + links, np.int64).reshape(-1, 2)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node it is linked to, directly or not), for every node in an edge (a, b).

    Alternating large-star and small-star steps; each round is written to the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).where("b > k").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = large.join(least, F.col("a") == F.col("k")).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").where("a <> b").distinct()
        new = stored(small, "links")
        moved = new.join(edges, ["a", "b"], "left_anti").isEmpty() and edges.join(new, ["a", "b"], "left_anti").isEmpty()
        unstore(edges)
        edges = new
        if moved:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def fingerprint_classes(prints: DataFrame, radius: int = 4, shard_rows: int = 25_000) -> DataFrame:
    """fp, root: the component of each distinct fingerprint that is linked to another one."""
    at_hand(prints.sparkSession)
    distinct = stored(prints.select("fp").distinct(), "prints")
    n = distinct.count()
    masks, shards = block_masks(n, radius), max(1, -(-n // shard_rows))
    depth = min(DEEPEST, math.ceil(math.log2(shards)))
    parts = -(-shards // 2**depth)
    sample = np.array([r["fp"] for r in distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()], np.int64).view(np.uint64) if depth else np.empty(0, np.uint64)
    trees = [plant(sample & np.uint64(mask), depth) for mask in masks]

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            fp = rows["fp"].to_numpy(np.int64)
            for choice, (mask, nodes) in enumerate(zip(masks, trees, strict=True)):
                same = fp.view(np.uint64) & np.uint64(mask)
                row, shard, _ = route(same, nodes, depth, 0)
                shard = shard * parts + (mixed(same[row]) % np.uint64(parts)).astype(np.int64)
                yield pd.DataFrame({"choice": choice, "shard": shard, "fp": fp[row]})

    def linked(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = link_agreeing(rows["fp"].to_numpy(np.int64).view(np.uint64), masks[key[0]], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    placed = distinct.mapInPandas(routed, "choice int, shard long, fp long")
    classes = components(placed.groupBy("choice", "shard").applyInPandas(linked, "a long, b long"))
    unstore(distinct)
    return classes


def near_duplicates(docs: DataFrame, size: int = 5, radius: int = 4) -> DataFrame:
    """doc_id (null: the last key), text_hash, fp, root (a fingerprint that names the group) and component, its smallest id."""
    prints = stored(fingerprints(docs, size), "fingerprints")
    classes = fingerprint_classes(prints, radius)
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(classes, F.col("fp") == F.col("node"), "left")
    firsts = stored(firsts.select("fp", "first", F.coalesce("root", "fp").alias("root")), "firsts")
    least = firsts.groupBy("root").agg(F.min("first").alias("component"))
    return prints.join(firsts.join(least, "root").select("fp", "root", "component"), "fp")


# ---------------------------------------------------------------- documents of one similarity

def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The distinct hashes of the shingles of each text, as in ``fingerprint``: lower-cased, the whole of a shorter text."""
    words, row = word_hashes([t.lower() for t in texts])
    h = window_hashes(words, size)
    of = row[: len(h)]
    inside = of == row[size - 1 :][: len(h)]
    h, of = h[inside], of[inside]
    start, cuts = np.searchsorted(row, np.arange(len(texts) + 1)), np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        short = words[start[i] : start[i + 1]]
        out.append(np.unique(h[cuts[i] : cuts[i + 1]] if len(short) >= size or len(short) == 0 else window_hashes(short, len(short))))
    return out


def set_key(hashes: np.ndarray) -> int:
    """One 64-bit hash of a set of hashes."""
    return int(mixed(np.array([mixed(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64)).view(np.int64)[0])


def sketch(hashes: np.ndarray) -> bytes:
    """Two bits or more for each hash of a set: whether the number of hashes at a place is odd. Two sketches differ in no more bits than the sets in hashes."""
    bits = 64 << max(0, math.ceil(math.log2(max(1, len(hashes)) / 32)))
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """The bits in which two sketches differ, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(rows: pd.DataFrame, size: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray], list[int]]]:
    texts = rows["text"].tolist()
    for a, b in chunks(list(map(len, texts)), MB):
        sets = shingle_sets(texts[a:b], size)
        yield rows.iloc[a:b], sets, [set_key(x) for x in sets]


def _common(docs: DataFrame, size: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that a sample of different texts has more than once, at most COMMON, and how often."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, sets, _ in _sets(rows, size):
                yield pd.DataFrame({"h": np.concatenate(sets).view(np.int64)})

    some = docs.where(F.pmod(text_hash(), F.lit(1_000_000)) < int(1_000_000 * share)).dropDuplicates(["text"])
    rows = keyed(some).mapInPandas(found, "h long").groupBy("h").count().where("count > 1").orderBy(F.desc("count"), "h").limit(COMMON).collect()
    h, n = np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["count"] for r in rows], np.int64)
    by = np.argsort(h)
    return h[by], n[by]


def set_keys(docs: DataFrame, size: int = 5) -> DataFrame:
    """Of each row doc_id (null: the last key), text_hash, key, a hash of its set of shingles, n, the size of the set, and its sketch."""

    def printed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part, sets, keys in _sets(rows, size):
                yield pd.DataFrame({"doc_id": part["doc_id"], "text_hash": part["text_hash"], "key": keys, "n": list(map(len, sets)), "sketch": list(map(sketch, sets))})

    return stored(keyed(docs, text_hash().alias("text_hash")).mapInPandas(printed, "doc_id long, text_hash long, key long, n long, sketch binary"), "sets")


def bucket_bits(sets: DataFrame) -> int:
    """Of the hash of a shingle, the bits that name its bucket: PLACED entries of prefixes a bucket, by the sizes ``n`` of the sets.

    Spark's statistics would not do: of a join they are the product of its sides, which made millions of buckets.
    """
    entries = sets.agg(F.sum(F.expr("n - (4 * n + 4) div 5 + 1"))).first()[0] or 0
    return max(6, math.ceil(math.log2(max(1, entries / PLACED))))


def similar_sets(docs: DataFrame, prints: DataFrame, known: DataFrame, size: int = 5) -> DataFrame:
    """Links (a, b) of the keys in ``prints`` whose sets are similar; ``known`` links of keys need not be found again.

    All sets with a Jaccard similarity of 4/5 or more are joined by these links and the known ones, and no others are linked. Two such sets share one of the first
    n - ceil(4n/5) + 1 shingles of each, in any one order of all shingles (prefix filter). The order here is rare ones
    first, by a sample, so that lines that many documents have propose nothing unless most of the document is made of them.
    Of the sets with a shingle in their prefixes, first the one of the least key meets all others, so that near copies of one text propose
    few different pairs; then the sets meet that are not joined yet.
    Every proposed pair is settled by the whole sets.
    """
    at_hand(docs.sparkSession)
    least = prints.groupBy("key").agg(F.min(F.struct("doc_id", "text_hash", "n", "sketch")).alias("one"))
    least = stored(least.select("key", F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash"), "one.n", "one.sketch"), "least")
    bits = bucket_bits(least)
    texts = docs.select("doc_id", "text")
    docs = one_text(texts, least.select("key", "one_id", "one_hash"))
    common, often = _common(docs, size, min(1.0, SAMPLED / max(1, prints.count())))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, sets, keys in _sets(rows, size):
                h, key, n = [], [], []
                for k, x in dict(zip(keys, sets, strict=True)).items():
                    if len(x) == 0:
                        continue
                    prefix = len(x) - (4 * len(x) + 4) // 5 + 1
                    if len(common):
                        at = np.minimum(np.searchsorted(common, x), len(common) - 1)
                        x = x[np.argsort(np.where(common[at] == x, often[at], 0), kind="stable")]
                    h.append(x[:prefix])
                    key.append(np.full(prefix, k, np.int64))
                    n.append(np.full(prefix, len(x), np.int64))
                if not h:
                    continue
                h, key, n = map(np.concatenate, (h, key, n))
                bucket = (mixed(h) >> np.uint64(64 - bits)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                h, key, n, bucket = h[by], key[by], n[by], bucket[by]
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
                yield pd.DataFrame([
                    {"bucket": int(bucket[x]), "h": h[x:y].tobytes(), "key": key[x:y].tobytes(), "n": n[x:y].astype(np.int32).tobytes()}
                    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                ])

    def listed(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h, key, n = (np.frombuffer(b"".join(rows[c]), t) for c, t in (("h", np.int64), ("key", np.int64), ("n", np.int32)))
        by = np.lexsort((key, h))
        h, key, n = h[by], key[by], n[by]
        once = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
        h, key, n = h[once], key[once], n[once]
        new = np.r_[True, h[1:] != h[:-1]]
        group, first = np.cumsum(new) - 1, np.flatnonzero(new)
        many = np.bincount(group)[group]
        least, some = first[group], many > 1
        return pd.DataFrame({"h": h[some], "key": key[some], "n": n[some], "large": many[some] > 2, "pivot": key[least][some], "pivot_n": n[least][some]})

    entries = keyed(docs).mapInPandas(dealt, "bucket long, h binary, key binary, n binary").groupBy("bucket")
    lists = stored(entries.applyInPandas(listed, "h long, key long, n int, large boolean, pivot long, pivot_n int"), "lists")
    stars = lists.where("key <> pivot AND 5 * least(n, pivot_n) >= 4 * greatest(n, pivot_n)")
    links = _settled(texts, size, stars.select(F.col("pivot").alias("a"), F.col("key").alias("b")), least)
    classes = components(links.union(known))
    large = lists.where("large").join(classes, F.col("key") == F.col("node"), "left").select("h", "key", "n", F.coalesce("root", "key").alias("root"))
    large = stored(large, "lists")
    unstore(lists)
    apart = large.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("h")
    some = large.join(apart, "h", "left_semi")
    like = (5 * F.least("a.n", "b.n") >= 4 * F.greatest("a.n", "b.n")) & (F.col("a.h") == F.col("b.h"))
    pairs = some.alias("a").join(some.alias("b"), like & (F.col("a.root") < F.col("b.root")))
    links = links.union(_settled(texts, size, pairs.select(F.col("a.key").alias("a"), F.col("b.key").alias("b")), least))
    unstore(large, least)
    return links


def one_text(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs that stand for a set, with the columns of ``keys``: one_id and one_hash name the row."""
    return docs.join(keys, (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("one_id")) & (text_hash() == F.col("one_hash")))


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys that their sketches allow: of sets with a Jaccard similarity of 4/5 at most a ninth of all hashes are in one alone.

    This leaves out no similar pair, and spares most of the others the shuffle of whole sets.
    """

    def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            apart = np.array([sketch_distance(x, y) for x, y in zip(rows["x"], rows["y"], strict=True)], np.int64)
            yield rows[["a", "b"]][9 * apart <= rows["n"].to_numpy()]

    x, y = (sets.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "x", "y")
    return both.mapInPandas(allowed, "a long, b long")


def _settled(docs: DataFrame, size: int, pairs: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) of keys whose sets have a Jaccard similarity of 4/5 or more; ``docs`` has one text per key, or ``least`` says
    which of its rows stand for a key, and has their sketches (the texts are then shuffled once, to the keys that are wanted).

    One shuffle brings the set of each b to its a. The set of a comes first there and is held while those of the others pass by; an a with
    many others is dealt to several places.
    """
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs if least is None else possible(pairs, least), "pairs")
    places = pairs.groupBy("a").agg(F.expr(f"count(*) div {PLACE} + 1").alias("places"))
    others = pairs.join(places, "a").select(F.col("b").alias("key"), "a", F.expr("pmod(xxhash64(b), places)").alias("place"))
    centres = places.select(F.col("a").alias("key"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place"))
    wanted = stored(others.union(centres).groupBy("key").agg(F.collect_list(F.struct("a", "place")).alias("to")), "wanted")

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part, sets, _ in _sets(rows, size):
                yield pd.DataFrame({"key": part["key"], "to": part["to"], "hashes": [x.tobytes() for x in sets]})

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, np.empty(0, np.uint64)
        for rows in batches:
            found = []
            for a, key, place, hashes in zip(rows["a"].tolist(), rows["key"].tolist(), rows["place"].tolist(), rows["hashes"], strict=True):
                x = np.frombuffer(hashes, np.uint64)
                if a == key:
                    at, held = (a, place), x
                elif at == (a, place) and 9 * len(np.intersect1d(held, x, assume_unique=True)) >= 4 * (len(held) + len(x)):
                    found.append((a, key))
            yield pd.DataFrame({"a": np.array([a for a, _ in found], np.int64), "b": np.array([b for _, b in found], np.int64)})

    found = docs.join(wanted, "key") if least is None else one_text(docs, wanted.join(least.select("key", "one_id", "one_hash"), "key"))
    sets = keyed(found, "key", "to").mapInPandas(made, "key long, to array<struct<a: long, place: long>>, hashes binary")
    sets = sets.select("key", F.explode("to").alias("to"), "hashes").select("key", "to.a", "to.place", "hashes").repartition("a", "place")
    sets = sets.sortWithinPartitions("a", "place", F.col("key") != F.col("a"))
    similar = stored(sets.mapInPandas(compared, "a long, b long").distinct(), "similar")
    unstore(pairs, wanted)
    return similar


def keep_one(docs: DataFrame, size: int = 5, radius: int = 4) -> DataFrame:
    """One document of each group, the one with the smallest id (null ids last), with its own columns; of repeated rows, one.

    A group is what links join: all pairs with a Jaccard similarity of 4/5 or more, and pairs of fingerprints within ``radius``.
    """
    near = near_duplicates(docs, size, radius).select("text_hash", "root").distinct()
    prints = set_keys(docs, size)
    same = stored(prints.select("text_hash", "key").distinct().join(near, "text_hash").select("key", "root").distinct(), "same")
    links = same.join(same.groupBy("root").agg(F.min("key").alias("least")), "root").select(F.col("key").alias("a"), F.col("least").alias("b"))
    links = stored(links.where("a <> b"), "links")
    classes = components(links.union(similar_sets(docs, prints, links, size)))
    unstore(links, same)
    kept = prints.join(classes, F.col("key") == F.col("node"), "left").groupBy(F.coalesce("root", "key").alias("root")).agg(F.min(F.struct("doc_id", "text_hash")).alias("_least"))
    rows = docs.withColumns({"_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_hash": text_hash()})
    found = rows.join(kept.select("_least"), (F.col("_key") == F.col("_least.doc_id")) & (F.col("_hash") == F.col("_least.text_hash")))
    return found.dropDuplicates(["_key", "_hash"]).select(*docs.columns)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, radius=4)
    return found.select(id_back(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), id_back("component").alias("component_id"))
