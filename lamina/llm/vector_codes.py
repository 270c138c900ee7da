"""Vector code compression by cover-tree Lloyd: product codes whose codebooks are trained on all vectors, exactly.

Components become integers, floor(256 x), and vectors are cut into equal parts, each position with a codebook of its own.
Tasks build a cover tree per block of vectors and part position once, and keep the trees in a written table; the rounds
read the trees, not the vectors. Trees are nested and built from the top (the simplified cover tree of Izbicki and Shelton): a cluster
lies within a radius around its centre, and is split into clusters of half the radius whose centres are further apart than that. Each node knows the
number and the sum of the vectors below it.

A round walks each tree from its root with the entries that may still be nearest. By the triangle inequality an entry that is further
from the centre than the nearest one by over twice the node's radius is nearest to nothing below. If one entry is
left, the node's number and sum go to it as a whole; only ambiguous nodes descend, and single points are settled by exact integer
distances, ties to the lower index. Tasks return a row per part, entry and component; Spark adds them up and the driver divides. What reaches the driver and
goes back is a codebook, whose size follows from the parameters and not from the number of vectors. Pruning is by floating point
numbers with a margin, so it only ever leaves more to the exact comparison, and the results do not depend on how vectors are dealt.

Vectors that are null or hold null or non-finite components are dropped, and so are those whose length differs from that
of the smallest vec_id. If the length is not a multiple of the number of parts, the first parts are longer by one; a part of no
component has distance zero to all entries. The codebook starts from the smallest different ids; of rows that share an id the
vector that is smaller from left to right counts, and rows without an id come last. With fewer ids there are fewer entries. Repeated rows
count each time and are all returned. Components of any size are exact: from 2**17 on a block is computed in
whole numbers of Python, without pruning; errors beyond 64 bits are given as the largest number. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import at_hand, stored, table

BLOCK = 2**20  # components
LARGE = 2**17
ROWS = 4096  # nodes compared with the entries at once
LIMB = 40  # bits of a sum that travel as one number
MOST = 2**63 - 1
Codebook = list[list[list[int]]]  # by part, entry and component


class Tree(NamedTuple):
    points: np.ndarray  # different vectors of the part
    weight: np.ndarray  # rows with that vector
    point_of: np.ndarray  # by row
    centre: np.ndarray  # by node, as are the next five; parents come before their children
    parent: np.ndarray
    square: np.ndarray  # of the radius
    count: np.ndarray
    total: np.ndarray
    level: np.ndarray
    leaf: np.ndarray  # by point


def as_integers(values: np.ndarray) -> np.ndarray:
    """floor(256 x), as 64-bit integers if all are small enough for exact squares."""
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0) < LARGE:
        return np.floor(values * 256).astype(np.int64)
    whole = [[int(v) * 256 if abs(v) >= 2.0**52 else math.floor(v * 256) for v in row] for row in values.tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _different(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if rows.shape[1] == 0:
        return rows[:1], np.zeros(len(rows), np.int64)
    if rows.dtype != object:
        points, point_of = np.unique(rows, axis=0, return_inverse=True)
        return points, point_of.reshape(-1)
    seen: dict[tuple, int] = {}
    point_of = np.array([seen.setdefault(tuple(r), len(seen)) for r in rows], np.int64)
    return np.array(list(seen), dtype=object).reshape(len(seen), rows.shape[1]), point_of


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def build(rows: np.ndarray) -> Tree:
    """The cover tree of the rows; a level is made for all clusters at once."""
    points, point_of = _different(rows)
    n = len(points)
    weight = np.bincount(point_of, minlength=n)
    centre, parent, square, level, label = [np.zeros(1, np.int64)], [np.full(1, -1)], [], [np.zeros(1, np.int64)], np.zeros(n, np.int64)
    made, apart = 1, _squares(points, points[:1])
    square.append(np.array([apart.max()], dtype=points.dtype))
    live = np.arange(n) if n > 1 else np.zeros(0, np.int64)  # points of clusters with several
    limit = 4 ** max(0, (int(apart.max()).bit_length() + 1) // 2)
    while len(live):
        limit = limit // 4 if limit > 1 else 0
        middle = np.concatenate(centre)
        apart = _squares(points[live], points[middle[label[live]]])
        near = apart <= limit
        split = np.zeros(made, bool)
        split[label[live[~near]]] = True
        moving = split[label[live]]
        if not moving.any():
            continue
        old, fresh = label[live].copy(), made
        own = np.flatnonzero(split)
        target = np.full(made, -1)
        target[own] = fresh + np.arange(len(own))
        new_centre, new_parent = [middle[own]], [own]
        fresh += len(own)
        stay = moving & near
        label[live[stay]] = target[old[stay]]
        rest = np.flatnonzero(moving & ~near)
        while len(rest):
            cluster, first = np.unique(old[rest], return_index=True)
            head = live[rest[first]]
            which = np.searchsorted(cluster, old[rest])
            close = _squares(points[live[rest]], points[head[which]]) <= limit
            label[live[rest[close]]] = fresh + which[close]
            new_centre.append(head)
            new_parent.append(cluster)
            fresh += len(cluster)
            rest = rest[~close]
        added = np.concatenate(new_centre)
        centre.append(added)
        parent.append(np.concatenate(new_parent))
        level.append(np.full(len(added), len(level)))
        moved = live[moving]
        reach = np.zeros(len(added), dtype=points.dtype)
        np.maximum.at(reach, label[moved] - made, _squares(points[moved], points[added[label[moved] - made]]))
        square.append(reach)
        made = fresh
        live = live[np.bincount(label, minlength=made)[label[live]] > 1]
    centre, parent, square, level = map(np.concatenate, (centre, parent, square, level))
    count, total = np.zeros(made, np.int64), np.zeros((made, points.shape[1]), dtype=points.dtype)
    count[label] = weight
    total[label] = points * weight[:, None]
    for at in range(int(level.max()), 0, -1):
        nodes = np.flatnonzero(level == at)
        np.add.at(count, parent[nodes], count[nodes])
        np.add.at(total, parent[nodes], total[nodes])
    return Tree(points, weight, point_of, centre, parent, square, count, total, level, label)


def nearest(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """By node: the entry that is nearest to all points below, -1 where the walk went deeper or did not come."""
    answer = np.full(len(tree.centre), -1)
    exact = tree.points.dtype == object or entries.dtype == object
    order = np.argsort(tree.parent, kind="stable")
    bound = np.searchsorted(tree.parent[order], np.arange(len(tree.centre) + 1))
    waiting = [(np.zeros(1, np.int64), np.ones((1, len(entries)), bool))]
    while waiting:
        nodes, may = waiting.pop()
        if len(nodes) > ROWS:
            waiting += [(nodes[a : a + ROWS], may[a : a + ROWS]) for a in range(0, len(nodes), ROWS)]
            continue
        squares = _squares(tree.points[tree.centre[nodes]][:, None, :], entries[None])
        single = tree.square[nodes] == 0
        if exact:
            answer[nodes[single]] = [min(range(len(row)), key=row.__getitem__) for row in squares[single].tolist()]
            left = may
        else:
            answer[nodes[single]] = np.where(may[single], squares[single], MOST).argmin(axis=1)
            apart = np.where(may, np.sqrt(squares.astype(np.float64)), np.inf)
            reach = apart.min(axis=1) + 2 * np.sqrt(tree.square[nodes].astype(np.float64))
            left = apart <= (reach * (1 + 1e-9) + 1e-9)[:, None]
        one = (left.sum(axis=1) == 1) & ~single
        answer[nodes[one]] = left[one].argmax(axis=1)
        deeper = np.flatnonzero(~single & ~one)
        if len(deeper):
            first, after = bound[nodes[deeper]], bound[nodes[deeper] + 1]
            sizes = after - first
            below = order[np.repeat(first - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())]
            waiting.append((below, np.repeat(left[deeper], sizes, axis=0)))
    return answer


def by_point(tree: Tree, answer: np.ndarray) -> np.ndarray:
    answer = answer.copy()
    for at in range(1, int(tree.level.max()) + 1):
        nodes = np.flatnonzero((tree.level == at) & (answer < 0))
        answer[nodes] = answer[tree.parent[nodes]]
    return answer[tree.leaf]


def _entries(codebook: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < 256 * LARGE for row in codebook for x in row)
    return np.array(codebook, dtype=np.int64 if small else object).reshape(len(codebook), -1)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as numbers of LIMB bits; the last has the sign."""
    at = 0
    while not -(2**LIMB) <= value < 2**LIMB:
        yield at, value & (2**LIMB - 1)
        value >>= LIMB
        at += 1
    yield at, value


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is whole, all of the length that the smallest id has."""
    whole = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    good = vectors.where(F.coalesce(whole, F.lit(False)))
    first = good.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("n")).limit(1).collect()
    return good.where(F.size("embedding") == (first[0]["n"] if first else 0))


def first_codebook(good: DataFrame, parts: int, entries: int) -> Codebook:
    ids = [r["vec_id"] for r in good.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    chosen = good.where(F.col("vec_id").isin([i for i in ids if i is not None]) | (F.lit(None in ids) & F.col("vec_id").isNull()))
    rows = chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.asc_nulls_last("vec_id")).collect()
    if not rows:
        return []
    whole = as_integers(np.array([r["embedding"] for r in rows]))
    return [p.tolist() for p in np.array_split(whole, parts, axis=1)]


def planted(good: DataFrame, parts: int) -> DataFrame:
    """Blocks of vectors: their ids and labels, and a tree per part."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = batch.column("embedding")
            values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            step = max(1, BLOCK // max(1, values.shape[1]))
            for a in range(0, batch.num_rows, step):
                some = as_integers(values[a : a + step])
                data = pack.compress(pickle.dumps([tuple(build(p)) for p in np.array_split(some, parts, axis=1)]))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), batch.column(c).slice(a, step)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([data], pa.binary())], ["vec_id", "label", "trees"])

    kinds = [f"{c} array<{good.schema[c].dataType.simpleString()}>" for c in ("vec_id", "label")]
    return stored(good.select("vec_id", "label", "embedding").mapInArrow(trees, f"{', '.join(kinds)}, trees binary"), "vector-trees")


def _open(data: bytes) -> list[Tree]:
    return [Tree(*t) for t in pickle.loads(zstandard.ZstdDecompressor().decompress(data))]


def better_codebook(blocks: DataFrame, codebook: Codebook) -> Codebook:
    """One round: each entry becomes the mean of the parts nearest to it, those without parts stay."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [_entries(c) for c in codebook]
        found: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for data in batch.column("trees").to_pylist():
                for part, tree in enumerate(_open(data)):
                    answer = nearest(tree, entries[part])
                    nodes = np.flatnonzero(answer >= 0)
                    sums = np.zeros((len(entries[part]), 1 + tree.points.shape[1]), dtype=tree.total.dtype)
                    np.add.at(sums, answer[nodes], np.column_stack([tree.count[nodes], tree.total[nodes]]))
                    for entry in np.flatnonzero(sums[:, 0]).tolist():
                        for place, value in enumerate(sums[entry].tolist()):
                            found[part, entry, place] = found.get((part, entry, place), 0) + value
        rows = [(*key, limb, value) for key, whole in found.items() for limb, value in limbs(whole)]
        names = ["part", "entry", "place", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names)

    sums = blocks.select("trees").mapInArrow(summed, "part long, entry long, place long, limb long, value long")
    whole: dict[tuple[int, int], dict[int, int]] = {}
    for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():  # as many as a codebook has numbers
        places = whole.setdefault((r["part"], r["entry"]), {})
        places[r["place"]] = places.get(r["place"], 0) + (r["value"] << LIMB * r["limb"])
    return [
        [[whole[p, e][i + 1] // whole[p, e][0] for i in range(len(row))] if (p, e) in whole else row for e, row in enumerate(book)]
        for p, book in enumerate(codebook)
    ]


def coded(blocks: DataFrame, codebook: Codebook) -> DataFrame:
    """vec_id, label, code (an index of one byte per part) and error of each vector."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [_entries(c) for c in codebook]
        for batch in batches:
            for i, data in enumerate(batch.column("trees").to_pylist()):
                codes, errors = [], 0
                for tree, book in zip(_open(data), entries, strict=True):
                    index = by_point(tree, nearest(tree, book))
                    off = _squares(tree.points, book[index])
                    codes.append(index[tree.point_of].astype(np.uint8))
                    errors = errors + off[tree.point_of]
                code = [c.tobytes() for c in np.column_stack(codes)]
                lists = [batch.column(c).slice(i, 1).flatten() for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(code, pa.binary()), pa.array([min(e, MOST) for e in errors.tolist()], pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = [f"{c} {blocks.schema[c].dataType.elementType.simpleString()}" for c in ("vec_id", "label")]
    return blocks.mapInArrow(found, f"{', '.join(kinds)}, code binary, error long")


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, Codebook]:
    """The codes of vectors (vec_id, embedding, label), and the codebooks; ``entries`` is 256 at most."""
    if not 1 <= entries <= 256:
        raise ValueError(f"{entries} entries do not fit into a byte")
    at_hand(vectors.sparkSession)
    good = kept_vectors(vectors.select("vec_id", "embedding", "label"))
    blocks, codebook = planted(good, parts), first_codebook(good, parts, entries)
    for _ in range(rounds):
        codebook = better_codebook(blocks, codebook)
    return coded(blocks, codebook), codebook


def codebooks_sha256(codebook: Codebook) -> str:
    return hashlib.sha256(",".join(str(x) for part in codebook for entry in part for x in entry).encode()).hexdigest()


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    rows, codebook = compress(table(spark, sf_dir, "embeddings"))
    rows = stored(rows, "vector-codes")
    by_label = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    by_label = by_label.select(F.col("label").alias("of"), F.least("sum", F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    found = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_sha256(codebook)).alias("codebooks_sha256"))


def _round(before: str, after: str) -> str:
    """SQL of a round: assignments to the codebook ``before``, and the codebook ``after``."""
    return f"""
{after}_near AS (
  SELECT id, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
    SELECT v.id, v.part, c.entry, CAST(list_sum(list_transform(range(1, len(v.p) + 1), lambda i: (v.p[i] - c.p[i]) * (v.p[i] - c.p[i]))) AS BIGINT) AS d
    FROM parts v JOIN {before} c USING (part)
  ) GROUP BY id, part
), {after} AS (
  SELECT c.part, c.entry, coalesce(m.p, c.p) AS p FROM {before} c LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS p FROM (
      SELECT n.part, n.entry, place, CAST(floor(sum(v.p[place]) / count(*)) AS BIGINT) AS mean
      FROM {after}_near n JOIN parts v USING (id, part), range(1, 5) AS places(place) GROUP BY ALL
    ) GROUP BY part, entry
  ) m USING (part, entry)
)"""


# The same rows by comparing every part with every entry, for vectors of 64 components.
OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT id, part, v[4 * part + 1 : 4 * part + 4] AS p FROM kept, range(0, 16) AS t(part)
), c0 AS (SELECT part, CAST(id - 1 AS INTEGER) AS entry, p FROM parts WHERE id <= 64), {_round("c0", "c1")}, {_round("c1", "c2")}, {_round("c2", "c3")},
found AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM c3_near GROUP BY id
), books AS (
  SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM found JOIN kept USING (id), books
"""
