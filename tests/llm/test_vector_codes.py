import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from lamina.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The definition in whole numbers of Python."""
    good = [(i, [math.floor(Fraction(float(np.float32(x))) * 256) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    cut = lambda v: [p.tolist() for p in np.array_split(np.array(v, dtype=object), parts)]
    first = {}
    for i, v, _ in good:
        first.setdefault(i, v)
    books = [[list(e) for e in p] for p in zip(*(cut(v) for v in list(first.values())[:entries]), strict=True)]

    def near(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for q, book in enumerate(books):
            groups = {}
            for _, v, _ in good:
                p = cut(v)[q]
                groups.setdefault(near(p, book)[1], []).append(p)
            for k, g in groups.items():
                book[k] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    found = [(i, k, [near(p, b) for p, b in zip(cut(v), books, strict=True)]) for i, v, k in good]
    sums = {}
    for _, k, n in found:
        sums[k] = sums.get(k, 0) + min(sum(d for d, _ in n), vc.MOST)
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in n), min(sum(d for d, _ in n), vc.MOST), min(sums[k], vc.MOST), sha) for i, k, n in found), key=str)


def made(spark, monkeypatch, rows, schema=SCHEMA):
    monkeypatch.setattr(vc, "table", lambda *_: spark.createDataFrame(rows, schema).repartition(3))
    found = vc.op12_vector_codes(spark, "")
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def vectors(seed, n=300, dims=64, scale=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, scale, (9, dims))
    return [(int(i), [float(x) for x in np.float32(middle[rng.integers(9)] + rng.normal(0, scale / 4, dims))], [None, 1, 2][rng.integers(3)]) for i in rng.permutation(n)]


def test_against_the_definition(spark, monkeypatch):
    rows = vectors(1)
    assert made(spark, monkeypatch, rows) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    base = vectors(2, 120)
    odd = [(500, None, 1), (501, [None] * 64, 1), (502, [float("nan")] * 64, 2), (503, [float("inf")] + [0.0] * 63, None), (504, [], 1), (505, [0.5] * 32, 1), (-5, None, 1)]
    again = base[:20] + [(base[0][0], base[1][1], 2), (None, base[3][1], 1), (None, base[4][1], None)] + [(600 + i, base[5][1], 1) for i in range(200)]
    assert made(spark, monkeypatch, base + odd + again) == plain(base + odd + again)


def test_ties_and_few_vectors(spark, monkeypatch):
    rows = [(i, [float((i * k) % 3) / 128 for k in range(32)], i % 2) for i in range(30)]
    assert made(spark, monkeypatch, rows) == plain(rows)


@pytest.mark.parametrize("dims", [3, 16, 40])
def test_other_lengths(spark, monkeypatch, dims):
    rows = vectors(3, 90, dims)
    assert made(spark, monkeypatch, rows) == plain(rows)


def test_huge_components(spark, monkeypatch):
    rows = vectors(4, 80, 32) + [(1000 + i, [3e38 if i % 2 else -1e20 * i] * 16 + [0.25 * i] * 16, 1) for i in range(8)] + [(-1, [1e9] * 32, 2)]
    assert made(spark, monkeypatch, rows) == plain(rows)


def test_empty_table_and_clashes(spark, monkeypatch):
    assert made(spark, monkeypatch, []) == []
    assert made(spark, monkeypatch, [(1, None, 1)]) == []
    rows = vectors(5, 40, 16)
    clash = [(*r, 1, 2, 3) for r in rows]
    assert made(spark, monkeypatch, clash, SCHEMA + ", code int, error int, trees int") == plain(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tree_invariants(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-30, 30, (rng.integers(1, 600), rng.integers(1, 6)))
    tree = vc.build(rows)
    assert (tree.points[tree.point_of] == rows).all()
    for node in range(len(tree.centre)):
        below = np.zeros(len(tree.centre), bool)
        below[node] = True
        for k in range(node + 1, len(tree.centre)):
            below[k] = below[tree.parent[k]]
        inside = below[tree.leaf]
        assert tree.count[node] == tree.weight[inside].sum()
        assert (tree.total[node] == (tree.points[inside] * tree.weight[inside, None]).sum(axis=0)).all()
        assert tree.square[node] == ((tree.points[inside] - tree.points[tree.centre[node]]) ** 2).sum(axis=1).max()
    assert (tree.parent[1:] < np.arange(1, len(tree.parent))).all()


def test_whole_subtrees_are_settled():
    """Far clusters are given away near the root."""
    rng = np.random.default_rng(1)
    middle = np.array([[0, 0, 0, 0], [4000, 0, 0, 0], [0, 4000, 0, 0], [0, 0, 4000, 4000]])
    rows = np.concatenate([m + rng.integers(-20, 20, (2000, 4)) for m in middle])
    tree = vc.build(rows)
    answer = vc.nearest(tree, middle)
    assert (answer >= 0).sum() < 100 and tree.count[answer >= 0].sum() == len(rows)
    assert (vc.by_point(tree, answer)[tree.point_of] == np.repeat(np.arange(4), 2000)).all()


def test_limbs():
    for value in (0, 1, -1, 2**40, -(2**40), 2**40 - 1, 12345678901234567890123, -(2**200) + 17):
        parts = list(vc.limbs(value))
        assert sum(v << vc.LIMB * k for k, v in parts) == value and all(abs(v) <= 2**40 for _, v in parts)


def test_plan_and_limits(spark):
    docs = spark.createDataFrame(vectors(6, 50, 16), SCHEMA)
    with pytest.raises(ValueError):
        vc.compress(docs, entries=257)
    rows, book = vc.compress(docs, parts=4, entries=8, rounds=1)
    assert len(book) == 4 and all(len(p) == 8 and all(len(e) == 4 for e in p) for p in book)
    assert all(len(r["code"]) == 4 for r in rows.collect())
