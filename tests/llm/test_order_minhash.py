import hashlib

import numpy as np
import pytest

from lamina.llm import order_minhash as om


def plain_fingerprint(data, sketches=om.SKETCHES, size=om.TUPLE):
    """The definition, an element at a time."""
    kmers, h = om.elements(data)
    keys = (h >> np.uint64(32)).astype(np.uint32)
    out = []
    for j, factor in enumerate(om.odd_factors(sketches)):
        least = sorted(range(len(keys)), key=lambda i: (int(keys[i]) * int(factor) % 2**32, i))[:size]
        value = np.array([j], np.uint64)
        for i in sorted(least):
            value = om.mixed(value * np.uint64(0x9E3779B97F4A7C15) + kmers[i : i + 1])
        out.append(int(value[0] >> np.uint64(48)))
    return out


def plain(rows):
    """Every column but the fingerprints, which have a test of their own; equal ids are not in here."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, new, its = (om.fingerprint(x.encode()) for x in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), om.as_hex(own), om.as_hex(new), om.likeness(own, new), om.likeness(own, its)))
    return sorted(out, key=str)


def made(df):
    return sorted((tuple(r[c] for c in om.RESULT) for r in df.collect()), key=str)


def texts(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "gamma", "é", "日本", "😀", "delta", "x"]
    return [(int(i) * 7 - 100, " ".join(rng.choice(words, rng.integers(0, 200)))) for i in rng.permutation(n)]


@pytest.mark.parametrize("data", [b"", b"a", b"1234567", b"12345678", b"123456789", b"ab" * 500, "é日本😀".encode() * 30, bytes(range(256)) * 40, b"a" * 10_000])
def test_fingerprint_by_definition(data):
    assert om.fingerprint(data).tolist() == plain_fingerprint(data)


def test_occurrences():
    rng = np.random.default_rng(5)
    for values in (rng.integers(0, 50, 3000), rng.integers(0, 2**63, 1000), np.zeros(10), np.zeros(0)):
        values, seen = values.astype(np.uint64), {}
        want = []
        for v in values.tolist():
            want.append(seen.get(v, 0))
            seen[v] = want[-1] + 1
        assert om.occurrences(values).tolist() == want
    many = np.tile(np.arange(2**17, dtype=np.uint64), 9)  # beyond 2**20
    assert (om.occurrences(many) == np.repeat(np.arange(9), 2**17)).all()


def test_values_with_the_same_upper_bits():
    """Two values whose mixed form differs only below: the numbering falls back on the values themselves."""
    inverse = lambda x: next(iter(unmixed(x)))
    a, b = inverse(7 << 20 | 1), inverse(7 << 20 | 2)
    values = np.array([a, b, a, b, b], np.uint64)
    assert om.mixed(values)[0] >> np.uint64(20) == om.mixed(values)[1] >> np.uint64(20)
    assert om.occurrences(values).tolist() == [0, 0, 1, 1, 2]


def unmixed(x):
    """The value that mixed() turns into x."""
    m = 2**64
    x ^= x >> 31 ^ x >> 62
    x = x * pow(0x94D049BB133111EB, -1, m) % m
    x ^= x >> 27 ^ x >> 54
    x = x * pow(0xBF58476D1CE4E5B9, -1, m) % m
    x ^= x >> 30 ^ x >> 60
    yield x


def test_rows_against_a_plain_walk(docs_of):
    rows = texts(1) + [(5000, None), (5001, ""), (5002, "short")]
    assert made(om.compared(docs_of(rows).repartition(7))) == plain(rows)


def test_long_text_and_single_row(docs_of):
    rows = [(1, " ".join(f"w{i % 5000} {i}" for i in range(120_000)))]
    assert made(om.compared(docs_of(rows))) == plain(rows)
    assert om.compared(docs_of(rows)).first()["near_next"] == 1.0


def test_order_counts():
    """Moving half of a text to the front leaves its words as they are, and the likeness falls."""
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in rng.permutation(2000)]
    a, moved, edited = " ".join(words), " ".join(words[1000:] + words[:1000]), " ".join([*words[:1000], "new", *words[1001:]])
    near = lambda x: om.likeness(om.fingerprint(a.encode()), om.fingerprint(x.encode()))
    assert near(a) == 1 and near(edited) > 0.9 and near(moved) < 0.75
    assert om.likeness(om.fingerprint(b"other text altogether"), om.fingerprint(a.encode())) < 0.1


def test_repeated_ids_odd_rows_and_clashes(docs_of, odd_rows):
    docs = docs_of(odd_rows).selectExpr("doc_id", "text", "1 AS h", "2 AS part", "3 AS fingerprint", "'x' AS end")
    got = om.compared(docs).collect()
    key = lambda r: str(r["doc_id"])
    assert sorted(map(key, got)) == sorted(str(r[0]) for r in odd_rows)
    by_text = {}
    for r in om.fingerprints(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert all(r["fingerprint"] in by_text[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert om.compared(docs.limit(0)).count() == 0


def test_ids_beyond_double_precision(docs_of):
    rows = [(2**62 + i, f"text number {i} of some") for i in range(5)] + [(None, "without id")]
    assert made(om.compared(docs_of(rows))) == plain(rows)
