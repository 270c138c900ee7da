import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import suffixes, windows


def sha(data):
    return hashlib.sha256(data).hexdigest()


def by_words(rows, size):
    """n_words, n_removed and hash of the kept words, by a dictionary of all windows."""
    key = lambda i: 2**63 - 1 if i is None else i
    least = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            least[x] = min(least.get(x, key(i)), key(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < key(i):
                gone[k : k + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return sorted(out, key=str)


def by_bytes(rows, size):
    key = lambda i: 2**63 - 1 if i is None else i
    least = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, t in raw:
        for p in range(len(t) - size + 1):
            x = hashlib.md5(t[p : p + size]).digest()
            least[x] = min(least.get(x, (key(i), p)), (key(i), p))
    out = []
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - size + 1):
            if least[hashlib.md5(t[p : p + size]).digest()] < (key(i), p):
                gone[p : p + size] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    return sorted(out, key=str)


def near_texts(seed, n=60):
    rng = np.random.default_rng(seed)
    base = [" ".join(rng.choice([f"w{i}" for i in range(300)], 80)) for _ in range(6)]
    rows = []
    for i in range(n):
        words = base[rng.integers(6)].split()
        a, b = sorted(rng.integers(0, 80, 2))
        rows.append((int(i), " ".join([*words[a:b], *rng.choice([f"v{k}" for k in range(50)], rng.integers(0, 20)), *base[rng.integers(6)].split()[: rng.integers(0, 40)]])))
    return rows


def windows_of(docs):
    return sorted(((r["doc_id"] if r["doc_id"] != 2**63 - 1 else None, r["n_words"], r["n_removed"], sha(bytes(r["kept"]))) for r in windows.remove_repeats(docs).collect()), key=str)


def bytes_of(docs, size=100):
    return sorted(((r["doc_id"] if r["doc_id"] != 2**63 - 1 else None, r["n_bytes"], r["n_removed"], len(r["spans"]), sha(bytes(r["kept"]))) for r in suffixes.remove_repeats(docs, size).collect()), key=str)


def test_windows_against_brute_force(docs_of):
    rows = near_texts(1)
    assert windows_of(docs_of(rows)) == by_words(rows, 13)


def test_windows_of_odd_rows(docs_of, odd_rows):
    assert windows_of(docs_of(odd_rows)) == by_words([r[:2] for r in odd_rows], 13)


def test_suffixes_against_brute_force(docs_of):
    rows = near_texts(2)
    assert bytes_of(docs_of(rows)) == by_bytes(rows, 100)


def test_suffixes_of_odd_and_periodic_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows if len(r[1] or "") < 100_000] + [(20, "a" * 1000), (21, "ab" * 400), (22, "a" * 99), (23, "xyz " * 80)]
    assert bytes_of(docs_of(rows)) == by_bytes(rows, 100)


def test_buckets_of_several_shards(docs_of, monkeypatch):
    rows = near_texts(3)
    monkeypatch.setattr(suffixes.removed_windows, "__defaults__", (100, 5))
    assert bytes_of(docs_of(rows)) == by_bytes(rows, 100)


@pytest.mark.parametrize("operator", [windows.remove_repeats, suffixes.remove_repeats])
def test_empty_table_and_other_columns(docs_of, operator):
    docs = docs_of([(1, "a b")])
    assert operator(docs.limit(0)).count() == 0
    clash = docs.selectExpr("doc_id", "text", "1 AS bucket", "2 AS kind", "3 AS found", "4 AS hashes", "5 AS spans")
    assert operator(clash).count() == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=260), max_size=5))
def test_suffix_groups_are_equal_windows(texts):
    texts = [t.encode() for t in texts]
    if not texts:
        return
    row, place, group = suffixes.equal_windows(texts, 70)
    found = {}
    for r, p, g in zip(row.tolist(), place.tolist(), group.tolist(), strict=True):
        found.setdefault(g, set()).add(texts[r][p : p + 70])
    assert all(len(v) == 1 for v in found.values())
    assert len({next(iter(v)) for v in found.values()}) == len(found)
    assert len(row) == sum(max(0, len(t) - 69) for t in texts)


def test_equal_windows_have_equal_anchors():
    texts = [t.encode() for _, t in near_texts(4, 20)]
    row, first, last, h = suffixes.runs(texts, 100)
    seen = {}
    for r, a, b, k in zip(row.tolist(), first.tolist(), last.tolist(), h.tolist(), strict=True):
        for p in range(a, b + 1):
            assert seen.setdefault(texts[r][p : p + 100], k) == k
    assert sum(b - a + 1 for a, b in zip(first.tolist(), last.tolist(), strict=True)) == sum(max(0, len(t) - 99) for t in texts)


def test_long_text_without_spaces_and_word_hashes():
    from lamina.llm.common import word_hashes
    a, _ = word_hashes([b"x" * 5_000_000 + b" end", b"end"])
    assert len(a) == 3 and a[1] == a[2]
    long = b" ".join(b"w%d" % (i % 1000) for i in range(900_000))
    h, row = word_hashes([b"w1", long])
    assert len(h) == 900_001 and h[0] == h[2] and row.tolist()[:2] == [0, 1] and len(set(h.tolist())) == 1000


def test_words_made_to_collide_remove_nothing(docs_of):
    """Two texts over two letters whose polynomials modulo 2**64 are equal for any base."""
    x = "ab"
    while len(x) < 1024:
        x += x.translate(str.maketrans("ab", "ba"))
    y = x.translate(str.maketrans("ab", "ba"))
    tail = [f"t{i}" for i in range(12)]
    rows = [(1, " ".join([x, *tail])), (2, " ".join([y, *tail])), (3, " ".join([x, *tail]))]
    assert windows_of(docs_of(rows)) == by_words(rows, 13)
    assert [r[2] for r in windows_of(docs_of(rows))] == [0, 0, 13]


def test_equal_hashes_are_told_apart_by_their_checks():
    h = np.array([7, 7, 7, 7], np.uint64)
    by, new = windows._sorted(h, np.array([2, 1, 2, 1], np.uint32))
    assert by.tolist() == [1, 3, 0, 2] and new.tolist() == [True, False, True, False]


def test_a_passage_of_a_third_of_all_documents_is_spread(docs_of, monkeypatch):
    monkeypatch.setattr(windows, "CHUNK", 1 << 40)
    hot = " ".join(f"hot{i}" for i in range(40))
    rows = [(i, f"own{i} {hot} own{i}" if i % 3 == 0 else f"other{i} " * 20) for i in range(600)]
    docs = docs_of(rows)
    assert windows_of(docs) == by_words(rows, 13)
    found = windows.repeats(docs.repartition(1), lambda texts: windows.checked(texts, 13), 8)
    largest = max(r["n"] for r in found.groupBy("bucket").agg(F.sum(F.length("hashes") / 8).alias("n")).collect())
    assert largest < 10 * 28  # each of its 28 windows meets in a bucket once per chunk; the rest goes by document
