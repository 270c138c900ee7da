import re
from collections import Counter

import numpy as np
import pytest

from lamina.llm import phrases


def plain_counts(rows, longest):
    found = {}
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    found.setdefault(lang or "und", Counter())[" ".join(w[i : i + m])] += 1
    return found


def plain(rows, longest=3, least=10, share=50, top=2000):
    out = []
    for lang, f in plain_counts(rows, longest).items():
        n = sum(a for p, a in f.items() if " " not in p)
        found = {p: a for p, a in f.items() if " " in p and a >= least}
        scored = []
        for p, a in found.items():
            if any(f" {p} " in f" {q} " and len(q) > len(p) and 100 * b >= share * a for q, b in found.items()):
                continue
            w = p.split(" ")
            cuts = [(1000000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, i + 1, p.decode(), -a, x, r, n, -s) for i, (s, a, p, x, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def made(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def table_of(docs_of, rows):
    return docs_of([(i, t, lang) for i, (t, lang) in enumerate(rows)])


def sentences(seed, n=400, words=14):
    rng = np.random.default_rng(seed)
    marks = [" ", "  ", "\t", ". ", ", ", "\n", "!?"]
    rows = []
    for _ in range(n):
        w = [f"W{min(int(x), words)}" for x in rng.geometric(0.25, rng.integers(0, 30))]
        text = "".join(x + marks[min(int(m), 6)] for x, m in zip(w, rng.geometric(0.6, len(w)) - 1, strict=True))
        rows.append((text, [None, "und", "en", "fr"][rng.integers(4)]))
    passage = "the quick brown fox jumps over a lazy dog once more"
    return rows + [(f"W1 {passage}. W2", "en")] * 12 + [(passage + " and then some", "en")] * 3 + [(passage, "fr")] * 11


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_against_plain_counting(docs_of, longest):
    rows = sentences(longest)
    found = made(phrases.collocations(table_of(docs_of, rows), longest=longest))
    assert found == plain(rows, longest) and len(found) > 20


def test_top_and_ties(docs_of):
    rows = [(f"a{i} b{i}. " * 10, "x") for i in range(9)] + [("C d. " * 10, "x")]
    assert made(phrases.collocations(table_of(docs_of, rows), top=4)) == plain(rows, top=4)


def test_counts_are_node_flows(docs_of):
    rows = sentences(7)
    found = {(r["lang"], r["phrase"]): r["n"] for r in phrases.counts(table_of(docs_of, rows)).collect()}
    want = {(lang, p): a for lang, f in plain_counts(rows, 3).items() for p, a in f.items() if " " not in p or a >= 10}
    assert found == want


def test_unary_paths(docs_of):
    rows = [("one two three four five six", "en")] * 20 + [("nine three four ten", "en")] * 15 + [("five six seven", "en")] * 4
    found = phrases.counts(table_of(docs_of, rows))
    got = {r["phrase"]: (r["words"], r["n"]) for r in phrases.paths(found, 3).collect()}
    # "three four" has two edges in and out, "five six" ends some pieces
    assert got == {"one two three four": (4, 20), "three four five six": (4, 20), "nine three four": (3, 15), "three four ten": (3, 15)}


def test_long_path_and_long_text(docs_of, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 4096)
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(long, "en")] * 10 + [("x y z. " * 4000, "en")]
    found = phrases.counts(table_of(docs_of, rows))
    got = {r["phrase"]: r["n"] for r in phrases.paths(found, 3).collect()}
    assert got == {long: 10, "x y z": 4000}


def test_hot_word_is_exact(docs_of):
    rows = [("the " * 50 + "end.", "en")] * 300
    assert made(phrases.collocations(table_of(docs_of, rows))) == plain(rows)


def test_products_beyond_64_bits(spark):
    a, x, y = 2 * 10**12 + 1, 3 * 10**12 + 1, 4 * 10**12 + 1
    scored = spark.createDataFrame([("en", "p q", a, x, y)], "lang string, phrase string, a long, l long, r long").select(phrases.score("a", "l", "r").alias("s"))
    assert scored.first()["s"] == 1000000 * a**2 // (x * y)


def test_odd_rows_clashes_and_empty_table(docs_of, odd_rows, spark):
    rows = [r[1:3] for r in odd_rows if len(r[1] or "") < 1000] * 11
    assert made(phrases.collocations(table_of(docs_of, rows))) == plain(rows)
    clash = table_of(docs_of, rows).selectExpr("*", "1 AS phrase", "2 AS n", "3 AS words", "4 AS rank", "5 AS edge")
    assert made(phrases.collocations(clash)) == plain(rows)
    assert phrases.collocations(docs_of([(1, "a", "en")]).limit(0)).count() == 0
    assert made(phrases.collocations(docs_of([(1, None, None), (2, "", "en")]))) == []
