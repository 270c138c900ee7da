import collections
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lamina.llm import decontam, langid, quality

FOLDER = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- language models

def kneser_ney(texts, context, letter):
    """Interpolated Kneser-Ney by its definition, over units of normalised texts."""
    four = collections.Counter()
    for t in texts:
        u = "".join(map(chr, langid.units([t])[0]))
        padded = "   " + u
        for i in range(1, len(u)):
            four[padded[i : i + 4]] += 1
    levels = [four]
    for n in (3, 2, 1):
        levels.append(collections.Counter(k[-n:] for k in levels[-1]))
    vocabulary = len(levels[-1])

    def p(level, context, letter):
        if level == 4:
            return 1 / max(2, vocabulary)
        counts = levels[level]
        once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        d = min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))
        after = {k: c for k, c in counts.items() if k[:-1] == context}
        lower = p(level + 1, context[1:], letter)
        if not after:
            return lower
        return (max(after.get(context + letter, 0) - d, 0) + d * len(after) * lower) / sum(after.values())

    return p(0, context, letter)


def test_probabilities_follow_the_definition():
    texts = ["ab abc abd bad", "hello world abc, bad cab"]
    u, start = langid.units(texts)
    keys, n = np.unique(langid.grams(u, start)[0], return_counts=True)
    model = langid.build(["x"], [(keys, n)])
    for context in (" ab", "  a", "hel", "zzz", "lo ", "abc"):
        for letter in "abcdehlo wz":
            key = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context + letter))
            found = float(np.exp(langid.log_probabilities(model, np.array([key], np.uint64))[0, 0]))
            assert found == pytest.approx(kneser_ney(texts, context, letter), rel=1e-4), (context, letter)
        total = np.exp(langid.log_probabilities(model, np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context)) | int(k) for k in model.keys[-1]], np.uint64)))
        assert total.sum() == pytest.approx(1, abs=1e-3)


def test_letters_beyond_the_basic_plane(docs_of):
    wide = "".join(chr(0x20000 + i) for i in range(40))
    units, start = langid.units(["a", f"b{wide[:2]} c", wide])
    assert units.tobytes().decode("utf-16-le") == f" a b{wide[:2]} c {wide}" and start.tolist() == [0, 2, 10]
    rows = [(i, wide[i % 30 : i % 30 + 10] if i % 2 else "abc bad cab", ("han", "latin")[i % 2 == 0]) for i in range(200)]
    model = langid.fit(docs_of(rows))
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs_of([(1, "\U00020020"), (2, wide), (3, "\U00020061"), (4, "bad")]), model).collect()}
    assert found.pop(3) != "und" and found == {1: "han", 2: "han", 4: "latin"}


def test_languages_of_odd_rows(docs_of, odd_rows):
    words = {"xx": "alpha beta gamma delta", "yy": "uno dos tres cuatro"}
    rows = [(i, " ".join(random.Random(i).choices(words[lang].split(), k=30)), lang) for i in range(100, 300) for lang in [("xx", "yy")[i % 2]]]
    train = docs_of(rows).withColumns({"score": F.lit(1), "key": F.lit(2), "n": F.lit(3)})
    model = langid.fit(train)
    found = {r["doc_id"]: r for r in langid.identify(train, model).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows)
    odd = langid.identify(docs_of(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in odd if not (r["text"] or "").strip())
    assert langid.identify(docs_of([(1, "123 !"), (2, "日本")]), model).where("lang_pred = 'und'").count() == 1
    none = langid.fit(docs_of([(1, "a b", None)]))
    assert none is None and langid.identify(docs_of([(1, "a b")]), none).first()["lang_pred"] == "und"
    assert langid.identify(train.limit(0), model).count() == 0


@pytest.mark.parametrize("module", ["langid", "quality"])
def test_held_out_accuracy(spark, module):
    if module == "langid":
        found = langid.op6_langid(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
        right = F.col("lang_pred") == F.col("lang")
    else:
        found = quality.op9_quality(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
        right = F.col("predicted") == F.col("quality")
    rate = found.where("held_out").agg(F.avg(right.cast("double"))).first()[0]
    assert rate > (0.99 if module == "langid" else 0.92)
    assert found.agg(F.min("score") >= 0, F.max("score") <= 1).first()[:] == (True, True)


def test_many_sequences_leave_no_language_out(docs_of):
    rng = np.random.default_rng(4)
    rows = [(i, "".join(map(chr, rng.integers(0x4E00, 0x9F00, 22_000))), "big") for i in range(140)]  # over 2,000,000 different sequences
    rows += [(1000 + i, f"ab{chr(97 + i)} cd", "small") for i in range(20)]
    model = langid.fit(docs_of(rows))
    assert model.langs == ["big", "small"] and len(model.keys[0]) > 2_000_000
    assert langid.identify(docs_of([(1, "aba cd")]), model).first()["lang_pred"] == "small"


# ---------------------------------------------------------------- quality

def test_quality_of_odd_rows(docs_of, odd_rows, spark):
    docs = docs_of(odd_rows).withColumns({"score": F.lit(1), "quality": F.lit(2)})
    few = spark.createDataFrame([(4, 1), (4, 1), (6, 0), (None, 1), (8, None)], "doc_id long, quality int")
    model = quality.fit(docs, few)  # too few labels for dictionaries: their share is the score
    assert model.constant is not None and 0 <= model.constant <= 1
    assert quality.score(docs, model).count() == len(odd_rows)
    assert quality.fit(docs.limit(0), few.limit(0)).constant == 0.5
    assert quality.keep_good(docs, few).count() == len(odd_rows)  # nothing was learned, so nothing is rejected
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices("lorem ipsum dolor sit amet".split() if i % 2 else "##$$ %%&& @@!! ZZZ".split(), k=200))) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    model = quality.fit(docs_of(rows), labels)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs_of([*rows, *((i and i + 1000, t) for i, t, *_ in odd_rows)]), model).collect()}
    assert sum((scored[i] >= 0.5) == i % 2 for i, _ in rows) >= 390
    assert scored[1001] == scored[1002] == quality.EMPTY_SCORE
    kept = quality.keep_good(docs_of(rows), labels)
    assert kept.columns == ["doc_id", "text", "lang", "source"] and kept.count() >= 190
    small = [(i, t) for i, t in rows if i < 24]  # a dozen labels of each class, some of them held out
    left = {r["doc_id"] for r in quality.keep_good(docs_of(small), labels.where("doc_id < 24")).collect()}
    assert {i for i, _ in small if i % 2} == left
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_compares_sizes(docs_of):
    sizes = quality.Sizes(b"lorem ipsum dolor sit amet " * 20, b"##$$ %%&& @@!! ZZZ " * 20)
    text = b"lorem ipsum ##$$ dolor amet " * 60
    each = []
    for at in range(0, len(text), quality.PIECE):
        piece = text[at : at + quality.PIECE]
        by = [len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress(piece))
              for d in (b"lorem ipsum dolor sit amet " * 20, b"##$$ %%&& @@!! ZZZ " * 20)]
        each.append((by[1] - by[0], len(piece)))
    found = sizes.features(text)
    assert found[0] == pytest.approx(sum(d for d, _ in each) / len(text))
    long = [d / n for d, n in each if n >= quality.PIECE / 2]
    assert found[1:] == pytest.approx([min(long), max(long)])


# ---------------------------------------------------------------- benchmark leaks

def prose(seed, n):
    return " ".join(random.Random(seed).choices([f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"], k=n))


def test_common_subsequence():
    draw = random.Random(2)
    for _ in range(50):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(20))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontam.common_subsequence(np.array(a, np.uint16), np.array(b, np.uint16)) == table[-1, -1]


def test_leaks_and_paraphrases(docs_of, spark):
    items = [(k, prose(9000 + k, n)) for k, n in enumerate([12, 16, 20, 31, 32, 40, 55, 59])]
    rows = [(i, prose(i, 150)) for i in range(300)]
    draw = random.Random(4)
    for k, text in items:
        words = text.split()
        rows.append((1000 + k, f"{prose(500 + k, 37 + k)} {text} {prose(600 + k, 90)}"))  # verbatim
        rows.append((2000 + k, f"{prose(700 + k, 50)} {', '.join(w.upper() for w in words)}! {prose(800 + k, 70)}"))  # signs and case
        if len(words) >= 30:  # every eighth word replaced
            altered = [draw.choice(["zzz", "yyy"]) if i % 8 == 4 else w for i, w in enumerate(words)]
            rows.append((3000 + k, f"{prose(900 + k, 20)} {' '.join(altered)} {prose(950 + k, 60)}"))
    benchmark = spark.createDataFrame([*items, (99, None), (98, "too short")], "item_id long, text string")
    docs = docs_of(rows).withColumns({"first": F.lit(1), "terms": F.lit(2), "item_id": F.lit(3)})
    found = {(r["doc_id"], int(r["item_id"])) for r in decontam.leaks(docs, benchmark).collect()}
    want = {(i, i % 1000) for i, _ in rows if i >= 1000}
    assert found == want
    kept = decontam.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(300))


def test_leaks_of_odd_rows(docs_of, odd_rows, spark):
    docs = docs_of(odd_rows)
    item = odd_rows[3][1]
    benchmark = spark.createDataFrame([(None, item), (2, item), (2, item)], "item_id long, text string")
    found = decontam.leaks(docs, benchmark).collect()
    assert {r["doc_id"] for r in found} == {4, 5, 2**63 - 1}
    assert decontam.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontam.leaks(docs.limit(0), benchmark).count() == 0
