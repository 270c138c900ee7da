import collections

import pytest
from pyspark.sql import functions as F

from lamina.llm import mixing, rules


def own(text, size=5):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    count = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(size)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


TEXTS = ["", None, "a b c", "a b c d e a b c d e f", "x " * 40, "one two\none two\n\n three #*", "the cat sat on the mat\nthe cat sat on the mat\nand so on", "é😀 ß\t日本 \x0b x"]


def test_own_numbers(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    found = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rules.own_numbers(docs_of(rows)).collect()}
    assert found == {i: own(t) for i, t in rows}


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows).withColumns({"rid": F.lit(1), "line": F.lit(2), "words": F.lit(3), "pos": F.lit(4)})
    found = rules.verdicts(docs).collect()
    assert len(found) == len(odd_rows)
    assert all(r["base_failed"] and not r["kept"] for r in found if r["n_words"] == 0)
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in found) == sorted((i or 0, own(t)[0]) for i, t, *_ in odd_rows)
    assert rules.verdicts(docs.limit(0)).count() == 0


def unique(n, k):
    return " ".join(f"w{n}x{i}" for i in range(k))


def test_common_lines_go_and_depleted_documents_too(docs_of):
    notice = "All rights   RESERVED by the house of examples and its many friends"
    rows = [(i, f"{unique(i, 30)}\n{notice}", "en", "h") for i in range(12)]
    rows += [(100, f"{notice}\n{notice.lower()}\nsmall rest here", "en", "h")]  # almost nothing but the notice
    rows += [(200 + i, f"{unique(i + 50, 30)}\n{notice}", "en", "other") for i in range(5)]  # below the limit of its host
    rows += [(300 + i, unique(999, 30), "en", "h") for i in range(10)]  # copies under ten ids are at the limit
    rows += [(400 + i, unique(998, 30), "en", "h") for i in range(11)]  # and under eleven above it
    rows += [(500, unique(997, 30), "en", "h")] * 40  # repeated rows of one id are one document
    rows += [(None, unique(996, 30), "en", "h")] * 40  # and so are those of one text without an id
    docs = docs_of(rows)
    kept = {r["doc_id"]: r["kept"] for r in rules.verdicts(docs).collect()}
    assert sorted(i for i, k in kept.items() if not k) == [100, *range(400, 411)]
    clean = {r["doc_id"]: r["text"] for r in rules.apply_rules(docs).collect()}
    assert set(clean) == {i for i, k in kept.items() if k}
    assert all("RESERVED" not in clean[i] for i in range(12)) and all("RESERVED" in clean[200 + i] for i in range(5))


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 3, "b": 1}, {f"s{i}": (i + 1) ** 2 for i in range(15)}, {"x": 1e-9, "y": 1, "z": 0}, {f"s{i}": 1 for i in range(700)}])
def test_one_period_deviates_by_less_than_a_block(weights):
    slots = mixing.slots_per_period(weights)
    period, got = sum(slots.values()), collections.Counter()
    assert set(slots) == {s for s, w in weights.items() if w > 0} and min(slots.values()) >= 1
    for t, (s, i, slot) in enumerate(mixing.one_period(slots)):
        assert slot == t and i * period // slots[s] <= t < -(-(i + 1) * period // slots[s])
        got[s] += 1
        if len(slots) < 50:
            assert all(abs(got[x] - (t + 1) * slots[x] / period) < 1 for x in slots)
    assert got == slots


def test_schedule_against_brute_force(docs_of):
    rows = [(i, "t" * (i * 37 % 900), "en", "abc"[i % 3] if i % 4 else "a") for i in range(400)]
    found = mixing.schedule(docs_of(rows), {"a": 5, "b": 3, "c": 1}, block_bytes=1000).collect()
    slots = mixing.slots_per_period({"a": 5, "b": 3, "c": 1})
    period, place = sum(slots.values()), {(s, i): t for s, i, t in mixing.one_period(slots)}
    size, want = collections.Counter(), []
    for i, t, _, s in sorted(rows, key=lambda r: (r[3], r[0])):
        block = size[s] // 1000
        size[s] += len(t)
        want.append((block // slots[s] * period + place[s, block % slots[s]], s, i))
    assert [(r["slot"], r["source"], r["doc_id"]) for r in sorted(found, key=lambda r: r["position"])] == sorted(want)
    assert sorted(r["position"] for r in found) == list(range(400))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in found)


@pytest.mark.parametrize("weights", [{f"s{i}": (i + 1) ** 0.5 for i in range(17)}, {"small": 0.0003, "a": 1, "b": 2 ** 0.5}])
def test_shares_follow_the_weights_over_many_periods(weights):
    total, got = sum(weights.values()), collections.Counter()
    blocks = {s: int(30_000 * w / total) for s, w in weights.items()}  # all are used up after about 30,000 slots
    slots = mixing.fitting_slots(weights, blocks)
    for s, i, slot in mixing.dealt(slots, blocks):
        got[s] += 1
        assert i == got[s] - 1 and -1.13 < i - weights[s] / total * slot and i + 1 - weights[s] / total * (slot + 1) < 1.13
    assert +got == {s: n for s, n in blocks.items() if n}


def test_many_sources_and_a_long_schedule(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 4000)
    found = mixing.schedule(docs_of([(i, "x", "en", f"s{i}") for i in range(10_001)])).collect()
    assert sorted(r["position"] for r in found) == list(range(10_001))
    assert len({r["slot"] for r in found}) == 10_001 and all(r["release"] <= r["slot"] < r["deadline"] for r in found)


def test_schedule_of_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows).withColumns({"size": F.lit(1), "part": F.lit(2), "slot": F.lit(3), "block": F.lit(4), "n": F.lit(5)})
    found = mixing.schedule(docs, {"a": 1, "b": 2}).collect()
    assert len(found) == len(odd_rows) and sorted(r["position"] for r in found) == list(range(len(odd_rows)))
    assert all((r["slot"] is None) == (r["source"] not in ("a", "b")) for r in found)
    assert max(r["position"] for r in found if r["slot"] is not None) < min(r["position"] for r in found if r["slot"] is None)
    ordered = mixing.in_mixed_order(docs)
    assert ordered.columns == docs.columns and ordered.count() == len(odd_rows)
    assert mixing.schedule(docs.limit(0)).count() == 0 and mixing.in_mixed_order(docs.limit(0)).count() == 0


def test_native_plans_run_no_python(docs_of):
    docs = docs_of([(1, "a b c d e f", "en", "h"), (2, "x", "fr", "i")])
    for df in (rules.verdicts(docs), mixing.schedule(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
