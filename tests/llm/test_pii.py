import random
import re

import pytest
from pyspark.sql import functions as F

from lamina.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == 1:
        return max(map(int, value.split("."))) <= 255
    if kind == 2:
        doubled = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(k, m.group()))


def test_base_spans_against_brute_force(docs_of):
    draw = random.Random(5)
    parts = ["a", "B", "9", "12", ".", "@", "+", "-", " ", "(", ")", "%", "_", "é", "😀", "1.2.3.4", "4111111111111111", "\n", "a@b.c", "+1 ("]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))) for i in range(800)]
    found = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in pii.found_spans(docs_of(rows)).select("doc_id", F.array_sort(F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["stop"]))).alias("base")).collect()}
    assert found == {i: brute(t) for i, t in rows}


def test_odd_and_long_rows(docs_of, odd_rows):
    rows = [*odd_rows, (30, "a" * 200_000, None, None), (31, "1" * 100_000, None, None), (32, "a." * 30_000 + "@" + "b." * 30_000 + "c", None, None), (33, "+" + "1(" * 30_000, None, None)]
    docs = docs_of(rows).withColumns({"rid": F.lit(1), "base": F.lit(2), "kind": F.lit(3)})
    found = pii.find(docs.select("doc_id", "text")).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in found}
    assert by[32] == [(0, 0, 120_002)] and by[30] == by[31] == []
    assert pii.find(docs.limit(0)).count() == 0


def corpus():
    draw = random.Random(3)
    rows = []
    for i in range(400):
        secret = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        other = "".join(draw.choice("ghijklmnop") for _ in range(30)) + "7"
        bad = str(draw.randrange(10**15, 10**16))
        rows.append((i, f'text u{i}@mail.example.com and token = "{secret}" then {other} or +1 ({i % 900 + 100}) 555-{i % 9000 + 1000:04d} at 10.0.{i % 250}.7, number {bad} here'))
    return rows


def test_trees_add_secrets_and_keep_the_base(docs_of):
    rows = corpus()
    found = pii.find(docs_of(rows)).collect()
    texts = dict(rows)
    secrets = others = 0
    for r in found:
        base, spans = [tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]
        assert base == brute(texts[r["doc_id"]]) and set(base) <= set(spans) and spans == sorted(spans)
        more = [s for s in spans if s not in base]
        assert all(a[0] >= b[2] or b[0] >= a[2] for a in more for b in spans if a != b)
        values = [texts[r["doc_id"]][a:b] for a, _, b in more]
        secrets += sum(bool(re.fullmatch("[0-9a-f]{40}", v)) for v in values)
        others += sum(not re.fullmatch("[0-9a-f]{40}", v) for v in values)
    assert secrets >= 0.95 * len(rows) and others <= 0.1 * len(rows)


def test_few_examples_and_long_values(docs_of):
    draw = random.Random(8)
    for n, length in ((20, 40), (200, 300)):
        rows = [(i, 'api_key = "' + "".join(draw.choice("0123456789") + draw.choice("abcdef") for _ in range(length // 2)) + '" ends') for i in range(n)]
        found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(docs_of(rows)).collect()}
        assert found == {i: [(11, 4, 11 + length)] for i in range(n)}
    local, name = "a" * 90, "b" * 80
    found = pii.find(docs_of([(1, f"x {local} at {name} dot com y"), (2, "4111.1111.1111.1111 or 4111.1111.1111.1112")])).collect()
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found} == {1: [(2, 0, 2 + 90 + 4 + 80 + 8)], 2: [(0, 2, 19)]}


def test_redaction(docs_of):
    rows = {r["doc_id"]: r["text"] for r in pii.redact(docs_of([(1, "mail x@y.zz and +1 (555) 123-4567!"), (2, None), (3, "😀 1.2.3.4")])).collect()}
    assert rows == {1: "mail [EMAIL] and [PHONE]!", 2: None, 3: "😀 [IP]"}


def test_native_plan(docs_of):
    plan = pii.find(docs_of(corpus()[:100]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_all_examples_count(spark, monkeypatch):
    class Done(Exception):
        pass

    def fit(_self, rows):
        raise Done(rows.count())

    monkeypatch.setattr(pii.GBTClassifier, "fit", fit)
    features = [f"CAST(id % 3 AS DOUBLE) AS {f}" for f in pii.FEATURES if f != "kind"]
    found = spark.range(45_000).selectExpr("id AS rid", "CAST(4 AS DOUBLE) AS kind", "0 AS start", "9 AS stop", "false AS is_base", *features, "CAST(id % 2 AS DOUBLE) AS label")
    with pytest.raises(Done) as told:
        pii.select_spans(found)
    assert 29_000 < told.value.args[0] < 31_000  # two thirds of all
