"""One key, document or dataset holds a third of all rows and more; results against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import cleaning, documents, kpis, paging, quality, runlog
from lamina.sources import manifest

ROWS = 30_000


@pytest.fixture(scope="module")
def data():
    draw = random.Random(11)
    return [(n, "hot" if n % 3 == 0 else f"k{draw.randrange(500)}", draw.randrange(1000), str(draw.randrange(10**6))) for n in range(ROWS)]


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, "n int, k string, v int, s string").repartition(8)


def test_deduplicate(table, data):
    smallest = {}
    for n, k, v, s in data:
        smallest[k] = min(smallest.get(k, (v, s, n)), (v, s, n))
    found = cleaning.deduplicate(table.select("k", "v", "s", "n"), ["k"]).collect()
    assert {r.k: (r.v, r.s, r.n) for r in found} == smallest


def test_tasks_send_one_row_per_group(spark, table):
    """What is shuffled is bounded by groups times tasks, not by rows."""
    for operator in (
        lambda t: cleaning.deduplicate(t, ["k"]),
        lambda t: kpis.daily(t.selectExpr("k AS state", "date'2021-01-04' AS end_date", "v AS new_cases", "v AS tot_cases", "v AS new_deaths", "v AS tot_deaths")),
        lambda t: manifest.structured_files(t.selectExpr("k AS dataset_key", "n AS position", "'csv' AS format")),
        lambda t: quality.validate(t, "d", [(fixed.BETWEEN, {"column": "v", "min_value": 0})]),
    ):
        plan = operator(table)._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan


def test_daily(table, data):
    sums, tops = defaultdict(int), defaultdict(int)
    for _, k, v, _ in data:
        sums[k] += v
        tops[k] = max(tops[k], v)
    out = kpis.daily(table.selectExpr(
        "k AS state", "CAST(NULL AS date) AS end_date", "CAST(v AS string) AS new_cases", "v AS tot_cases", "0 AS new_deaths", "0 AS tot_deaths"
    ))
    assert {r.state: (r.new_cases, r.cumulative_cases) for r in out.collect()} == {k: (float(sums[k]), float(tops[k])) for k in sums}


def test_manifest(table, data):
    formats = ["json", "csv", "txt", "pdf"]
    chosen = {}
    for n, k, v, _ in sorted(data):
        f = formats[v % 4]
        if f != "pdf" and (k not in chosen or (chosen[k][1], f) == ("json", "csv")):
            chosen[k] = (n, f)
    files = table.select("n", "k", F.element_at(F.array(*map(F.lit, formats)), F.col("v") % 4 + 1).alias("format"))
    found = manifest.structured_files(files.withColumnsRenamed({"n": "position", "k": "dataset_key"})).collect()
    assert {r.dataset_key: (r.position, r.format) for r in found} == chosen


def test_a_document_with_a_third_of_all_pages(table, data):
    pages = defaultdict(list)
    for n, k, _, s in data:
        pages[k].append((n, s))
    records = documents.page_records(table.selectExpr("k AS source_file", "n + 1 AS page_number", "s AS text"))
    found = {r.source_file: (r.total_pages, r.total_characters, r.full_text) for r in documents.document_text(records, 10_000).collect()}
    assert found == {
        k: (len(p), sum(len(s) for _, s in p), "\n\n".join(s for _, s in sorted(p))[:10_000]) for k, p in pages.items()
    }


def test_pages_with_a_hot_first_key(table, data):
    order = {n: i for i, (_, n) in enumerate(sorted((k, n) for n, k, _, _ in data))}
    found = paging.with_row_index(table.select("k", "n"), ["k", "n"]).collect()
    assert {r.n: r.row_index for r in found} == order


def test_run_log(table, data):
    log = table.selectExpr("k AS layer", "'j' AS job_name", f"'{runlog.DURATION}' AS metric", "CAST(v AS double) AS value")
    found = {(r.layer, r.le): r.jobs for r in runlog.duration_histogram(log).collect()}
    assert found["hot", "30"] == sum(k == "hot" and v <= 30 for _, k, v, _ in data)
    assert found["hot", "+Inf"] == sum(k == "hot" for _, k, _, _ in data)
