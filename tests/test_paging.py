import pytest
from pyspark.sql import functions as F

from lamina.operators import paging


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1000).select((F.col("id") * 7919 % 10007).alias("key"), F.col("id").alias("v")).repartition(7)


def brute_force(table):
    return [r.key for r in sorted(table.collect(), key=lambda r: r.key)]


def test_row_index_is_the_rank(table):
    indexed = paging.with_row_index(table, ["key"], start=1)
    assert indexed.columns == ["key", "v", "row_index"]
    assert [r.key for r in sorted(indexed.collect(), key=lambda r: r.row_index)] == brute_force(table)
    assert sorted(r.row_index for r in indexed.collect()) == list(range(1, 1001))


def test_row_index_of_text_and_mixed_keys(spark):
    df = spark.createDataFrame([(k, n) for n, k in enumerate(["b", "a", None, "c", "a"])], "k string, n int")
    indexed = paging.with_row_index(df, ["k", "n"])
    assert [(r.k, r.n) for r in indexed.orderBy("row_index").collect()] == [(None, 2), ("a", 1), ("a", 4), ("b", 0), ("c", 3)]


def test_equal_rows_get_different_numbers(spark):
    df = spark.range(50).select(F.lit("x").alias("k"))
    assert sorted(r.row_index for r in paging.with_row_index(df, ["k"]).collect()) == list(range(50))


def test_empty_table(spark, table):
    assert paging.with_row_index(table.limit(0), ["key"]).isEmpty()
    assert paging.page_index(paging.paginate(table.limit(0), "key", 10), "key").isEmpty()


def test_no_window_over_the_whole_table(table):
    plan = paging.with_row_index(table, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    # The only window runs over the counts per partition.
    assert plan.count("Window ") == 1 and "Aggregate" in plan[plan.index("Window "):]


def test_pages(table):
    ordered = brute_force(table)
    paged = paging.paginate(table, "key", 300)
    assert {r.key: r.page for r in paged.collect()} == {k: i // 300 for i, k in enumerate(ordered)}
    index = {r.page: (r.first_key, r.last_key, r.page_rows) for r in paging.page_index(paged, "key").collect()}
    assert index == {
        p: (ordered[p * 300], ordered[min(p * 300 + 299, 999)], min(300, 1000 - p * 300)) for p in range(4)
    }


def test_keyset_pages_cover_the_table(table):
    seen, last = [], None
    while True:
        page = [r.key for r in paging.read_after(table, "key", last, 300).collect()]
        seen += page
        if len(page) < 300:
            break
        last = page[-1]
    assert seen == brute_force(table)


def test_keyset_walk_has_the_short_last_page_and_no_top_k(table):
    pages = list(paging.keyset_walk(table, "key", 300))
    assert [page for page, _ in pages] == [0, 1, 2, 3]
    assert [r.key for _, rows in pages for r in rows.orderBy("key").collect()] == brute_force(table)
    assert pages[-1][1].count() == 100
    assert all("TakeOrdered" not in rows._jdf.queryExecution().executedPlan().toString() for _, rows in pages)


@pytest.mark.parametrize("limit, count", [(0, 0), (10, 10), (5000, 1000), (None, 1000)])
def test_row_cap(table, limit, count):
    capped = paging.row_cap(table, "key", limit)
    assert capped.count() == count
    if limit == 10:
        assert sorted(r.key for r in capped.collect()) == brute_force(table)[:10]


def test_page_size():
    assert paging.page_size() == 50_000
    assert paging.page_size(80_000) == 80_000
    assert paging.page_size(1000, 30) == 30


@pytest.mark.parametrize("keys", [["a"], ["a", "b"], ["c"], ["d", "a"]])
def test_rows_of_all_pages_in_one_pass(spark, keys):
    made = spark.range(900).selectExpr("CASE WHEN id % 7 > 0 THEN CAST(id % 41 AS DOUBLE) / 3 END a", "CASE id % 3 WHEN 0 THEN 'é' WHEN 1 THEN '\"\\\\' END b",
        "timestamp_micros(1600000000000001 + id % 50) c", "CASE WHEN id % 5 = 0 THEN CAST('NaN' AS FLOAT) ELSE CAST(id % 4 AS FLOAT) / 7 END d", "id")
    walk = paging.keyset_walk(made, keys, 40)
    want = {r.id: page for page, rows in walk for r in rows.select("id").collect()}
    whole = walk.rows("p")
    assert {r.id: r.p for r in whole.collect()} == want and len(want) == 900 and len(set(want.values())) > 5
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange" not in plan and plan.count("Range (") == 1  # however many pages there are


def test_rows_of_all_pages_of_an_empty_table(spark):
    assert paging.keyset_walk(spark.range(0), "id", 10).rows().collect() == []
