import random

import pytest
from pyspark.sql import functions as F

from lamina.operators import documents

PAGES = "source_file string, page_number int, text string"


def text_of(pages, limit=10_000):
    """The expected rows, by plain Python."""
    docs = {}
    for doc, number, text in pages:
        docs.setdefault(doc, []).append((number, text or ""))
    return {
        doc: (len(found), sum(len(t) for _, t in found), "\n\n".join(t for _, t in sorted(found))[:limit])
        for doc, found in docs.items()
    }


def result(spark, pages, limit=10_000):
    records = documents.page_records(spark.createDataFrame(pages, PAGES))
    return {
        r.source_file: (r.total_pages, r.total_characters, r.full_text)
        for r in documents.document_text(records, limit).collect()
    }


def test_example(spark):
    assert result(spark, [("d", 1, "ab"), ("d", 2, None), ("d", 3, "c")]) == {"d": (3, 3, "ab\n\n\n\nc")}


def test_page_records(spark):
    out = documents.page_records(spark.createDataFrame([("d", 1, "é\U0001F600"), ("d", 2, None), ("d", 6, "x")], PAGES), 5)
    assert [tuple(r) for r in out.orderBy("page_number").collect()] == [("d", 1, "é\U0001F600", 2), ("d", 2, "", 0)]


@pytest.mark.parametrize("limit", [7, 10_000, None])
def test_blocks_of_pages_with_gaps(spark, monkeypatch, limit):
    monkeypatch.setattr(documents, "BLOCK", 4)
    draw = random.Random(5)
    pages = [
        (f"d{d}", n, draw.choice(["", None, "a" * draw.randrange(20), "été"]))
        for d in range(4) for n in sorted(draw.sample(range(1, 300), 60))
    ]
    draw.shuffle(pages)
    assert result(spark, pages, limit) == text_of(pages, limit)


def test_more_pages_than_one_block(spark):
    pages = [("long", n, f"p{n}") for n in range(1, 2500)] + [("short", 1, "x" * 20_000)]
    assert result(spark, pages) == text_of(pages)


def test_the_whole_text_is_the_default(spark):
    row = documents.document_text(documents.page_records(spark.createDataFrame([("d", 1, "x" * 12_000)], PAGES))).first()
    assert (len(row.full_text), len(row.text_preview)) == (12_000, 500)


def test_preview_and_limits(spark):
    row = documents.document_text(documents.page_records(spark.createDataFrame([("d", 1, "x" * 12_000)], PAGES)), 10_000).first()
    assert (len(row.full_text), len(row.text_preview), row.total_characters) == (10_000, 500, 12_000)


@pytest.mark.parametrize("copies", [2, 2000])
def test_of_repeated_page_numbers_the_smallest_text_counts(spark, copies):
    pages = spark.range(copies).select(F.lit("d").alias("source_file"), F.lit(1).alias("page_number"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("text"))
    row = documents.document_text(documents.page_records(pages)).first()
    assert (row.total_pages, row.total_characters, row.full_text) == (1, 2, "x0")


def test_one_shuffle_and_no_job_while_it_is_built(spark):
    pages = spark.createDataFrame([("d", 1, "a")], PAGES)
    plan = documents.document_text(documents.page_records(pages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_documents(spark):
    assert result(spark, []) == {}


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "good.pdf").write_text("one\ftwo")
    (tmp_path / "bad.pdf").write_text("broken")

    def decoder(content):
        text = content.decode()
        if "\f" not in text:
            raise ValueError("no pages")
        return text.split("\f")

    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "good.pdf").write_text("three\f")
    (tmp_path / "notes.txt").write_text("no document")

    decoded = documents.decode_documents(spark, str(tmp_path), decoder, "*.pdf")
    base = f"file:{tmp_path}"
    assert [tuple(r) for r in decoded.filter("error IS NOT NULL").collect()] == [(f"{base}/bad.pdf", None, None, "no pages")]
    pages = documents.decoded_pages(decoded)
    assert sorted(tuple(r) for r in pages.collect()) == [
        (f"{base}/good.pdf", 1, "one"), (f"{base}/good.pdf", 2, "two"), (f"{base}/other/good.pdf", 1, "three"), (f"{base}/other/good.pdf", 2, ""),
    ]


def test_a_long_document_is_shared_among_tasks(spark):
    pages = spark.range(5000).selectExpr("'d' AS source_file", "CAST(IF(id = 7, NULL, id * 3) AS INT) AS page_number", "CONCAT('p', id) AS text")
    found = documents.document_text(documents.page_records(pages), 100)
    row = found.collect()[0]
    want = "\n\n".join(["p7", *[f"p{i}" for i in range(5000) if i != 7]])
    assert (row.total_pages, row.total_characters) == (5000, sum(len(f"p{i}") for i in range(5000)))
    assert row.full_text in (want[:100], want.replace("p7\n\n", "", 1)[:100])
    dealt = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "REPARTITION" in x]
    assert dealt and all("block" in x for x in dealt)  # not by document alone
