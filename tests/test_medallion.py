import json

import pytest
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import quality, runlog
from lamina.plans.medallion import STEPS, Medallion, Source
from lamina.sources.tables import Lake

CASE_ROWS = [
    (1, "2021-01-04", "2021-01-10", "CA", "100", "10", "5", "1"), (2, "2021-01-04", "2021-01-10", "ca", "100", "-4", "5", None),
    (3, "2021-01-11", "2021-01-17", "CA", "120", "20", "7", "2"), (4, "2021-01-11", "2021-01-17", "TX", "50", "x", "2", "1"),
    (5, "2021-01-11", "bad", "TX", "1", "1", "1", "1"), (6, "2021-01-04", "2021-01-10", "CA", "999", "999", "9", "9"),
]
CASES = "rec_id int, start_date string, end_date string, state string, tot_cases string, new_cases string, tot_deaths string, new_deaths string"
VACC_ROWS = [(1, "2021-01-10", "CA", "500", "200"), (2, "2021-01-10", "US", "9000", "4000"), (3, "2021-01-24", "NY", "70", "7")]
VACC = "rec_id int, date string, location string, administered string, series_complete_yes string"


def sources(spark):
    return {
        fixed.CASES: Source(spark.createDataFrame(CASE_ROWS, CASES), "rec_id"),
        fixed.VACCINATIONS: Source(spark.createDataFrame(VACC_ROWS, VACC), "rec_id"),
    }


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    job = Medallion(Lake(spark, str(tmp_path_factory.mktemp("lake"))), mode="sample", datasets=[fixed.CASES, fixed.VACCINATIONS])
    pages = spark.createDataFrame([("r.pdf", n, f"page {n}") for n in range(1, 9)], "source_file string, page_number int, text string")
    documents = [{"filename": "r.pdf", "format": "pdf", "file_size": 5, "local_path": "/x/r.pdf"}]
    return job, job.run(sources=sources(spark), more_files=documents, pages=pages)


def test_every_step_succeeds(finished):
    _, results = finished
    assert list(results) == STEPS
    assert {s: r["status"] for s, r in results.items()} == dict.fromkeys(STEPS, "success")
    assert results["extract"]["total_files"] == 5


def test_bronze_prefers_csv_and_logs_files(finished):
    job, results = finished
    assert results["bronze"]["loaded_datasets"] == sorted([fixed.CASES, fixed.VACCINATIONS])
    bronze = job.lake.read("bronze", fixed.CASES)
    assert {r._bronze_format for r in bronze.collect()} == {"csv"}
    assert {r.filename for r in job.lake.read("bronze", "document_registry").collect()} == {"r.pdf"}
    assert sorted(r.format for r in job.ingestion_log().collect()) == ["csv", "csv", "pdf"]


def test_silver_counts(finished):
    _, results = finished
    cases = next(r for r in results["silver"]["transformations"] if r["dataset"] == fixed.CASES)
    # Records 1 and 6 share their raw key; "CA" and "ca" do not.
    assert (cases["input_rows"], cases["output_rows"], cases["rejected_rows"]) == (6, 5, 1)


def test_documents_are_capped_in_sample_mode(finished):
    job, results = finished
    row = job.lake.read("silver", "document_text").first()
    assert (row.total_pages, row.full_text.split("\n\n")[-1]) == (5, "page 5")
    assert results["silver"]["transformations"][-1]["total_characters"] == 30


def test_gold_and_warehouse(finished, rows):
    job, results = finished
    day = job.lake.read("gold", "kpi_cases_per_day").filter("state = 'California'")
    assert rows(day, "report_date", "new_cases", "cumulative_cases")[0][1:] == (10.0, 100.0)
    tables = {r["table"]: (r["rows"], r["rejected"]) for r in results["warehouse"]["tables"]}
    assert tables["kpi_cases_per_day"] == (3, 1)
    assert tables["kpi_temporal_evolution_by_state"] == (6, 2)
    loaded = job.lake.read("warehouse", "kpi_cases_per_day")
    assert sorted(r.id for r in loaded.collect()) == [1, 2, 3]
    assert dict(loaded.dtypes)["new_cases"] == "bigint"
    assert job.lake.read("warehouse_rejects", "kpi_cases_per_day").first().reject_reason == "report_date: null"
    meta = job.lake.read("warehouse", "run_metadata").first()
    assert (meta.layer, meta.job_name, meta.records_processed, meta.status) == (
        "gold", "load_warehouse", results["warehouse"]["total_rows"], "success",
    )


def test_views_answer_sql(finished, spark):
    job, _ = finished
    job.register_views()
    top = spark.sql("SELECT state, sum(new_cases) AS c FROM v_kpi_dashboard GROUP BY state ORDER BY c DESC LIMIT 1").first()
    assert top.state == "California"
    assert spark.sql("SELECT * FROM v_temporal_trends WHERE state = 'California' AND change IS NOT NULL").count() == 2
    assert spark.sql("SELECT * FROM v_regional_summary").count() == 2


def test_report_and_run_log(finished, spark):
    job, results = finished
    report = spark.read.schema(quality.RESULT_SCHEMA).json(job.lake.path("quality", "report"))
    assert report.count() == results["quality"]["total_passed"] + results["quality"]["total_failed"] == 9
    log = job.log.read()
    assert log.filter(F.col("metric") == runlog.DURATION).count() == len(STEPS)
    assert {r.dataset for r in runlog.rows_inserted(log).filter("layer = 'silver'").collect()} >= {fixed.CASES}


def test_rerun_gives_the_same_tables(finished, spark):
    job, first = finished
    again = job.run(["bronze", "silver", "gold"])
    assert again["silver"]["total_output_rows"] == first["silver"]["total_output_rows"]
    assert [r["rows"] for r in again["gold"]["kpis"]] == [r["rows"] for r in first["gold"]["kpis"]]


def test_failing_members_make_a_step_partial(spark, tmp_path):
    job = Medallion(Lake(spark, str(tmp_path)), mode="full", datasets=[fixed.CASES, fixed.VACCINATIONS])
    bad = {**sources(spark), fixed.VACCINATIONS: Source(spark.range(1), "no_such_column")}
    bad[fixed.VACCINATIONS] = Source(spark.range(1).select(F.raise_error(F.lit("broken")).cast("string").alias("x")), "x")
    results = job.run(sources=bad)
    assert results["extract"]["status"] == "partial"
    # The failed extract has no dataset key, so it is not loaded; the other dataset goes on.
    assert results["bronze"]["loaded_datasets"] == [fixed.CASES]
    assert {r["dataset"]: r["status"] for r in results["silver"]["transformations"]} == {
        fixed.CASES: "success", fixed.VACCINATIONS: "error", "document_text": "no_pdf",
    }
    assert results["quality"]["status"] == "partial"
    rows = {r["table"]: r["rows"] for r in results["gold"]["kpis"]}
    assert rows["kpi_vaccination_vs_cases"] == 0 and rows["kpi_cases_per_day"] > 0


def test_missing_file_is_reported(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"files": [{"dataset_key": "x", "format": "csv", "local_path": str(tmp_path / "gone.csv")}]}))
    result = Medallion(Lake(spark, str(tmp_path / "lake"))).load_bronze(str(path))
    assert result["status"] == "partial" and "gone.csv" in result["errors"][0]


def test_single_json_file(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text('[{"a": 1}, {"a": 2}]')
    table = Medallion(Lake(spark, str(tmp_path / "lake"))).load_json(str(path), "one")
    row = table.first()
    assert (row._bronze_source, row._bronze_filename, row._bronze_format) == (f"local://{path}", "one.json", "json")


def test_documents_are_decoded_once_and_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_text("one|two")
    (tmp_path / "in" / "b.pdf").write_text("x")

    def decoder(content):
        pages = content.decode().split("|")
        if len(pages) < 2:
            raise ValueError("no pages")
        return pages

    job = Medallion(Lake(spark, str(tmp_path / "lake")), datasets=[])
    assert job.transform_documents()["status"] == "no_pdf"
    assert job.load_documents(str(tmp_path / "in"), decoder, "*.pdf") == {
        "status": "partial", "failed": 1, "errors_in": job.lake.path("bronze", "document_pages"),
    }
    assert job.transform_documents() == {
        "dataset": "document_text", "status": "success", "pdf_count": 1, "total_characters": 6,
    }
    assert job.lake.read("silver", "document_text").first().full_text == "one\n\ntwo"


def test_extracts_list_their_rows_and_bytes(finished, spark):
    job, results = finished
    listed = spark.read.schema(fixed.MANIFEST_SCHEMA).json(job.manifest_path).first()
    assert {(f.dataset_key, f.format): f.record_count for f in listed.files if f.format != "pdf"} == {
        (fixed.CASES, "json"): 6, (fixed.CASES, "csv"): 6, (fixed.VACCINATIONS, "json"): 3, (fixed.VACCINATIONS, "csv"): 3,
    }
    assert listed.total_size_bytes == results["extract"]["total_size_bytes"] > 0


def test_gate_and_arguments(spark, tmp_path):
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES])
    with pytest.raises(RuntimeError):
        job.run(["quality"], gate=True)
    assert runlog.errors(job.log.read()).first().errors == 1.0
    with pytest.raises(ValueError):
        job.run(["nonsense"])
    with pytest.raises(ValueError):
        Medallion(Lake(spark, str(tmp_path)), mode="huge")


def test_full_is_the_default_and_keeps_whole_texts(spark, tmp_path):
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[])
    assert job.mode == "full"
    pages = spark.createDataFrame([("d", n, "x" * 4000) for n in range(1, 9)], "source_file string, page_number int, text string")
    job.transform_documents(pages)
    assert len(job.lake.read("silver", "document_text").first().full_text) == 8 * 4000 + 7 * 2


def test_all_failed_documents_are_reported(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(120):
        (tmp_path / "in" / f"{n}.pdf").write_text("x")

    def decoder(content):
        raise ValueError("no pages")

    job = Medallion(Lake(spark, str(tmp_path / "lake")), datasets=[])
    found = job.load_documents(str(tmp_path / "in"), decoder)
    assert found["failed"] == 120 == spark.read.parquet(found["errors_in"]).filter("error IS NOT NULL").count()


def test_extract_without_sources_leaves_the_manifest(spark, tmp_path):
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES])
    job.extract(sources(spark))
    before = spark.read.text(job.manifest_path).collect()
    assert job.run(["extract"])["extract"]["status"] == "no_sources"
    assert spark.read.text(job.manifest_path).collect() == before


def test_a_missing_manifest_is_an_error(spark, tmp_path):
    found = Medallion(Lake(spark, str(tmp_path)), datasets=[]).load_bronze()
    assert (found["status"], found["loaded_datasets"], len(found["errors"])) == ("error", [], 1)


def test_unreadable_cases_leave_gold_as_it_was(spark, tmp_path, finished):
    done, _ = finished
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES])
    job.lake.overwrite(done.lake.read("silver", fixed.CASES), "silver", fixed.CASES)
    assert job.build_gold()["status"] == "partial"  # there are no vaccinations
    before = job.lake.count("gold", "kpi_cases_per_day")
    job.lake.read("silver", fixed.CASES).limit(0).write.mode("overwrite").partitionBy("state").parquet(job.lake.path("silver", fixed.CASES))
    assert job.build_gold()["status"] == "error"
    assert job.lake.count("gold", "kpi_cases_per_day") == before > 0


def test_steps_report_their_seconds(finished):
    assert all(r["duration_seconds"] > 0 for r in finished[1].values())
