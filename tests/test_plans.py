"""What reaches the scan, and what is shuffled."""

import pytest
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import kpis, paging, runlog, serving, views
from lamina.operators.cleaning import clean
from lamina.sources import manifest

RAW = "rec_id long, start_date string, end_date string, state string, new_cases string, tot_cases string, new_deaths string, tot_deaths string, unused string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans"))
    rows = [(n, "2021-01-04", "2021-01-10", "CA", str(n), "9", "1", "2", "x" * 50) for n in range(100)]
    raw = spark.createDataFrame(rows, RAW)
    raw.write.parquet(path + "/raw")
    clean(raw, fixed.CASES).write.parquet(path + "/silver")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    return [line.split("ReadSchema: struct<")[1].split(">")[0] for line in plan(df).split("\n") if "ReadSchema" in line]


@pytest.fixture(scope="module")
def silver(spark, stored):
    return spark.read.parquet(stored + "/silver")


def test_keyset_filter_reaches_the_scan(spark, stored):
    page = paging.read_after(spark.read.parquet(stored + "/raw").select("rec_id"), "rec_id", 40, 10)
    assert "GreaterThan(rec_id,40)" in plan(page)
    assert read_columns(page) == ["rec_id:bigint"]
    assert "TakeOrderedAndProject" in plan(page)


def test_indicators_read_only_their_columns(silver):
    cases = kpis.cases_per_day(kpis.daily(silver))
    assert read_columns(cases) == ["new_cases:double,tot_cases:double,state_normalized:string,end_date_parsed:date"]
    assert plan(cases).count("Exchange") == 1


def test_unused_parts_of_the_dashboard_are_not_computed(silver):
    vaccinations = silver.selectExpr("state AS location", "end_date_parsed AS date", "new_cases AS administered", "new_deaths AS series_complete_yes")
    top = serving.top_states(views.dashboard_from_daily(kpis.daily(silver), kpis.vaccination_daily(vaccinations)))
    # Neither the vaccinations nor a sort of the whole view are needed for the totals.
    assert plan(top).count("FileScan") == 1
    assert "Join" not in plan(top) and "rangepartitioning" not in plan(top)


def test_long_form_takes_one_scan(silver):
    trends = views.temporal_trends(kpis.temporal_evolution(kpis.daily(silver)))
    assert plan(trends).count("FileScan") == 1


def test_cleaning_shuffles_once(spark, stored):
    assert plan(clean(spark.read.parquet(stored + "/raw"), fixed.CASES)).count("Exchange") == 1


def test_no_operator_crosses_or_gathers(silver):
    operators = [
        serving.summary_from_daily(kpis.daily(silver), kpis.empty(silver.sparkSession, "kpi_vaccination_vs_cases")),
        manifest.structured_files(silver.selectExpr("state AS dataset_key", "rec_id AS position", "'csv' AS format")),
        runlog.duration_histogram(silver.selectExpr("state AS layer", "state AS job_name", "'job_duration' AS metric", "new_cases AS value")),
        kpis.vaccination_vs_cases(kpis.vaccination_daily(silver.selectExpr("state AS location", "end_date AS date", "new_cases AS administered", "new_cases AS series_complete_yes")), kpis.daily(silver)),
    ]
    for df in operators:
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_histogram_does_not_multiply_the_log(silver):
    histogram = runlog.duration_histogram(silver.selectExpr("state AS layer", "state AS job_name", "'job_duration' AS metric", "new_cases AS value"))
    text = plan(histogram)
    # The bounds become rows after the aggregation, so higher up in the plan.
    assert text.index("Expand") < text.index("HashAggregate")


def test_filters_of_views_reach_the_scan(silver):
    trend = serving.metric_trend(views.temporal_trends(kpis.temporal_evolution(kpis.daily(silver))), "California", "new_cases")
    assert "EqualTo(state_normalized,California)" in plan(trend)
    assert trend.filter(F.col("report_date").isNotNull()).count() >= 0
