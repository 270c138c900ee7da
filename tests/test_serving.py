import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lamina.operators import serving

D1, D2, D3 = date(2021, 1, 4), date(2021, 1, 11), date(2021, 1, 18)
VACC = "state string, report_date date, doses_administered double, fully_vaccinated double, new_cases double, vaccination_rate double"


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(
        [(D1, "CA", 10.0, 100.0), (D2, "CA", 5.0, 110.0), (D1, "TX", 15.0, 50.0), (None, "NY", 1.0, 1.0)],
        "report_date date, state string, new_cases double, cumulative_cases double",
    )


@pytest.fixture(scope="module")
def deaths(spark):
    return spark.createDataFrame(
        [(D1, "CA", 1.0, 1.0), (date(2021, 1, 10), "CA", 2.0, 3.0), (D2, "TX", 4.0, 4.0)],
        "report_date date, state string, new_deaths double, cumulative_deaths double",
    )


def vaccination(spark, *extra):
    return spark.createDataFrame([
        ("CA", D1, 10.0, 5.0, 0.0, 50.0), ("CA", D2, 20.0, 8.0, 0.0, 40.0), ("TX", D1, 7.0, 1.0, 0.0, 10.0),
        ("usa", D3, 900.0, 1.0, 0.0, 0.0), *extra,
    ], VACC)


def test_summary_prefers_the_national_row(spark, cases, deaths):
    table = vaccination(spark, ("us", D1, 100.0, 50.0, 0.0, 50.0), ("United States", D2, 200.0, 60.0, 0.0, 30.0))
    row = serving.summary(cases, deaths, table).first()
    assert row.asDict() == {
        "total_new_cases": 31.0, "states_count": 3, "latest_report_date": D2, "total_new_deaths": 7.0,
        "total_doses": 200.0, "total_fully_vaccinated": 60.0, "vaccination_snapshot_date": D2,
    }


def test_summary_falls_back_to_the_latest_rows_per_state(spark, cases, deaths):
    # "USA" is neither the national row nor one of the states.
    row = serving.summary(cases, deaths, vaccination(spark)).first()
    assert (row.total_doses, row.total_fully_vaccinated, row.vaccination_snapshot_date) == (27.0, 9.0, D2)


def test_summary_of_empty_tables(spark, cases, deaths):
    row = serving.summary(cases.limit(0), deaths.limit(0), vaccination(spark).limit(0)).first()
    assert (row.total_new_cases, row.states_count, row.total_new_deaths, row.total_doses) == (0.0, 0, 0.0, None)


def test_summary_from_the_daily_aggregate(spark, cases, deaths):
    daily = cases.join(deaths.drop("state"), "report_date", "left")
    split = serving.summary(daily, daily, vaccination(spark)).first()
    assert serving.summary_from_daily(daily, vaccination(spark)).first().asDict() == split.asDict()


def test_latest_rows_keep_ties(spark, rows):
    table = vaccination(spark, ("TX", D1, 3.0, 2.0, 0.0, 0.0), ("NY", None, 4.0, 4.0, 0.0, 0.0))
    assert rows(serving.latest_per_state(table), "state", "doses_administered") == [("CA", 20.0), ("TX", 3.0), ("TX", 7.0)]
    assert serving.vaccination_totals(table).first().total_doses == 30.0


def test_null_dates_come_first_in_the_national_snapshot(spark):
    table = vaccination(spark, ("US", None, 1.0, 1.0, 0.0, 0.0), ("US", D3, 2.0, 2.0, 0.0, 0.0))
    assert serving.national_snapshot(table).first().total_doses == 1.0
    assert tuple(serving.vaccination_totals(table).first()) == tuple(serving.national_snapshot(table).first())


def test_top_states_break_ties_by_name(spark):
    table = spark.createDataFrame([("B", 5.0, 1.0), ("A", 5.0, 2.0), ("C", 9.0, None)], "state string, new_cases double, new_deaths double")
    assert [tuple(r) for r in serving.top_states(table, 2).collect()] == [("C", 9.0, None), ("A", 5.0, 2.0)]


@pytest.mark.parametrize("call", [
    lambda t: serving.top_states(t, 0), lambda t: serving.top_states(t, 51),
    lambda t: serving.regional_top(t, 101), lambda t: serving.dashboard_latest(t, 501),
])
def test_limits_are_checked(spark, cases, call):
    with pytest.raises(ValueError):
        call(cases)


def test_timeline(spark, cases, deaths):
    assert [tuple(r) for r in serving.timeline("cases", cases, deaths).collect()] == [(D1, 25.0), (D2, 5.0), (None, 1.0)]
    assert serving.timeline("deaths", cases, deaths).count() == 3
    with pytest.raises(ValueError):
        serving.timeline("tests", cases, deaths)


def test_weeks_start_on_monday(spark, deaths):
    assert [tuple(r) for r in serving.weekly_deaths(deaths).collect()] == [(D1, 3.0), (D2, 4.0)]


def test_trailing_days(spark, cases):
    out = serving.trailing(cases, F.lit(date(2021, 2, 5)), 30)
    assert [r.report_date for r in out.collect()] == [D2]


def test_recent_rows_then_top(spark, cases):
    assert [tuple(r) for r in serving.recent_top_states(cases, 3, 2).collect()] == [("CA", 15.0), ("NY", 1.0)]


def test_rate_by_state(spark):
    out = serving.rate_by_state(vaccination(spark)).first()
    assert (out.state, out.avg_vaccination_rate) == ("CA", 45.0)


def test_query_takes_parameters(spark, cases):
    cases.createOrReplaceTempView("cases_for_query")
    out = serving.query(spark, "SELECT * FROM cases_for_query WHERE state = :state AND new_cases > :low", {"state": "CA", "low": 6})
    assert [r.new_cases for r in out.collect()] == [10.0]


def test_records(spark):
    df = spark.createDataFrame([(D1, float("nan"), None, "x"), (None, 1.5, 2, "y")], "d date, v double, n int, s string")
    assert [json.loads(r.record) for r in serving.records(df).collect()] == [
        {"d": "2021-01-04", "v": None, "n": None, "s": "x"}, {"d": None, "v": 1.5, "n": 2, "s": "y"},
    ]
