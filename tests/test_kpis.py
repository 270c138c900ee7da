from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import kpis, views

D1, D2, D3 = date(2021, 1, 4), date(2021, 1, 11), date(2021, 1, 18)
CASES = "state_normalized string, end_date_parsed date, new_cases double, tot_cases double, new_deaths double, tot_deaths double"
VACC = "location_normalized string, date_parsed date, administered string, series_complete_yes string"


def cases(spark):
    return spark.createDataFrame([
        ("CA", D1, 10.0, 100.0, 1.0, 10.0), ("CA", D1, 5.0, 90.0, None, 9.0), ("CA", D2, 4.0, 110.0, 2.0, 12.0),
        ("TX", D1, 0.0, 0.0, 0.0, 0.0), ("TX", None, 3.0, 7.0, 1.0, 1.0),
    ], CASES)


def vaccinations(spark):
    return spark.createDataFrame([
        ("CA", D1, "100", "50"), ("CA", D1, "80", "60"), ("CA", D3, "Unknown", "5"), ("TX", None, "9", "3"),
    ], VACC)


def test_daily_indicators(spark, rows):
    daily = kpis.daily(cases(spark))
    assert rows(kpis.cases_per_day(daily)) == [
        (None, "TX", 3.0, 7.0), (D1, "CA", 15.0, 100.0), (D1, "TX", 0.0, 0.0), (D2, "CA", 4.0, 110.0),
    ]
    assert rows(kpis.deaths_per_day(daily)) == [
        (None, "TX", 1.0, 1.0), (D1, "CA", 1.0, 10.0), (D1, "TX", 0.0, 0.0), (D2, "CA", 2.0, 12.0),
    ]
    assert rows(kpis.hospitalizations_by_region(daily), "state", "report_date", "hospitalized", "icu_patients")[1] == ("CA", D2, 0.2, 0.04)


def test_incidence(spark):
    found = {r.state: r for r in kpis.incidence_by_region(kpis.daily(cases(spark))).collect()}
    ca = found["CA"]
    assert (ca.region, ca.total_cases, ca.total_deaths, ca.report_date) == ("CA", 300.0, 31.0, D2)
    assert ca.incidence_rate == ca.mortality_rate == 31.0 / 300.0 * 100
    assert found["TX"].report_date == D1


def test_vaccination_outer_join(spark, rows):
    out = kpis.vaccination_vs_cases(kpis.vaccination_daily(vaccinations(spark)), kpis.daily(cases(spark)))
    # The null dates of both sides do not match each other.
    assert rows(out) == sorted([
        ("CA", D1, 100.0, 60.0, 15.0, 60.0), ("CA", D2, 0.0, 0.0, 4.0, 0.0), ("CA", D3, 0.0, 5.0, 0.0, 0.0),
        ("TX", D1, 0.0, 0.0, 0.0, 0.0), ("TX", None, 0.0, 0.0, 3.0, 0.0), ("TX", None, 9.0, 3.0, 0.0, 3.0 / 9.0 * 100),
    ], key=lambda r: [(v is not None, str(v)) for v in r])


def test_join_adds_no_shuffle_to_the_aggregations(spark):
    # Planned without broadcast, as large inputs are.
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = kpis.vaccination_vs_cases(kpis.vaccination_daily(vaccinations(spark)), kpis.daily(cases(spark)))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        both = views.dashboard_from_daily(kpis.daily(cases(spark)), kpis.vaccination_daily(vaccinations(spark)))
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_temporal_evolution_has_both_metrics(spark):
    daily = kpis.daily(cases(spark))
    long = kpis.temporal_evolution(daily)
    assert long.count() == kpis.cases_per_day(daily).count() + kpis.deaths_per_day(daily).count()
    assert long.columns == ["state", "report_date", "metric_name", "metric_value"]


def test_missing_tables_give_typed_empty_indicators(spark):
    for table in fixed.GOLD_SCHEMAS:
        empty = kpis.empty(spark, table)
        assert empty.isEmpty() and empty.columns[-1] == "updated_at"
        assert set(empty.columns) == {c.strip().split(" ")[0] for c in fixed.WAREHOUSE_SCHEMAS[table].split(",")}


def test_built_columns_are_those_of_the_contract(spark):
    daily, vaccination = kpis.daily(cases(spark)), kpis.vaccination_daily(vaccinations(spark))
    built = {
        "kpi_incidence_by_region": kpis.incidence_by_region(daily),
        "kpi_cases_per_day": kpis.cases_per_day(daily),
        "kpi_deaths_per_day": kpis.deaths_per_day(daily),
        "kpi_hospitalizations_by_region": kpis.hospitalizations_by_region(daily),
        "kpi_vaccination_vs_cases": kpis.vaccination_vs_cases(vaccination, daily),
        "kpi_temporal_evolution_by_state": kpis.temporal_evolution(daily),
    }
    for table, df in built.items():
        assert kpis.stamped(df).dtypes == kpis.empty(spark, table).dtypes, table


def test_both_ways_to_the_dashboard_agree(spark, rows):
    daily, vaccination = kpis.daily(cases(spark)), kpis.vaccination_daily(vaccinations(spark))
    joined = views.dashboard(
        kpis.cases_per_day(daily), kpis.deaths_per_day(daily), kpis.vaccination_vs_cases(vaccination, daily)
    )
    direct = views.dashboard_from_daily(daily, vaccination)
    assert joined.columns == direct.columns
    assert rows(joined) == rows(direct)
    first = views.newest_first(direct).first()
    # Nulls come first in descending order, and a null date has matched nothing.
    assert (first.report_date, first.state, first.new_cases, first.new_deaths, first.vaccination_rate) == (None, "TX", 3.0, None, None)


def test_change_since_the_previous_value(spark):
    data = [("CA", d, "new_cases", v) for d, v in zip([D1, D2, D3], [5.0, 7.0, 4.0])] + [("CA", D1, "new_deaths", 1.0)]
    trends = views.temporal_trends(spark.createDataFrame(data, "state string, report_date date, metric_name string, metric_value double"))
    got = [(r.previous_value, r.change) for r in trends.filter("metric_name = 'new_cases'").orderBy("report_date").collect()]
    assert got == [(None, None), (5.0, 2.0), (7.0, -3.0)]


def test_regional_summary(spark):
    data = [("R", "A", 10.0, 1.0, 10.0, D1), ("R", "A", 20.0, 3.0, 20.0, D2), ("S", "B", 99.0, 0.0, 0.0, None)]
    out = views.most_cases_first(views.regional_summary(spark.createDataFrame(
        data, "region string, state string, total_cases double, total_deaths double, incidence_rate double, report_date date"
    ))).collect()
    assert [tuple(r) for r in out] == [("S", "B", 99.0, 0.0, 0.0, None), ("R", "A", 30.0, 4.0, 15.0, D2)]


states, dates = st.sampled_from(["CA", "TX", "US"]), st.sampled_from([D1, D2, D3, None])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(states, dates, st.integers(0, 50)), max_size=12),
    st.lists(st.tuples(states, dates, st.integers(0, 50)), max_size=12),
)
def test_outer_join_keeps_all_keys(spark, left, right):
    vaccination = spark.createDataFrame([(s, d, str(n), str(n)) for s, d, n in left], VACC)
    reports = spark.createDataFrame([(s, d, float(n), 0.0, 0.0, 0.0) for s, d, n in right], CASES)
    out = kpis.vaccination_vs_cases(kpis.vaccination_daily(vaccination), kpis.daily(reports))
    keys = {(r.state, r.report_date) for r in out.collect()}
    assert keys == {(s, d) for s, d, _ in left} | {(s, d) for s, d, _ in right}
    assert out.agg(F.coalesce(F.sum("new_cases"), F.lit(0.0))).first()[0] == sum(n for _, _, n in right)
