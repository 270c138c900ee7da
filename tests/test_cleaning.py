from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.columns import columns_like, first_present, percent
from lamina.operators import cleaning


def strings(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


@pytest.mark.parametrize("given_value, expected", [
    ("CA", "California"), ("ca", "California"), ("California", "California"), ("US", "US"), ("XX", "XX"),
    (" ca", " ca"), (None, None), ("", ""),
    ("\ufb02", "Florida"),
])
def test_state_names(spark, given_value, expected):
    out = cleaning.standardize_states(strings(spark, [given_value], "state"))
    assert out.first()["state_normalized"] == expected


def test_all_state_codes(spark):
    out = cleaning.standardize_states(strings(spark, list(fixed.STATE_NAMES), "state"))
    assert {r.state: r.state_normalized for r in out.collect()} == fixed.STATE_NAMES
    assert len(fixed.STATE_NAMES) == 54


def test_state_column_alternatives(spark):
    location = strings(spark, ["NY"], "location").withColumn("jurisdiction", F.lit("TX"))
    assert "location_normalized" in cleaning.standardize_states(location).columns
    assert "jurisdiction_normalized" not in cleaning.standardize_states(location).columns
    geography = strings(spark, ["NY"], "geography")
    assert cleaning.standardize_states(geography).columns == ["geography"]


@pytest.mark.parametrize("text, expected", [
    ("2021-01-05T00:00:00.000", date(2021, 1, 5)), ("2021-01-05", date(2021, 1, 5)), ("01/05/2021", date(2021, 1, 5)),
    ("1/5/2021", date(2021, 1, 5)), ("2021-01-05junk", date(2021, 1, 5)), ("2021-01-05T10:00:00", date(2021, 1, 5)),
    ("2021-1-5", date(2021, 1, 5)), (" 2021-01-05", date(2021, 1, 5)), ("2021-01-05 10:00", date(2021, 1, 5)),
    ("2021-13-05", None), ("2021-02-30", None), ("bad", None), ("", None), (None, None), ("2021", None),
    ("2021-01", None), ("2021-01 ", None), ("13/05/2021", None),
])
def test_dates(spark, text, expected):
    assert cleaning.parse_dates(strings(spark, [text], "end_date")).first()["end_date_parsed"] == expected


def test_dates_of_other_types(spark):
    df = spark.createDataFrame([(date(2021, 1, 5), datetime(2021, 1, 5, 3), 20210105)], "a_date date, b_time timestamp, c_week int")
    row = cleaning.parse_dates(df).first()
    assert (row.a_date_parsed, row.b_time_parsed, row.c_week_parsed) == (date(2021, 1, 5), date(2021, 1, 5), None)


@pytest.mark.parametrize("text, expected", [
    ("5", 5.0), (" 5 ", 5.0), ("1e3", 1000.0), ("x", None), ("", None), (None, None), ("-2.5", -2.5),
])
def test_numbers(spark, text, expected):
    assert cleaning.cast_numbers(strings(spark, [text], "new_cases")).first()[0] == expected


def test_numeric_columns_are_found_by_any_fragment(spark):
    df = spark.createDataFrame([("a", "b", "c", date(2020, 1, 1))], "county string, administered string, TOTAL string, vaccin_day date")
    out = cleaning.cast_numbers(df)
    assert dict(out.dtypes) == {"county": "double", "administered": "string", "TOTAL": "double", "vaccin_day": "double"}
    assert out.first()["vaccin_day"] is None


def test_fill(spark):
    df = spark.createDataFrame(
        [(None, None, float("nan"), None, None, None)],
        "i int, d double, n double, s string, m decimal(10,2), t date",
    )
    assert tuple(cleaning.fill_nulls(df).first()) == (0, 0.0, 0.0, "Unknown", None, None)
    kept = spark.createDataFrame([(3, 1.5, 2.0, "x", Decimal("1.00"), date(2020, 1, 1))], df.schema)
    assert tuple(cleaning.fill_nulls(kept).first()) == (3, 1.5, 2.0, "x", Decimal("1.00"), date(2020, 1, 1))


def test_clamp(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.5,), (None,)], "new_cases double")
    assert [r[0] for r in cleaning.clamp_negatives(df).collect()] == [0.0, 0.0, 2.5, None]
    whole = spark.createDataFrame([(-1, "-3", "x")], "deaths int, cases string, other string")
    assert tuple(cleaning.clamp_negatives(whole).first()) == (0.0, "0.0", "x")


def test_dedup_keeps_the_smallest_row_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x", None), ("a", 1, "z", 1.0), ("a", 1, "y", 2.0), ("b", 5, None, None), (None, 1, "n", 0.0), (None, 0, "m", 0.0)],
        "k string, v int, s string, d double",
    )
    assert rows(cleaning.deduplicate(df, ["k"])) == [(None, 0, "m", 0.0), ("a", 1, "y", 2.0), ("b", 5, None, None)]


def test_dedup_without_usable_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert cleaning.deduplicate(df, ["absent"]).count() == 3
    assert cleaning.deduplicate(df).count() == 2
    assert cleaning.deduplicate(df, ["a", "absent"]).count() == 1
    assert cleaning.deduplicate(df, ["a", "b"]).count() == 2


def test_dedup_carries_maps(spark):
    df = spark.createDataFrame([(1, {"b": 1}), (1, {"a": 1})], "k int, m map<string,int>")
    assert cleaning.deduplicate(df, ["k"]).first()["m"] == {"a": 1}


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"))
    plan = cleaning.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_helpers(spark):
    df = spark.createDataFrame([(1.0, 4.0)], "New_Cases double, state double")
    assert columns_like(df, ["case"]) == ["New_Cases"]
    assert first_present(df, "state_normalized", "state") == "state"
    pairs = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (0.0, 0.0), (1.0, None)], "p double, w double")
    assert [r[0] for r in pairs.select(percent(F.col("p"), F.col("w"))).collect()] == [25.0, 0.0, 0.0, 0.0]


def test_clean_runs_all_steps_in_order(spark):
    df = spark.createDataFrame(
        [("2021-01-05", "01/12/2021", "ca", "-5", None, "x"), ("2021-01-05", "01/12/2021", "ca", "7", "3", "y"),
         ("bad", None, None, "n/a", "2", "z")],
        "start_date string, end_date string, state string, new_cases string, new_deaths string, note string",
    )
    out = cleaning.clean(df, fixed.CASES)
    assert out.columns == [
        *df.columns, "state_normalized", "start_date_parsed", "end_date_parsed", "_silver_processed_at", "_silver_dataset",
    ]
    found = {r.state: r for r in out.collect()}
    # Two rows share their key; the one with fewer cases, -5 raised to 0, stays.
    assert (found["ca"].new_cases, found["ca"].new_deaths, found["ca"].state_normalized) == (0.0, 0.0, "California")
    assert found["ca"].end_date_parsed == date(2021, 1, 12)
    unknown = found["Unknown"]
    assert (unknown.end_date, unknown.end_date_parsed, unknown.new_cases) == ("Unknown", None, 0.0)
    assert unknown._silver_dataset == fixed.CASES


def test_clean_of_unknown_dataset_compares_whole_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    assert cleaning.clean(df, "something else").count() == 2


values = st.one_of(st.none(), st.integers(-10**6, 10**6).map(str), st.sampled_from(["x", "", "NaN", " 4 ", "1e2"]))
records = st.lists(st.tuples(st.sampled_from(["a", "b", None]), values, values), min_size=1, max_size=20)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(records)
def test_cleaning_properties(spark, data):
    df = spark.createDataFrame(data, "state string, new_cases string, new_deaths string")
    once = cleaning.clamp_negatives(cleaning.fill_nulls(cleaning.cast_numbers(df)))
    twice = cleaning.clamp_negatives(cleaning.fill_nulls(cleaning.cast_numbers(once)))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.filter("new_cases < 0 OR new_deaths < 0 OR new_cases IS NULL OR isnan(new_cases)").isEmpty()
    kept = cleaning.deduplicate(once, ["state"])
    assert kept.count() == len({r[0] for r in once.collect()})
    assert kept.exceptAll(once).isEmpty()
