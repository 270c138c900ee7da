import pytest

from lamina.functions import fixed
from lamina.operators import quality

NAN = float("nan")


def one(df, expectation, **args):
    return quality.validate(df, "d", [(expectation, args)]).first()


def test_between_counts_nulls_and_text_as_invalid(spark):
    df = spark.createDataFrame([("1",), ("-1",), (None,), ("x",)], "c string")
    row = one(df, fixed.BETWEEN, column="c", min_value=0, mostly=0.25)
    assert (row.observed, row.threshold, row.success) == (0.25, 0.25, True)
    assert not one(df, fixed.BETWEEN, column="c", min_value=0, mostly=0.26).success


def test_between_keeps_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (float("inf"),), (200.0,)], "c double")
    assert one(df, fixed.BETWEEN, column="c", min_value=0).observed == 0.75
    assert one(df, fixed.BETWEEN, column="c", min_value=0, max_value=100).observed == 0.25
    assert one(df, fixed.BETWEEN, column="c").observed == 0.75


def test_not_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None)], "c double, s string")
    assert one(df, fixed.NOT_NULL, column="c", mostly=0.5).success
    assert not one(df, fixed.NOT_NULL, column="c").success
    assert one(df, fixed.NOT_NULL, column="s").observed == 0.5
    assert not one(df, fixed.NOT_NULL, column="absent").success


def test_row_count(spark):
    df = spark.range(5)
    assert one(df, fixed.ROW_COUNT).success
    assert one(df, fixed.ROW_COUNT, min_value=5, max_value=5).observed == 5.0
    assert not one(df, fixed.ROW_COUNT, min_value=6).success
    assert not one(df, fixed.ROW_COUNT, max_value=4).success


def test_column_exists(spark):
    assert one(spark.range(1), fixed.COLUMN_EXISTS, column="id").success
    assert not one(spark.range(1), fixed.COLUMN_EXISTS, column="x").success


def test_unknown_and_broken_expectations(spark):
    df = spark.range(1)
    unknown = one(df, "expect_something_else")
    assert unknown.success and unknown.note == "Unhandled expectation: expect_something_else"
    broken = one(df, fixed.NOT_NULL)
    assert not broken.success and "column" in broken.note


def test_rates_of_an_empty_table_fail(spark):
    df = spark.createDataFrame([], "state string, new_cases double, new_deaths double")
    found = [r.success for r in quality.validate(df, fixed.CASES).orderBy("position").collect()]
    assert found == [False, True, False, False, False]


def test_one_pass_over_the_table(spark, tmp_path):
    spark.createDataFrame([("a", 1.0, 2.0, 9)], "state string, new_cases double, new_deaths double, more int").write.parquet(str(tmp_path / "t"))
    plan = quality.validate(spark.read.parquet(str(tmp_path / "t")), fixed.CASES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "more" not in plan


def test_default_suite_and_empty_suite(spark):
    assert quality.suite_for("anything") == fixed.DEFAULT_SUITE
    assert quality.validate(spark.range(1), "d", []).isEmpty()


def test_summaries(spark):
    good = quality.validate(spark.createDataFrame([("NY", "5", "5")], "location string, administered string, series_complete_yes string"), fixed.VACCINATIONS)
    bad = quality.validate(spark.createDataFrame([(None, "-1", "1")], "state string, new_cases string, new_deaths string"), fixed.CASES)
    results = good.unionByName(bad).unionByName(quality.unreadable(spark, "gone", "not found"))
    summary = quality.dataset_summary(results)
    found = {r.dataset: (r.total_expectations, r.passed, r.failed, r.success_rate, r.status) for r in summary.collect()}
    assert found == {
        fixed.VACCINATIONS: (4, 4, 0, 1.0, "success"), fixed.CASES: (5, 3, 2, pytest.approx(0.6), "success"),
        "gone": (0, 0, 0, None, "error"),
    }
    assert tuple(quality.run_summary(summary).first()) == (3, 7, 2)


ODD = [(None, "5"), ("CA", "-1"), ("CA", "x"), ("TX", None), ("TX", "3"), (None, "NaN"), ("NY", "7")]
SUITE = [
    (fixed.ROW_COUNT, {"min_value": 1}), (fixed.NOT_NULL, {"column": "state", "mostly": 0.7}), (fixed.COLUMN_EXISTS, {"column": "n"}),
    (fixed.BETWEEN, {"column": "n", "min_value": 0, "max_value": 6}), (fixed.NOT_NULL, {"column": "gone"}), ("expect_something_new", {"column": "n"}),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_verdicts_and_report_of_one_pass(spark, rows):
    df, stored = spark.createDataFrame(rows, "state string, n string"), []
    report = quality.validate_and_route(df, "d", lambda bad: stored.extend(bad.collect()), SUITE)
    columns = ["position", "observed", "success", "threshold", "note", "column_name"]
    assert sorted(map(str, report.select(columns).collect())) == sorted(map(str, quality.validate(df, "d", SUITE).select(columns).collect()))
    if rows:
        assert sorted((r["state"] or "", r["n"] or "", r[quality.VERDICT], len(r["broken_rules"])) for r in stored) == [
            ("", "5", 1, 1), ("", "NaN", 3, 2), ("CA", "-1", 2, 1), ("CA", "x", 2, 1), ("NY", "7", 2, 1), ("TX", "", 2, 1)]
        verdicts = [r[quality.VERDICT] for r in quality.with_verdict(df, "d", SUITE).collect()]
        rate = {r["position"]: r["observed"] for r in report.collect()}
        assert rate[1] == sum(v & 1 == 0 for v in verdicts) / 7 and rate[3] == sum(v & 2 == 0 for v in verdicts) / 7


def test_more_rules_than_bits(spark):
    with pytest.raises(ValueError):
        quality.row_rules(spark.range(1), [(fixed.NOT_NULL, {"column": "id"})] * 64)
