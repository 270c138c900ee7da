from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.functions import fixed
from lamina.operators import warehouse

D = date(2021, 1, 4)


def coerced(spark, data, given, ddl):
    return warehouse.coerce(spark.createDataFrame(data, given), StructType.fromDDL(ddl))


def test_halves_round_away_from_zero(spark):
    values = [2.5, -2.5, 0.49, 1e3, 12.499999999999, None]
    out = coerced(spark, [(v,) for v in values], "n double", "n BIGINT")
    assert [r.n for r in out.collect()] == [3, -3, 0, 1000, 13, None]
    assert warehouse.rejected(out).isEmpty()


def test_numbers_that_do_not_fit_are_rejected(spark):
    out = coerced(spark, [(float("nan"),), (1e30,), (5.0,)], "n double", "n BIGINT")
    assert [r.reject_reason for r in out.collect()] == ["n: not a long", "n: not a long", None]


def test_length_limit(spark):
    out = coerced(spark, [("abc",), ("abc  ",), ("abcd",), (None,)], "s string", "s VARCHAR(3)")
    assert [tuple(r) for r in out.collect()] == [("abc", None), ("abc", None), ("abcd", "s: longer than 3"), (None, None)]


def test_nulls_are_rejected_with_all_reasons(spark):
    out = coerced(spark, [(None, "long")], "d date, s string", "d DATE NOT NULL, s VARCHAR(2) NOT NULL")
    assert out.first().reject_reason == "d: null; s: longer than 2"


def test_defaults_only_for_columns_that_are_missing(spark):
    out = warehouse.coerce(
        spark.createDataFrame([(D, None)], "report_date date, new_cases double"), warehouse.schema_of("kpi_cases_per_day")
    ).first()
    assert (out.new_cases, out.cumulative_cases, out.state) == (None, 0, None)
    assert out.updated_at is not None and out.reject_reason is None


def test_accepted_and_rejected_are_all_rows(spark):
    df = spark.range(100).select(F.when(F.col("id") % 3 > 0, F.lit(D)).alias("report_date"), F.lit("CA").alias("state"))
    out = warehouse.coerce(df, warehouse.schema_of("kpi_deaths_per_day"))
    assert (warehouse.accepted(out).count(), warehouse.rejected(out).count()) == (66, 34)


def test_ids_are_serial(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "s string, n int").repartition(3)
    assert sorted(tuple(r) for r in warehouse.with_ids(df).collect()) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]


def test_every_table_has_a_schema():
    assert set(fixed.GOLD_SCHEMAS) == set(fixed.WAREHOUSE_SCHEMAS)
    assert [f.nullable for f in warehouse.schema_of("kpi_temporal_evolution_by_state")][:2] == [False, False]
