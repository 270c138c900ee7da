"""Expectation suites, each compiled into one aggregation over the table."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.functions.columns import quoted, to_double

Suite = Sequence[tuple[str, Mapping]]

RESULT_SCHEMA = (
    "dataset STRING, position INT, expectation STRING, column_name STRING, observed DOUBLE, threshold DOUBLE, "
    "success BOOLEAN, note STRING"
)


def suite_for(dataset: str) -> Suite:
    return fixed.SUITES.get(dataset, fixed.DEFAULT_SUITE)


def _not_null(df: DataFrame, column: str) -> Column:
    col = quoted(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def _between(df: DataFrame, column: str, low, high) -> Column:
    # NaN sorts above every number, so it has to be kept out by name.
    value = to_double(quoted(column), df.schema[column].dataType)
    return ~F.isnan(value) & (value >= F.lit(float(low))) & (value <= F.lit(float(high)))


def _rate(condition: Column) -> Column:
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def _measure(df: DataFrame, expectation: str, args: Mapping) -> tuple[Column | None, Column, float | None, str | None]:
    """(aggregate, test of its value ``m``, threshold, note) of one expectation."""
    measured = F.col("m")
    failed = F.lit(False)
    if expectation == fixed.ROW_COUNT:
        low, high = args.get("min_value", 0), args.get("max_value", float("inf"))
        return F.count(F.lit(1)).cast("double"), measured.between(float(low), float(high)), None, None
    if expectation == fixed.COLUMN_EXISTS:
        return None, F.lit(args["column"] in df.columns), None, None
    if expectation in (fixed.NOT_NULL, fixed.BETWEEN):
        column, mostly = args["column"], float(args.get("mostly", 1.0))
        if column not in df.columns:
            return None, failed, None, None
        if expectation == fixed.NOT_NULL:
            condition = _not_null(df, column)
        else:
            condition = _between(df, column, args.get("min_value", float("-inf")), args.get("max_value", float("inf")))
        # The rate of an empty table is null, which does not pass.
        return _rate(condition), F.coalesce(measured >= mostly, failed), mostly, None
    return None, F.lit(True), None, f"Unhandled expectation: {expectation}"


def validate(df: DataFrame, dataset: str, suite: Suite | None = None) -> DataFrame:
    """One result row per expectation, from one pass over the table."""
    aggregates, rows = [], []
    for position, (expectation, args) in enumerate(suite_for(dataset) if suite is None else suite):
        try:
            aggregate, test, threshold, note = _measure(df, expectation, args)
        except Exception as error:  # a broken expectation fails, the others are still checked
            aggregate, test, threshold, note = None, F.lit(False), None, f"error: {error!r}"
        value = F.lit(None).cast("double")
        if aggregate is not None:
            aggregates.append(aggregate.alias(f"m{position}"))
            value = F.col(f"m{position}")
        rows.append((position, expectation, args.get("column"), value, threshold, test, note))
    if not rows:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    measures = df.agg(*(aggregates or [F.count(F.lit(1)).alias("m")]))
    structs = [
        F.struct(
            F.lit(dataset).alias("dataset"), F.lit(position).alias("position"), F.lit(name).alias("expectation"),
            F.lit(column).cast("string").alias("column_name"), value.alias("observed"),
            F.lit(threshold).cast("double").alias("threshold"), F.lit(note).cast("string").alias("note"),
            value.alias("m"),
        )
        for position, name, column, value, threshold, _, note in rows
    ]
    long = measures.select(F.inline(F.array(*structs)))
    success = reduce(
        lambda chain, row: chain.when(F.col("position") == row[0], row[5]), rows[1:],
        F.when(F.col("position") == rows[0][0], rows[0][5]),
    )
    return long.withColumn("success", success).select(
        "dataset", "position", "expectation", "column_name", "observed", "threshold", "success", "note"
    )


VERDICT = "_verdict"


def row_rules(df: DataFrame, suite: Suite) -> dict[int, Column]:
    """The expectations that judge single rows, by position: what a row has to be. Columns that are missing judge no row."""
    found = {}
    for position, (expectation, args) in enumerate(suite):
        column = args.get("column")
        if column in df.columns and expectation == fixed.NOT_NULL:
            found[position] = F.coalesce(_not_null(df, column), F.lit(False))
        elif column in df.columns and expectation == fixed.BETWEEN:
            found[position] = F.coalesce(_between(df, column, args.get("min_value", float("-inf")), args.get("max_value", float("inf"))), F.lit(False))
    if len(found) > 63:
        raise ValueError(f"{len(found)} row rules do not fit into one number")
    return found


def with_verdict(df: DataFrame, dataset: str, suite: Suite | None = None) -> DataFrame:
    """Add VERDICT: bit ``i`` is set if the row breaks the ``i``-th rule of the suite that judges rows; 0 is a good row."""
    rules = row_rules(df, suite_for(dataset) if suite is None else suite)
    bits = [F.when(good, F.lit(0)).otherwise(F.lit(1 << i)).cast("long") for i, good in enumerate(rules.values())]
    return df.withColumn(VERDICT, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def broken_rules(df: DataFrame, dataset: str, suite: Suite | None = None, verdict: str = VERDICT) -> Column:
    """The rules that a verdict stands for, as an array of texts."""
    suite = suite_for(dataset) if suite is None else suite
    names = [f"{suite[p][1]['column']}: {suite[p][0]}" for p in row_rules(df, suite)]
    return F.array_compact(F.array(*[F.when(F.col(verdict).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(names)]).cast("array<string>"))


def validate_and_route(df: DataFrame, dataset: str, write: Callable[[DataFrame], None], suite: Suite | None = None) -> DataFrame:
    """The report of :func:`validate`, from the one pass in which ``write`` stores the rows that break a rule.

    The rates are counted on the verdicts of all rows by the tasks that write, before good rows are left out.
    """
    suite = suite_for(dataset) if suite is None else suite
    rules, seen = row_rules(df, suite), Observation()
    judged = with_verdict(df, dataset, suite)
    good = [F.count_if(F.col(VERDICT).bitwiseAND(F.lit(1 << i)) == 0).alias(f"good{p}") for i, p in enumerate(rules)]
    judged = judged.observe(seen, F.count(F.lit(1)).alias("rows"), *good)
    write(judged.filter(F.col(VERDICT) != 0).withColumn("broken_rules", broken_rules(judged, dataset, suite)))
    counted, results = seen.get, []
    for position, (expectation, args) in enumerate(suite):
        observed, threshold, success, note = None, None, False, None
        if expectation == fixed.ROW_COUNT:
            observed = float(counted["rows"])
            success = args.get("min_value", 0) <= observed <= args.get("max_value", float("inf"))
        elif expectation == fixed.COLUMN_EXISTS:
            success = args["column"] in df.columns
        elif position in rules:
            threshold = float(args.get("mostly", 1.0))
            observed = counted[f"good{position}"] / counted["rows"] if counted["rows"] else None
            success = observed is not None and observed >= threshold
        elif expectation not in (fixed.NOT_NULL, fixed.BETWEEN):
            success, note = True, f"Unhandled expectation: {expectation}"
        results.append((dataset, position, expectation, args.get("column"), observed, threshold, success, note))
    return df.sparkSession.createDataFrame(results, RESULT_SCHEMA)


def unreadable(spark: SparkSession, dataset: str, error: str) -> DataFrame:
    """The result of a table that cannot be read: no expectation, only the error."""
    return spark.createDataFrame([(dataset, None, None, None, None, None, None, error)], RESULT_SCHEMA)


def dataset_summary(results: DataFrame, datasets: Sequence[str] = ()) -> DataFrame:
    """Expectations, passed, failed and rate per dataset.

    A dataset that could not be read has status error and no rate. One of ``datasets`` without any result, as after an
    empty suite, has no expectation and a rate of 1.
    """
    if datasets:
        known = results.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string")
        marked = results.withColumn("found", F.lit(True))
        results = known.join(marked, "dataset", "full").withColumn("missing", F.col("found").isNull()).drop("found")
    else:
        results = results.withColumn("missing", F.lit(False))
    checked = F.col("position").isNotNull()
    readable = F.bool_and(checked | F.col("missing"))
    passed = F.count(F.when(F.col("success"), 1))
    total = F.count(F.when(checked, 1))
    return results.groupBy("dataset").agg(
        total.alias("total_expectations"), passed.alias("passed"), (total - passed).alias("failed"),
        F.when(readable, F.when(total > 0, passed / F.nullif(total, F.lit(0))).otherwise(F.lit(1.0))).alias("success_rate"),
        F.when(readable, "success").otherwise("error").alias("status"),
    )


def run_summary(summaries: DataFrame) -> DataFrame:
    """Totals over all datasets."""
    return summaries.agg(
        F.count(F.lit(1)).alias("datasets_validated"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("total_passed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("total_failed"),
    )
