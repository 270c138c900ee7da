"""Cleaning of raw tables: states, dates, numbers, nulls, negatives, duplicates.

Everything but the de-duplication is a projection, so one cleaned table costs
one scan and one shuffle.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.functions.columns import columns_like, parse_date, quoted, state_name, to_double

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FILLED_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def standardize_states(df: DataFrame, column: str = fixed.STATE_COLUMN) -> DataFrame:
    """Add ``{column}_normalized``; without the column, use the first known alternative or do nothing."""
    found = next((c for c in [column, *fixed.STATE_ALTERNATIVES] if c in df.columns), None)
    if found is None:
        return df
    return df.withColumn(f"{found}_normalized", state_name(quoted(found).cast("string")))


def parse_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``{column}_parsed`` as DATE for the named columns, or for all that look like dates."""
    columns = columns_like(df, fixed.DATE_KEYWORDS) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({f"{c}_parsed": parse_date(quoted(c), df.schema[c].dataType) for c in columns})


def cast_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn the named columns, or all that look numeric by name, into DOUBLE in place."""
    columns = columns_like(df, fixed.NUMERIC_KEYWORDS) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: to_double(quoted(c), df.schema[c].dataType) for c in columns})


def fill_nulls(df: DataFrame, number: float = fixed.FILL_NUMBER) -> DataFrame:
    """0 for null and NaN numbers, ``Unknown`` for null strings; decimals, dates and the rest stay."""
    values = {f.name: number for f in df.schema if isinstance(f.dataType, FILLED_TYPES)}
    values |= {f.name: fixed.FILL_STRING for f in df.schema if f.dataType == T.StringType()}
    return df.fillna(values) if values else df


def clamp_negatives(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace negative values by 0 in the named columns, or in all that look like counts by name."""
    columns = (
        columns_like(df, fixed.NON_NEGATIVE_KEYWORDS) if columns is None else [c for c in columns if c in df.columns]
    )
    return df.withColumns({c: _clamped(quoted(c), df.schema[c].dataType) for c in columns})


def _clamped(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, NUMERIC_TYPES):
        return F.when(col < 0, F.lit(0.0)).otherwise(col)
    if isinstance(data_type, T.StringType):
        return F.when(col.try_cast("double") < 0, F.lit("0.0")).otherwise(col)
    return col


def deduplicate(df: DataFrame, keys: list[str] | None = None, carry: str | None = None) -> DataFrame:
    """One row per key: the smallest of its rows, comparing the other columns from left to right.

    Without ``keys`` whole rows are compared; keys that are given but absent leave
    the table as it is. The minimum is combined before the shuffle, so a key that
    holds a large share of the rows still sends one row per task. ``carry`` is a struct of numbers
    that takes no part and is added up, over the rows that go as well.
    """
    sums = [F.struct(*[F.sum(F.col(f"{carry}.{f.name}")).alias(f.name) for f in df.schema[carry].dataType]).alias(carry)] if carry else []
    if not keys:
        return df.groupBy(*[quoted(c) for c in df.columns if c != carry]).agg(*sums) if carry else df.dropDuplicates()
    present = [c for c in keys if c in df.columns]
    if not present:
        return df
    rest = [f for f in df.schema if f.name not in present and f.name != carry]
    if not rest:
        return df.groupBy(*map(quoted, present)).agg(*sums) if carry else df.dropDuplicates(present)
    row = F.struct(*[quoted(f.name) for f in rest])
    order = F.struct(*[_sortable(quoted(f.name), f.dataType) for f in rest])
    kept = F.min(row) if all(_orderable(f.dataType) for f in rest) else F.min_by(row, order)
    return (
        df.groupBy(*[quoted(c) for c in present])
        .agg(kept.alias("_kept"), *sums)
        .select(*[quoted(c) if c in present or c == carry else F.col("_kept").getField(c).alias(c) for c in df.columns])
    )


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _sortable(col: Column, data_type: T.DataType) -> Column:
    return col if _orderable(data_type) else col.cast("string")


#: What the cleaning does to the values of a row, by the reason; the struct counts the row itself as well.
DEFECTS, REASONS = "_defects", ["date not parsed", "number not cast", "negative", "missing"]


def defects(df: DataFrame) -> Column:
    """A struct with the number of values of the raw row that the cleaning replaces, by reason, and ``rows``, which is 1.

    Missing values are those that are null before any step; a negative number counts where it is set to 0.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    counts = [c for c in columns_like(df, fixed.NUMERIC_KEYWORDS) if not isinstance(kinds[c], T.DateType)]
    flags = {
        "date not parsed": [quoted(c).isNotNull() & parse_date(quoted(c), kinds[c]).isNull() for c in columns_like(df, fixed.DATE_KEYWORDS)],
        "number not cast": [quoted(c).isNotNull() & to_double(quoted(c), kinds[c]).isNull() for c in counts],
        "negative": [F.coalesce(to_double(quoted(c), kinds[c]) < 0, F.lit(False)) for c in columns_like(df, fixed.NON_NEGATIVE_KEYWORDS) if c in counts],
        "missing": [quoted(c).isNull() for c in df.columns if isinstance(kinds[c], (*FILLED_TYPES, T.StringType))],
    }
    added = {name: reduce(lambda a, b: a + b, [f.cast("long") for f in flags[name]], F.lit(0).cast("long")) for name in REASONS}
    return F.struct(F.lit(1).cast("long").alias("rows"), *[added[name].alias(name) for name in REASONS])


STAMPS = ["_silver_processed_at", "_silver_dataset"]


def prepared(df: DataFrame) -> DataFrame:
    """The cleaning of single rows, before duplicates are removed. The order of the steps is part of the result."""
    return (
        df.transform(standardize_states)
        .transform(parse_dates)
        .transform(cast_numbers)
        .transform(fill_nulls)
        .transform(clamp_negatives)
    )


def stamped(df: DataFrame, dataset: str) -> DataFrame:
    return df.withColumns(dict(zip(STAMPS, [F.current_timestamp(), F.lit(dataset)], strict=True)))


def clean(df: DataFrame, dataset: str) -> DataFrame:
    """The whole cleaning of one dataset."""
    return stamped(deduplicate(prepared(df), fixed.DEDUP_KEYS.get(dataset)), dataset)
