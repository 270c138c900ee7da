"""Typed warehouse rows: casts, length and null rules, rejected rows, serial ids."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.functions.columns import quoted
from lamina.operators.paging import with_row_index

REASON = "reject_reason"
# Noise of floating-point sums lies far below this many decimals.
SUM_DECIMALS = 6


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(fixed.WAREHOUSE_SCHEMAS[table])


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        default = {"updated_at": F.current_timestamp(), "run_timestamp": F.current_timestamp()}.get(field.name)
        if default is None:
            default = F.lit(0) if isinstance(field.dataType, T.LongType) else F.lit(None)
        return default.cast(_plain(field.dataType))
    col = quoted(field.name)
    if isinstance(field.dataType, T.LongType):
        if isinstance(df.schema[field.name].dataType, (T.FloatType, T.DoubleType)):
            # Halves round away from zero; rounding twice keeps noise in sums from deciding them.
            col = F.round(F.round(col, SUM_DECIMALS))
        return col.try_cast("bigint")
    if isinstance(field.dataType, T.VarcharType):
        # Blanks beyond the limit are dropped, anything else beyond it is a violation.
        text, limit = col.cast("string"), field.dataType.length
        return F.when(F.length(F.rtrim(text)) <= limit, F.substring(text, 1, limit)).otherwise(text)
    return col.try_cast(_plain(field.dataType))


def _plain(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, T.VarcharType) else data_type


def _violations(df: DataFrame, field: T.StructField) -> list[Column]:
    col, found = F.col(f"_typed.`{field.name}`"), []
    if field.name in df.columns:
        given = quoted(field.name)
        found.append(F.when(given.isNotNull() & col.isNull(), F.lit(f"{field.name}: not a {field.dataType.typeName()}")))
    if not field.nullable:
        found.append(F.when(col.isNull(), F.lit(f"{field.name}: null")))
    if isinstance(field.dataType, T.VarcharType):
        limit = field.dataType.length
        found.append(F.when(F.length(col) > limit, F.lit(f"{field.name}: longer than {limit}")))
    return found


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows in warehouse types plus ``reject_reason``, which is null for rows that may be loaded."""
    typed = df.withColumn("_typed", F.struct(*[_typed(df, f).alias(f.name) for f in schema]))
    checks = [check for f in schema for check in _violations(df, f)]
    reason = F.concat_ws("; ", *checks) if checks else F.lit("")
    return typed.select(F.when(reason != "", reason).alias(REASON), "_typed.*").select(*schema.names, REASON)


def accepted(coerced: DataFrame) -> DataFrame:
    return coerced.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(coerced: DataFrame) -> DataFrame:
    return coerced.filter(F.col(REASON).isNotNull())


def reason_counts(rejects: DataFrame) -> dict[str, int]:
    """Rows by reason; a row with several reasons counts for each. There are a few reasons per column."""
    each = rejects.select(F.explode(F.split(REASON, "; ")).alias("reason")).groupBy("reason").count()
    return {r["reason"]: r["count"] for r in each.collect()}


def with_ids(rows: DataFrame) -> DataFrame:
    """Serial ids from 1 in the order of all columns, as after a truncate with restarted identity."""
    indexed = with_row_index(rows, rows.columns, "id", start=1)
    return indexed.select("id", *rows.columns)
