"""Column expressions used by more than one operator. All are ANSI-safe."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed

# A date may be followed by anything and preceded by blanks; month and day need no padding.
ISO_DATE = r"^[ \t]*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
SLASH_DATE = r"^[ \t]*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"


def columns_like(df: DataFrame, keywords: list[str]) -> list[str]:
    """Columns whose lower-cased name contains any of the keywords."""
    return [c for c in df.columns if any(k in c.lower() for k in keywords)]


def first_present(df: DataFrame, *names: str) -> str:
    """The first of ``names`` that is a column of ``df``; the last one if none is."""
    return next((n for n in names if n in df.columns), names[-1])


def quoted(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def state_name(col: Column) -> Column:
    """Full state name for a two-letter code in any case; other values unchanged."""
    names = F.expr("map(" + ", ".join(f"'{code}', '{name}'" for code, name in fixed.STATE_NAMES.items()) + ")")
    code = F.upper(col)
    # Every key has two letters, so longer values skip the map scan.
    return F.coalesce(F.when(F.length(code) == 2, names[code]), col)


def parse_date(col: Column, data_type: T.DataType = T.StringType()) -> Column:
    """DATE from ISO text (with or without time) or MM/dd/yyyy; NULL if neither fits."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    text = col.cast("string")
    slash = F.regexp_extract(text, SLASH_DATE, 1)
    # Plain ISO dates need no regular expression; the cast alone would also take a bare year or month.
    looks_iso = (F.substring(text, 5, 1) == "-") & F.contains(F.substring(text, 7, 2), F.lit("-"))
    return F.coalesce(
        F.when(looks_iso, text.try_cast("date")),
        F.regexp_extract(text, ISO_DATE, 1).try_cast("date"),
        F.regexp_replace(slash, r"^([0-9]+)/([0-9]+)/([0-9]+)$", "$3-$1-$2").try_cast("date"),
    )


def to_double(col: Column, data_type: T.DataType = T.StringType()) -> Column:
    """DOUBLE, or NULL where the value is not a number (dates never are)."""
    if isinstance(data_type, T.DateType):
        return F.lit(None).cast("double")
    return col.try_cast("double")


def number(col: Column) -> Column:
    """DOUBLE with nulls and non-numbers as 0."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 where whole is not positive or null."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def iso_timestamp(col: Column) -> Column:
    """TIMESTAMP from ISO-8601 text; NULL if it does not parse."""
    return F.try_to_timestamp(col)
