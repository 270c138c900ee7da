"""Ranges of a compound key: every row lies in exactly one, also with ties and nulls.

The order is ascending with nulls first, column by column. Bounds are kept as text, which gives back the exact value in any
session; a predicate on the first column stands beside the comparison of the whole key, so that it reaches the scan.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.columns import quoted

Bound = Sequence[str | None]


def as_text(col: Column, data_type: T.DataType) -> Column:
    """A key column as text from which :func:`from_text` makes the same value."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(col)
    if not isinstance(data_type, T.AtomicType):
        raise TypeError(f"a key cannot be of type {data_type.simpleString()}")
    return col.cast("string")


def from_text(text: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(text).cast("long"))
    if isinstance(data_type, T.BinaryType):
        return F.unhex(F.lit(text))
    return F.lit(text).cast(data_type)


def _bound_struct(df: DataFrame, keys: Sequence[str], bound: Bound) -> Column:
    """The bound as a key struct. Structs compare field by field with nulls first, and each key of a row is made once, however many it is compared with."""
    kinds = [df.schema[k].dataType for k in keys]
    values = [F.lit(None).cast(kind) if v is None else from_text(v, kind) for v, kind in zip(bound, kinds, strict=True)]
    return F.struct(*[v.alias(f"k{i}") for i, v in enumerate(values)])


def above(df: DataFrame, keys: Sequence[str], bound: Bound, inclusive: bool = False) -> Column:
    """Rows whose key comes after ``bound``."""
    key, end = key_struct(keys), _bound_struct(df, keys, bound)
    found = key >= end if inclusive else key > end
    return found if bound[0] is None else (quoted(keys[0]) >= from_text(bound[0], df.schema[keys[0]].dataType)) & found


def below(df: DataFrame, keys: Sequence[str], bound: Bound, inclusive: bool = True) -> Column:
    """Rows whose key comes before ``bound``, or is it."""
    key, end, col = key_struct(keys), _bound_struct(df, keys, bound), quoted(keys[0])
    found = key <= end if inclusive else key < end
    return (col.isNull() if bound[0] is None else col.isNull() | (col <= from_text(bound[0], df.schema[keys[0]].dataType))) & found


def between(df: DataFrame, keys: Sequence[str], after: Bound | None, to: Bound) -> Column:
    """Rows after ``after`` (from the beginning if None) up to ``to`` itself."""
    end = below(df, keys, to)
    if after is None:
        return end
    if after[0] is not None and to[0] is not None:  # no nulls in between, so the scan can take the end as it is
        end = (quoted(keys[0]) <= from_text(to[0], df.schema[keys[0]].dataType)) & end
    return above(df, keys, after) & end


def key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)])


def struct_text(df: DataFrame, keys: Sequence[str], struct: str) -> Column:
    """The fields of a key struct as an array of texts."""
    return F.array(*[as_text(F.col(f"{struct}.k{i}"), df.schema[k].dataType) for i, k in enumerate(keys)])


#: Ends of ranges as JSON, which gives back the exact values.
_JSON = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def typed_ends(df: DataFrame, keys: Sequence[str], ends: Sequence[tuple[int | None, Bound]]) -> DataFrame:
    """(number, end) of ranges whose ends are text, as a table for :func:`range_number`."""
    given = df.sparkSession.createDataFrame([(n, list(end)) for n, end in ends], "number long, texts array<string>")
    values = [from_text(F.get("texts", F.lit(i)), df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)]
    return given.select("number", F.struct(*values).alias("end"))


def range_number(keys: Sequence[str], ends: DataFrame) -> Column:
    """The number of the range in which a row's key lies: that of the first end which does not come before it, null after the last.

    ``ends`` has the last key of every range (``end``, a key struct) and its ``number``. They go into the plan as two constants; each row makes its
    key once and is searched by halves. So all rows are dealt in one pass over the table, without a shuffle, however many ranges there are.
    """
    one = F.sort_array(F.collect_list(F.struct("end", "number")))  # one short row per range
    parts = [F.to_json(one.getField(name), _JSON) for name in ("end", "number")]
    *texts, count = ends.agg(*parts, F.count(F.lit(1))).first()
    sorted_ends, numbers = (F.from_json(F.lit(text), T.ArrayType(ends.schema[name].dataType), _JSON) for text, name in zip(texts, ("end", "number"), strict=True))
    widths = F.array(*[F.lit(1 << i) for i in reversed(range(count.bit_length()))])

    def before(key: Column) -> Column:
        """How many ends come before the key; an end after the last one is null and does not."""
        return F.aggregate(widths, F.lit(0), lambda at, width: F.when(F.get(sorted_ends, at + width - F.lit(1)) < key, at + width).otherwise(at))

    return F.get(numbers, F.get(F.transform(F.array(key_struct(keys)), before), F.lit(0)))
