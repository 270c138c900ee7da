"""Row caps, offset pages and keyset pages; keyset pages also over compound keys with ties and nulls."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import keyset
from lamina.session import write_out

MAX_PARTITIONS = 1_000_000


def row_cap(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    """The first ``limit`` rows by key; all rows if there is no limit."""
    return df if limit is None else df.orderBy(key).limit(limit)


def page_size(requested: int = fixed.MAX_PAGE_SIZE, remaining: int | None = None) -> int:
    """The size that was asked for, or what is left."""
    size = requested
    return size if remaining is None else min(size, remaining)


def with_row_index(df: DataFrame, keys: list[str], index: str = "row_index", start: int = 0) -> DataFrame:
    """Number the rows 0, 1, 2 ... in the order of ``keys``, without a one-task window.

    The table is sorted by range partitioning and written to the shared folder together
    with each row's partition and place in it. Written rows do not move, so the counts per
    partition always belong to the same split, also after a lost executor. Adding the
    counts of the partitions before gives the index. Ties must be equal rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if partitions > MAX_PARTITIONS:  # the bound of the window and the broadcast below
        raise ValueError(f"{partitions} shuffle partitions; counts per partition are kept for {MAX_PARTITIONS} at most")
    sorted_rows = df.orderBy(*keys).withColumn("_place", F.monotonically_increasing_id())
    placed = write_out(sorted_rows, "row-index")
    # monotonically_increasing_id holds the partition above bit 33 and the row below it.
    part = F.shiftright("_place", 33)
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written partition: small enough for one window and for a broadcast.
    offsets = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + place + start).alias(index))
    )


def paginate(df: DataFrame, key: str, size: int = fixed.MAX_PAGE_SIZE) -> DataFrame:
    """Add ``page``: page k holds the rows k * size up to (k + 1) * size in key order."""
    indexed = with_row_index(df, [key], "_index")
    return indexed.withColumn("page", F.floor(F.col("_index") / page_size(size))).drop("_index")


def page_index(paged: DataFrame, key: str) -> DataFrame:
    """First key, last key and row count of every page."""
    return paged.groupBy("page").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("page_rows")
    )


def read_after(df: DataFrame, key: str, last_key=None, size: int = fixed.MAX_PAGE_SIZE) -> DataFrame:
    """The next page in key order after ``last_key``; the filter reaches the scan."""
    rest = df if last_key is None else df.filter(F.col(key) > last_key)
    return rest.orderBy(key).limit(page_size(size))


def page_bounds(df: DataFrame, key: str | Sequence[str], size: int = fixed.MAX_PAGE_SIZE) -> DataFrame:
    """page, first_key, last_key and page_rows of every page, from one range sort of the keys alone.

    A compound key is a struct. Rows with the same key stay in one page, the one in which the first of them falls, so a
    page can be longer than ``size`` and the numbers of the pages that it fills are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    indexed = with_row_index(df.select(*keys), keys, "_index")
    alike = indexed.groupBy(keyset.key_struct(keys).alias("_key")).agg(F.min("_index").alias("_index"), F.count(F.lit(1)).alias("_rows"))
    pages = alike.groupBy(F.floor(F.col("_index") / page_size(size)).alias("page")).agg(
        F.min("_key").alias("first_key"), F.max("_key").alias("last_key"), F.sum("_rows").alias("page_rows")
    )
    if not isinstance(key, str):
        return pages
    return pages.withColumns({c: F.col(f"{c}.k0") for c in ("first_key", "last_key")})


def read_page(df: DataFrame, key: str, first_key, last_key) -> DataFrame:
    """The rows of one page; the range filter reaches the scan, and no task gathers the page."""
    return df.filter(F.col(key).between(F.lit(first_key), F.lit(last_key)))


@dataclass(frozen=True)
class Walk:
    """The pages of a table in key order, to the last, short one; each row is in exactly one.

    To iterate gives (page, rows) for callers that take a page at a time; a page is a range filter, and the bounds come to the driver one by one.
    """

    table: DataFrame
    keys: Sequence[str]
    size: int

    def __iter__(self) -> Iterator[tuple[int, DataFrame]]:
        bounds = page_bounds(self.table, self.keys, self.size)
        ends = bounds.select("page", keyset.struct_text(self.table, self.keys, "last_key").alias("last")).orderBy("page")
        after = None
        for r in ends.toLocalIterator():
            yield r["page"], self.table.filter(keyset.between(self.table, self.keys, after, r["last"]))
            after = r["last"]

    def rows(self, page: str = "page") -> DataFrame:
        """The rows of all pages, with the page in whose range each lies: one pass over the table, however many pages there are."""
        ends = page_bounds(self.table, self.keys, self.size).select(F.col("last_key").alias("end"), F.col("page").alias("number"))
        return self.table.withColumn(page, keyset.range_number(self.keys, ends))


def keyset_walk(df: DataFrame, key: str | Sequence[str], size: int = fixed.MAX_PAGE_SIZE) -> Walk:
    """Every page in key order: page after page, or the rows of all at once."""
    return Walk(df, [key] if isinstance(key, str) else list(key), size)
