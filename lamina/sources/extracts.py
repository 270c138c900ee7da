"""Resumable extraction: a table is written page by page over a compound key, and every finished page leaves a mark.

A page is a range of keys, after the last key of the page before and up to its own last one. Pages are written in stretches of about
JOB_ROWS rows, each in a few jobs of many tasks; then the marks of the pages (range, rows, bytes, hash of the rows) are written, which makes them count. The last mark is the
high-water mark. A stretch that fails is written in halves, so all pages before the one that cannot be read are finished. A later run writes what is missing: pages after the mark, which an abort has left out or for which
new rows have come, and pages whose range holds another number of rows than before. One pass counts the rows of all
pages. Rows that change in place without changing their number are not noticed; ``fresh`` starts
anew. Files of a page without a mark do not count, whatever an aborted run has left; of several marks of a page the last counts.

A few pages have a folder each. Many that are written together share the files of one folder, in which each row begins with its page: their number then costs
no files. The mark of a page names that folder, and rows of the page in other folders do not count; a folder that no mark names any more is deleted.
"""

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators import keyset, paging
from lamina.session import write_out
from lamina.sources import files

#: Rows of a page: a job of its own, so much more than a page of a web interface.
PAGE_ROWS = 10_000_000
#: Rows that are written together; pages of fewer rows share their jobs.
JOB_ROWS = 10_000_000
#: So many pages that are written together share their files; fewer have a folder each.
SHARED_FROM = 64
#: The names of shared folders begin with this; PAGE is the first column of their files.
SHARED, PAGE = "pages-", "_page"
#: A page, the last key before it and its own last key.
Page = tuple[int, keyset.Bound | None, keyset.Bound]
MARK = "page BIGINT, last ARRAY<STRING>, rows BIGINT, bytes BIGINT, content_hash STRING, written_at STRING, folder STRING"


def rows_hash(columns: Sequence[str]) -> F.Column:
    """A hash of all rows that does not depend on their order; repeated rows count."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")), F.lit(0)).cast("string")


@dataclass(frozen=True)
class KeysetExtract:
    """The pages of one source below ``path`` as CSV; ``keys`` are the key and the columns that break its ties."""

    spark: SparkSession
    path: str
    keys: Sequence[str] = ()
    size: int = PAGE_ROWS

    def page_path(self, page: int) -> str:
        return f"{self.path}/page={page:08d}"

    @property
    def marks_path(self) -> str:
        return f"{self.path}-marks"

    def marks(self) -> list[Row]:
        """The finished pages in order, one row each."""
        try:
            found = self.spark.read.schema(MARK).option("recursiveFileLookup", True).json(self.marks_path)
            last = found.groupBy("page").agg(F.max_by(F.struct(*found.columns), "written_at").alias("last"))
            return last.select("last.*").orderBy("page").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def route(self, pages: Sequence[Mapping | Row], schema: T.StructType | str | None = None, multi_line: bool = True, null_mark: str | None = files.NULL_MARK) -> files.Routed:
        """The records of finished pages, given by ``page`` and ``folder`` as in their marks; FILE ends with the page of a record, or with its folder and file."""
        own = [self.page_path(p["page"]) for p in pages if p["folder"] is None]
        shared = [(p["folder"], p["page"]) for p in pages if p["folder"] is not None]
        found = [files.route_csv(self.spark, own, schema, multi_line, null_mark).rows] if own else []
        if shared:
            found.append(self._route_shared(shared, schema, multi_line, null_mark))
        return files.Routed(found[0] if len(found) == 1 else found[0].unionByName(found[1]))

    def _route_shared(self, pages: list[tuple[str, int]], schema: T.StructType | str | None, multi_line: bool, null_mark: str | None) -> DataFrame:
        kind = None if schema is None else T.StructType([T.StructField(PAGE, T.LongType()), *(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)])
        rows = files.route_csv(self.spark, sorted({f"{self.path}/{folder}" for folder, _ in pages}), kind, multi_line, null_mark).rows
        wanted = self.spark.createDataFrame(pages, f"_folder STRING, {PAGE} BIGINT").withColumn("_wanted", F.lit(True))  # one short row per page
        placed = rows.withColumn(PAGE, F.col(PAGE).try_cast("bigint")).withColumn("_folder", F.regexp_extract(files.FILE, rf"/({SHARED}[0-9a-f]+)/[^/]*$", 1))
        kept = placed.join(F.broadcast(wanted), ["_folder", PAGE], "left").filter(F.col("_wanted") | (F.col(PAGE).isNull() & F.col(files.CORRUPT).isNotNull()))
        return kept.withColumns({
            files.FILE: F.concat(files.FILE, F.coalesce(F.format_string("#page=%08d", PAGE), F.lit(""))),
            files.CORRUPT: F.when(F.col(PAGE).isNull(), F.col(files.CORRUPT)).otherwise(F.regexp_replace(files.CORRUPT, "^[0-9]+,", "")),
        }).select(*[F.col(f"`{c}`") for c in rows.columns if c != PAGE])

    def restart(self) -> None:
        """Forget the marks."""
        self.spark.createDataFrame([], MARK).write.mode("overwrite").json(self.marks_path)

    def run(self, table: DataFrame, fresh: bool = False) -> list[int]:
        """Write the missing pages in order and return their numbers."""
        if fresh:
            self.restart()
        done = self.marks()
        changed = [(done[i]["page"], done[i - 1]["last"] if i else None, done[i]["last"]) for i in self._changed(table, done)]
        after, page = (done[-1]["last"], done[-1]["page"] + 1) if done else (None, 1)
        rest = table.filter(keyset.above(table, self.keys, after)) if done else table
        ends = self._ends(rest)
        if not done and not ends:  # an empty table has an empty page, which holds its columns
            ends = [[None] * len(self.keys)]
        new = [(page + i, ends[i - 1] if i else after, last) for i, last in enumerate(ends)]
        size = max(1, JOB_ROWS // self.size)
        for pages in (changed, new):
            for i in range(0, len(pages), size):
                self._write_pages(table, pages[i : i + size], max((m["written_at"] for m in done), default=None))
        if changed or new:
            files.drop_folders(self.spark, self.path, SHARED, {m["folder"] for m in self.marks()})
        return [p for p, _, _ in (*changed, *new)]

    def _changed(self, table: DataFrame, done: list[Row]) -> list[int]:
        """Places in ``done`` of the pages with another number of rows in the table now, from one count of all."""
        if not done:
            return []
        known = table.filter(keyset.below(table, self.keys, done[-1]["last"]))
        ends = keyset.typed_ends(table, self.keys, [(i, m["last"]) for i, m in enumerate(done)])
        rows = known.groupBy(keyset.range_number(self.keys, ends).alias("place")).count().collect()  # one row per page
        found = {r["place"]: r["count"] for r in rows}
        return [i for i, m in enumerate(done) if m["rows"] != found.get(i, 0)]

    def _ends(self, rest: DataFrame) -> list[list[str | None]]:
        """The last key of every page; a table of one page needs no sort."""
        key = keyset.key_struct(self.keys)
        whole = rest.agg(F.count(F.lit(1)).alias("rows"), F.max(key).alias("last_key"))
        whole = whole.select("rows", keyset.struct_text(rest, self.keys, "last_key").alias("last")).first()
        if whole["rows"] <= self.size:
            return [whole["last"]] if whole["rows"] else []
        bounds = paging.page_bounds(rest, list(self.keys), self.size).orderBy("page")
        return [r["last"] for r in bounds.select(keyset.struct_text(rest, self.keys, "last_key").alias("last")).collect()]

    def _write_pages(self, table: DataFrame, pages: list[Page], known: str | None) -> None:
        """Write pages, given in order, and their marks, which come after the mark of the time ``known``."""
        if len(pages) == 1 or {"page", PAGE} & {c.lower() for c in table.columns}:  # the folders of pages are named by such a column
            for page in pages:
                self._write(table, *page, known)
            return
        try:
            empty = self._write_together(table, pages, known)
        except Exception:
            middle = len(pages) // 2
            self._write_pages(table, pages[:middle], known)
            self._write_pages(table, pages[middle:], known)
            return
        for page in empty:  # all rows of a changed page are gone; its file keeps the columns
            self._write(table, *page, known)

    def _write_together(self, table: DataFrame, pages: list[Page], known: str | None) -> list[Page]:
        """Write the pages that have rows in one pass over the table, and return the others."""
        ends, before = [], pages[0][1]
        for page, after, last in pages:
            if after != before:
                ends.append((None, after))  # pages in between stay as they are
            ends.append((page, last))
            before = last
        number = keyset.range_number(self.keys, keyset.typed_ends(table, self.keys, ends))
        rows = table.filter(keyset.between(table, self.keys, pages[0][1], pages[-1][2])).withColumn("page", number)
        if any(n is None for n, _ in ends):  # a filter searches the ranges a second time
            rows = rows.filter("page IS NOT NULL")
        placed = write_out(rows, "pages")  # pinned before they are dealt, which samples them first
        cores, row = self.spark.sparkContext.defaultParallelism, F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])
        dealt = placed.repartitionByRange(cores, "page", row)  # a short page lies in one file or two, a long one is shared
        counts = [F.count(F.lit(1)).alias("rows"), rows_hash(table.columns).alias("hash")]
        if len(pages) < SHARED_FROM:
            folder = None
            files.write_csv_folders(dealt.withColumn("page", F.lpad(F.col("page").cast("string"), 8, "0")), self.path, "page")
            seen = placed.groupBy("page").agg(*counts).collect()
            size = files.bytes_by_folder(self.spark, self.path, "page")
        else:
            folder = f"{SHARED}{uuid.uuid4().hex}"
            files.write_csv(dealt.select(F.col("page").alias(PAGE), *[F.col(f"`{c}`") for c in table.columns]), f"{self.path}/{folder}")
            seen = placed.groupBy("page").agg(*counts, F.sum(files.csv_bytes(table.columns)).alias("bytes")).collect()
            size = {r["page"]: r["bytes"] for r in seen}
        lasts, at = {page: last for page, _, last in pages}, _now(known)
        marks = [(r["page"], list(lasts[r["page"]]), r["rows"], size[r["page"]], r["hash"], at, folder) for r in seen]
        self._mark(marks, f"pages-{uuid.uuid4().hex}")
        return [p for p in pages if p[0] not in {m[0] for m in marks}]

    def _mark(self, marks: list[tuple], name: str) -> None:
        self.spark.createDataFrame(marks, MARK).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{self.marks_path}/{name}")

    def _write(self, table: DataFrame, page: int, after: keyset.Bound | None, last: keyset.Bound, known: str | None = None) -> None:
        rows = table.filter(keyset.between(table, self.keys, after, last))
        seen = Observation()  # on the tasks that write, so each row counts once however often a task runs
        files.write_csv(rows.observe(seen, F.count(F.lit(1)).alias("rows"), rows_hash(table.columns).alias("hash")), self.page_path(page))
        size = files.folder_bytes(self.spark, self.page_path(page))
        self._mark([(page, list(last), seen.get["rows"], size, seen.get["hash"], _now(known), None)], f"page={page:08d}")


def _now(known: str | None) -> str:
    """The time now, or one after ``known`` if the clock is behind."""
    now = datetime.now(timezone.utc)
    return (now if known is None else max(now, datetime.fromisoformat(known) + timedelta(microseconds=1))).isoformat()
