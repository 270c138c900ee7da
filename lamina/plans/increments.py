"""Loads that touch only what has changed: files into bronze, rows into silver, states into the daily aggregates.

Bronze tables are partitioned by parts of about PART_ROWS rows, of one file or of many small ones, silver tables and the states by a hash of the de-duplication key. What has been loaded is
in the ingestion log (bronze) and in a log of its own (silver); a step compares, works on the difference, replaces the
partitions it touches and then appends to its log. A run that stops between the two does the same work again. Files that have to be written again because
another one of their part has changed are noted before, and loaded again if that write does not end.
"""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.columns import quoted
from lamina.operators import cleaning, kpis, lineage, states
from lamina.sources import files
from lamina.sources.extracts import KeysetExtract
from lamina.sources.tables import LAYOUT, Lake

#: The file of a bronze row and the partition column of silver tables.
FILE_ID, BUCKET = "_bronze_file", "_silver_bucket"
#: Rows of the files that share a partition of a bronze table; a longer file has one of its own.
PART_ROWS = 1_000_000
TIME = "_bronze_ingestion_time"
SILVER_LOADS, STATE_LOADS, STATES = "silver_loads", "state_loads", "gold_states"
REWRITES, REWRITE = "bronze_rewrites", "dataset_key STRING, write_id STRING, file_id STRING, ingested BIGINT, done BOOLEAN"
#: The daily states of a silver table: how they are made and how they merge.
DAILY_STATES = {fixed.CASES: (kpis.daily, kpis.DAILY_KINDS), fixed.VACCINATIONS: (kpis.vaccination_daily, kpis.VACCINATION_KINDS)}
LOADED = "dataset_key STRING, local_path STRING, file_size BIGINT, content_hash STRING"


def entry_files(lake: Lake, entry: Mapping) -> list[dict]:
    """The files of a manifest entry: the finished pages of a keyset extract, else the entry itself."""
    if entry.get("pagination") != "keyset":
        return [dict(entry)]
    pages = KeysetExtract(lake.spark, entry["local_path"])
    return [
        dict(entry) | {
            "local_path": pages.page_path(m["page"]), "filename": f"{entry['filename']}/page={m['page']:08d}", "file_size": m["bytes"],
            "record_count": m["rows"], "content_hash": m["content_hash"], "ingestion_time": m["written_at"],
            "page": m["page"], "folder": m["folder"],
        }
        for m in pages.marks()
    ]


def file_id(entry: Mapping, file: Mapping) -> str:
    """What rows of a file have as FILE_ID: its name below the entry."""
    return str(file["local_path"]).rstrip("/")[len(str(entry["local_path"]).rstrip("/")) :].strip("/") or "whole"


def _file_id_column(entry: Mapping) -> Column:
    if entry.get("pagination") != "keyset":
        return F.lit("whole")
    return F.regexp_extract(files.FILE, r".*[/#](page=[0-9]+)(?:/[^/]*)?$", 1)


class BronzeLoad:
    """What of a dataset's chosen entry has to be loaded, given the ingestion log."""

    def __init__(self, lake: Lake, entry: Mapping, log: DataFrame | None):
        self.lake, self.entry, self.dataset = lake, entry, entry["dataset_key"]
        self.files = entry_files(lake, entry)
        root = str(entry["local_path"]).rstrip("/")
        known = lineage.latest_loads(log).filter(F.col("dataset_key") == self.dataset) if log is not None else None
        table = self.table = lake.read_optional("bronze", self.dataset, layout=True)
        elsewhere = known is not None and not known.filter((F.col("local_path") != root) & ~F.startswith("local_path", F.lit(root + "/"))).isEmpty()
        self.whole = known is None or table is None or not {FILE_ID, LAYOUT} <= set(table.columns) or elsewhere or known.isEmpty()
        listed = lake.spark.createDataFrame([tuple(f.get(c) for c in ("dataset_key", "local_path", "file_size", "content_hash")) for f in self.files], LOADED)
        missing = listed if self.whole else lineage.new_files(listed, known)
        paths = {r["local_path"] for r in missing.collect()}  # names of files, not rows
        self.unfinished = self._unfinished()
        known_ids = {file_id(entry, f) for f in self.files if f["local_path"] not in paths}
        # Files that are loaded again as they were, with the time (in microseconds) that their rows had.
        self.again = {r["file_id"]: r["ingested"] for r in self.unfinished if r["file_id"] in known_ids}
        self.missing = [f for f in self.files if f["local_path"] in paths or file_id(entry, f) in self.again]
        if not self.whole and any(not f.get("record_count") for f in self.missing) and self.entry.get("pagination") == "keyset":
            self.whole, self.missing = True, self.files  # a page that has lost all its rows leaves no partition to replace it by

    def _unfinished(self) -> list[Row]:
        """Files that a write that did not end may have taken out of the table."""
        seen = self.lake.read_optional("runs", REWRITES)
        if seen is None:
            return []
        own = seen.filter(F.col("dataset_key") == self.dataset)
        return own.join(own.filter("done").select("write_id"), "write_id", "left_anti").collect()  # names of files

    def _new_parts(self, found: Sequence[Mapping]) -> dict[str, str]:
        """The part of every file: files follow each other in one up to PART_ROWS rows."""
        load, parts, part, rows = uuid.uuid4().hex, {}, 0, 0
        for file in found:
            count = file.get("record_count") or 0
            if rows and rows + count > PART_ROWS:
                part, rows = part + 1, 0
            rows += count
            parts[file_id(self.entry, file)] = f"part-{load}-{part:05d}"
        return parts

    def write(self, routed: files.Routed) -> None:
        """Write the rows of the missing files, and again those of files that share a part with one that was in the table before."""
        named = routed.good.withColumn("_id", _file_id_column(self.entry)).drop(files.FILE)
        table = lineage.enrich(named, self.entry).withColumnRenamed("_id", FILE_ID)
        table = table.select(*[quoted(c) for c in table.columns if c != FILE_ID], FILE_ID)
        found = [] if self.whole else self.table.groupBy(FILE_ID, LAYOUT).agg(F.max(F.unix_micros(TIME))).collect()  # names of files
        held, times = {r[0]: r[1] for r in found}, {r[0]: r[2] for r in found}
        missing = {file_id(self.entry, f): f for f in self.missing}
        parts = self._new_parts([f for name, f in missing.items() if name not in held]) | {name: held[name] for name in missing if name in held}
        listed = [(name, part, None if self.whole else self.again.get(name)) for name, part in parts.items()]
        placed = self.lake.spark.createDataFrame(listed, f"{FILE_ID} STRING, {LAYOUT} STRING, _ingested BIGINT")
        joined = table.join(F.broadcast(placed), FILE_ID, "left").withColumn(TIME, F.coalesce(F.timestamp_micros("_ingested"), TIME))
        table = joined.select(*[quoted(c) for c in table.columns], F.coalesce(LAYOUT, F.lit("part-")).alias(LAYOUT))
        touched = {held[name] for name in missing if name in held}
        others = [name for name, part in held.items() if part in touched and name not in missing]
        write, ended = uuid.uuid4().hex, {r["write_id"] for r in self.unfinished}
        if others:
            self._note([(self.dataset, write, name, times[name], False) for name in others])
            kept = self.table.filter(F.col(LAYOUT).isin(*touched)).join(F.broadcast(placed.select(FILE_ID)), FILE_ID, "left_anti")
            table, ended = table.unionByName(kept, allowMissingColumns=True), ended | {write}
        if self.whole:
            self.lake.overwrite(table, "bronze", self.dataset, [LAYOUT])
        else:
            self.lake.replace_partitions(table, "bronze", self.dataset, [LAYOUT])
        if ended:
            self._note([(self.dataset, w, None, None, True) for w in sorted(ended)])

    def _note(self, rows: list[tuple]) -> None:
        self.lake.append(self.lake.spark.createDataFrame(rows, REWRITE), "runs", REWRITES)


def bucket_of(df: DataFrame, dataset: str, buckets: int) -> Column:
    """The bucket of a cleaned row: equal keys meet in one; without a key, equal rows do."""
    keys = [c for c in fixed.DEDUP_KEYS.get(dataset) or [] if c in df.columns] or df.columns
    return F.pmod(F.xxhash64(*[quoted(c) for c in keys]), F.lit(buckets)).cast("int")


def merge_silver(lake: Lake, dataset: str, bronze_log: DataFrame, buckets: int) -> dict:
    """Bring the silver table of a dataset up to date with its bronze files; the same rows as cleaning all of bronze anew.

    Rows of new files are cleaned and meet the stored rows of their buckets only; the kept row of a key is a minimum, so the
    minimum of old and new is that of all. Where a file has been replaced its old rows must not count any more, and the buckets in which it has
    rows, old or new, are cleaned from bronze.
    """
    loads = lineage.latest_loads(bronze_log).filter(F.col("dataset_key") == dataset)
    seen = lake.read_optional("runs", SILVER_LOADS)
    done = None if seen is None else lineage.latest_loads(seen).filter(F.col("dataset_key") == dataset)
    table = lake.read_optional("silver", dataset)
    bronze = lake.read("bronze", dataset)
    fresh = loads if done is None else lineage.new_files(loads, done)
    changed = [r.asDict() for r in fresh.collect()]  # names of files
    if table is not None and BUCKET in table.columns and done is not None and not changed:
        return {"touched": [], "read_files": 0}
    names = {r["local_path"].rstrip("/").rsplit("/", 1)[-1] if "/page=" in r["local_path"] else "whole" for r in changed}
    replaced = set() if done is None else {r["local_path"] for r in done.select("local_path").collect()} & {r["local_path"] for r in changed}

    def cleaned(rows: DataFrame) -> DataFrame:
        rows = cleaning.prepared(rows)
        return rows.withColumn(BUCKET, bucket_of(rows, dataset, buckets))

    everything = cleaned(bronze)
    if table is None or BUCKET not in table.columns or done is None:
        touched, rows = None, everything
    else:
        named = F.broadcast(lake.spark.createDataFrame([(n,) for n in sorted(names)], f"{FILE_ID} string"))  # names of files
        new = cleaned(bronze.join(named, FILE_ID, "left_semi").select(*bronze.columns))
        held = table.join(named, FILE_ID, "left_semi").select(BUCKET) if replaced else None
        marks = new.select(BUCKET) if held is None else new.select(BUCKET).union(held)
        touched = sorted(r[0] for r in marks.distinct().collect())  # at most one number per bucket
        stored = table.filter(F.col(BUCKET).isin(*touched)).select(*everything.columns)
        rows = everything.filter(F.col(BUCKET).isin(*touched)) if replaced else new.unionByName(stored)
    kept = cleaning.stamped(cleaning.deduplicate(rows.drop(BUCKET), fixed.DEDUP_KEYS.get(dataset)), dataset)
    kept = kept.withColumn(BUCKET, bucket_of(kept.drop(*cleaning.STAMPS), dataset, buckets))
    if touched is not None and replaced and rows.select(BUCKET).distinct().count() < len(touched):
        touched, kept = None, cleaning.stamped(cleaning.deduplicate(everything.drop(BUCKET), fixed.DEDUP_KEYS.get(dataset)), dataset)
        kept = kept.withColumn(BUCKET, bucket_of(kept.drop(*cleaning.STAMPS), dataset, buckets))  # a bucket is left without rows
    if touched is None:
        lake.overwrite(kept, "silver", dataset, [BUCKET])
    else:
        lake.replace_partitions(kept, "silver", dataset, [BUCKET])
    ended = {"loaded_at": F.current_timestamp(), "load_id": F.lit(uuid.uuid4().hex), "touched": F.lit(touched).cast("array<int>")}
    lake.append(lake.spark.createDataFrame([tuple(r[c] for c in _names(LOADED)) for r in changed], LOADED).withColumns(ended), "runs", SILVER_LOADS)
    return {"touched": touched, "read_files": len(changed)}


def daily_states(lake: Lake, dataset: str) -> DataFrame | None:
    """The daily aggregate of a silver table, merged from states per bucket; None without the table.

    Only buckets that silver loads have touched since their states were made are read from silver.
    """
    loads = lake.read_optional("runs", SILVER_LOADS)
    if loads is None or lake.read_optional("silver", dataset) is None:
        return None
    make, kinds = DAILY_STATES[dataset]
    own = loads.filter(F.col("dataset_key") == dataset).select("load_id", "touched").distinct()
    done = lake.read_optional("runs", STATE_LOADS)
    pending = own if done is None else own.join(done.select("load_id"), "load_id", "left_anti")
    found = pending.collect()  # one row per load
    if found:
        silver = lake.read("silver", dataset)
        if any(r["touched"] is None for r in found) or lake.read_optional(STATES, dataset) is None:
            lake.overwrite(make(silver, BUCKET), STATES, dataset, [BUCKET])
        else:
            touched = sorted({b for r in found for b in r["touched"]})
            lake.replace_partitions(make(silver.filter(F.col(BUCKET).isin(*touched)), BUCKET), STATES, dataset, [BUCKET])
        lake.append(lake.spark.createDataFrame([(r["load_id"],) for r in found], "load_id string"), "runs", STATE_LOADS)
    return states.merge(lake.read(STATES, dataset), kpis.KEY, kinds)


def _names(ddl: str) -> Sequence[str]:
    return [f.split()[0] for f in ddl.split(", ")]
