"""The registered queries: each takes (spark, folder of test tables) and returns a DataFrame."""

from collections import Counter
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.functions import fixed
from lamina.operators import cleaning, documents, kpis, lineage, paging, quality, ranged, runlog, serving, views, warehouse
from lamina.plans.fixtures import Tables, rounded
from lamina.plans.medallion import Medallion, Source, gold_tables
from lamina.session import scratch_path, spread, write_out
from lamina.sources import files, manifest, split
from lamina.sources.extracts import KeysetExtract
from lamina.sources.tables import Lake, SchemaMismatch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(Tables(spark, folder))
    return function


# Cleaning


@register
def clean_state(t: Tables) -> DataFrame:
    return cleaning.standardize_states(t.cases_raw()).select("rec_id", "state", "state_normalized")


@register
def clean_dates(t: Tables) -> DataFrame:
    return cleaning.parse_dates(t.cases_raw()).select("rec_id", "end_date", "end_date_parsed")


@register
def clean_numeric(t: Tables) -> DataFrame:
    return cleaning.cast_numbers(t.cases_raw()).select("rec_id", "new_cases", "tot_cases", "new_deaths", "tot_deaths")


@register
def fill_nulls(t: Tables) -> DataFrame:
    raw = cleaning.cast_numbers(t.cases_raw(), ["new_cases"])
    return cleaning.fill_nulls(raw).select("rec_id", "state", "new_cases", "new_deaths")


@register
def clamp_negative(t: Tables) -> DataFrame:
    return cleaning.clamp_negatives(t["customer"], ["c_acctbal"]).select("c_custkey", "c_acctbal")


def _cleaned(table: DataFrame) -> DataFrame:
    return table.drop("_silver_processed_at").withColumnRenamed("_silver_dataset", "silver_dataset")


@register
def clean_full(t: Tables) -> DataFrame:
    return _cleaned(t.cases())


@register
def clean_vaccinations(t: Tables) -> DataFrame:
    return _cleaned(t.vaccinations())


@register
def clean_respiratory(t: Tables) -> DataFrame:
    return _cleaned(cleaning.clean(t.respiratory_raw(), fixed.RESPIRATORY_DEATHS))


@register
def clean_flu(t: Tables) -> DataFrame:
    return _cleaned(cleaning.clean(t.flu_raw(), fixed.FLU_COVERAGE))


@register
def dedup_keys(t: Tables) -> DataFrame:
    return cleaning.deduplicate(spread(t["lineitem"]), ["l_orderkey", "l_linenumber"]).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )


@register
def dedup_rows(t: Tables) -> DataFrame:
    return cleaning.deduplicate(t["documents"].select("text"))


# Lineage, ingestion log, registry

FILE = {
    "source": "table://customer", "filename": "customer.csv", "ingestion_time": "2024-03-01T12:30:00Z", "format": "csv",
}


@register
def lineage_enrich(t: Tables) -> DataFrame:
    return lineage.enrich(t["customer"].select("c_custkey", "c_name"), FILE).select(
        "c_custkey", "c_name",
        F.col("_bronze_source").alias("bronze_source"), F.col("_bronze_filename").alias("bronze_filename"),
        F.col("_bronze_ingestion_time").cast("string").alias("bronze_ingestion_time"),
        F.col("_bronze_format").alias("bronze_format"),
    )


@register
def ingest_log_normalize(t: Tables) -> DataFrame:
    log = lineage.ingestion_records(t.manifest_files())
    return log.withColumn("ingestion_time", F.col("ingestion_time").cast("string"))


@register
def doc_registry(t: Tables) -> DataFrame:
    return lineage.document_registry(t.manifest_files())


# Paging


@register
def row_cap(t: Tables) -> DataFrame:
    limit = fixed.MODES["sample"]["max_rows"]
    return paging.row_cap(t["orders"], "o_orderkey", limit).select("o_orderkey", "o_custkey", "o_totalprice")


PAGE_SIZE = 1000


def _paged_orders(t: Tables) -> DataFrame:
    return paging.paginate(t["orders"].select("o_orderkey", "o_totalprice"), "o_orderkey", PAGE_SIZE)


@register
def offset_pages(t: Tables) -> DataFrame:
    return _paged_orders(t)


@register
def page_index(t: Tables) -> DataFrame:
    return paging.page_index(_paged_orders(t), "o_orderkey")


@register
def keyset_page(t: Tables) -> DataFrame:
    last_key = paging.read_after(t["orders"], "o_orderkey", None, PAGE_SIZE).agg(F.max("o_orderkey")).first()[0]
    return paging.read_after(t["orders"], "o_orderkey", last_key, PAGE_SIZE).select("o_orderkey", "o_totalprice")


# Files


@register
def keyset_walk(t: Tables) -> DataFrame:
    """All rows with their page: each lies in the range of one page."""
    table = t["orders"].select("o_orderkey", "o_totalprice")
    return paging.keyset_walk(table, "o_orderkey", 5 * PAGE_SIZE).rows()


@register
def keyset_large_page(t: Tables) -> DataFrame:
    """A page size above any default is taken as it is."""
    return paging.page_bounds(t["orders"], "o_orderkey", 60 * PAGE_SIZE)


def _days(t: Tables) -> DataFrame:
    """Orders by day, of which some are unknown and most are shared."""
    day = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("date")).alias("day")
    return t["orders"].select("o_orderkey", day, "o_custkey", "o_totalprice")


@register
def keyset_ties(t: Tables) -> DataFrame:
    """All rows with their page where the key has ties and nulls: equal keys stay together."""
    return paging.keyset_walk(_days(t).select("day", "o_orderkey"), ["day"], 2 * PAGE_SIZE).rows()


def _late(t: Tables) -> Column:
    """Orders that come in later."""
    return F.col("o_orderkey") % 10 == 7


@register
def keyset_resumed(t: Tables) -> DataFrame:
    """Rows of the pages of an extract that broke off, went on, and was run again after rows had come in everywhere; and how often each page was written."""
    table, kept = _days(t), ~_late(t)
    extract = KeysetExtract(t.spark, scratch_path(t.spark, "resumed"), ["day", "o_orderkey"], 2 * PAGE_SIZE)
    known = table.filter(kept)
    limit = known.filter("day IS NOT NULL").agg(F.max("day")).first()[0]
    broken = known.withColumn("o_totalprice", F.when(F.col("day") < F.lit(limit), F.col("o_totalprice")).otherwise(F.when(F.col("day").isNull(), F.col("o_totalprice")).otherwise(F.raise_error(F.lit("gone")).cast("double"))))
    try:
        extract.run(broken)
    except Exception:
        pass  # the last day cannot be read; the pages before it are finished
    written = [m["page"] for m in extract.marks()] + extract.run(known) + extract.run(table) + extract.run(table)
    times = t.spark.createDataFrame(list(Counter(written).items()), "page long, times_written long")
    rows = extract.route(extract.marks(), table.schema).good
    page = F.regexp_extract(files.FILE, "page=([0-9]+)", 1).cast("long")
    return rows.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("page_rows"), F.sum("o_orderkey").alias("keys")).join(times, "page", "full")


@register
def incremental_bronze(t: Tables) -> DataFrame:
    """Files that each of three loads reads, and the table after it: new rows change some files, the third load finds nothing new."""
    job = Medallion(_lake(t, "increments"), incremental=True, page_rows=PAGE_SIZE, datasets=["orders"])
    table, found = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"), []
    for load, rows in enumerate([table.filter(~_late(t)), table, table], 1):
        job.extract({"orders": Source(rows, "o_orderkey")})
        done = job.load_bronze()
        stored = job.lake.read("bronze", "orders").agg(F.count(F.lit(1)).alias("table_rows"), F.sum("o_orderkey").alias("keys"), F.countDistinct("o_orderkey").alias("different"))
        found.append(write_out(stored.select(F.lit(load).alias("load"), F.lit(done["loaded_files"]).cast("long").alias("files_read"), "*"), "load"))
    return reduce(DataFrame.unionByName, found)


def _three_loads(t: Tables, job: Medallion) -> None:
    """Cases that arrive in three parts, by record, each with its own extraction and load."""
    last = t["orders"].agg(F.max("o_orderkey")).first()[0]
    for part in (1, 2, 3):
        job.extract({fixed.CASES: Source(t.cases_raw().filter(F.col("rec_id") <= last * part // 3), "rec_id")})
        job.load_bronze()
        job.transform_dataset(fixed.CASES)


@register
def incremental_silver(t: Tables) -> DataFrame:
    """Cleaned cases after three loads, each merged with the stored rows of the buckets it touches."""
    job = Medallion(_lake(t, "merged"), incremental=True, page_rows=2 * PAGE_SIZE, datasets=[fixed.CASES], silver_buckets=8)
    _three_loads(t, job)
    return _cleaned(job.lake.read("silver", fixed.CASES).select(*t.cases().columns))


@register
def incremental_dashboard(t: Tables) -> DataFrame:
    """The dashboard after three loads of cases and vaccinations, from gold tables that are merged from states per bucket."""
    job = Medallion(_lake(t, "states"), incremental=True, page_rows=20 * PAGE_SIZE, datasets=[fixed.CASES, fixed.VACCINATIONS], silver_buckets=8)
    last = t["orders"].agg(F.max("o_orderkey")).first()[0]
    for part, until in enumerate(["1996-06-01", "1998-06-01", "9999"], 1):
        job.extract({
            fixed.CASES: Source(t.cases_raw().filter(F.col("rec_id") <= last * part // 3), "rec_id"),
            fixed.VACCINATIONS: Source(t.vaccinations_raw().filter(F.col("date") < until), "date", ["location"]),
        })
        job.load_bronze()
        job.transform_silver()
        job.build_gold()
    gold = [job.lake.read("gold", name) for name in ("kpi_cases_per_day", "kpi_deaths_per_day", "kpi_vaccination_vs_cases")]
    return rounded(views.newest_first(views.dashboard(*gold)))


@register
def malformed_records(t: Tables) -> DataFrame:
    """Records of a CSV file after its load: those in the table, and the text of those that do not fit, in the rejects."""
    job, path = Medallion(_lake(t, "malformed"), schemas={"customer": "c_custkey long, c_name string, c_nationkey int"}, datasets=["customer"]), scratch_path(t.spark, "malformed-csv")
    line = F.expr("""CASE c_custkey % 10 WHEN 1 THEN 'x' || c_custkey || ',' || c_name || ',1' WHEN 2 THEN c_custkey || ',' || c_name
        WHEN 3 THEN c_custkey || ',' || c_name || ',1,2' WHEN 4 THEN c_custkey || ',"' || c_name || ', ""the"" 4th",4' ELSE c_custkey || ',' || c_name || ',' || c_nationkey END""")
    header = t.spark.createDataFrame([("c_custkey,c_name,c_nationkey",)], "value string")
    header.union(t["customer"].select(line)).coalesce(1).write.text(path)
    job.extract({}, [{"source": "file", "filename": "customer.csv", "format": "csv", "dataset_key": "customer", "local_path": path, "file_size": 1}])
    job.load_bronze()
    good = job.lake.read("bronze", "customer").select(F.lit(True).alias("fits"), F.concat_ws("|", "c_custkey", "c_name", "c_nationkey").alias("record"))
    return good.unionByName(job.lake.read("bronze_rejects", "customer").select(F.lit(False).alias("fits"), "record"))


@register
def malformed_json(t: Tables) -> DataFrame:
    """The same for JSON documents of 1,000 records each: one record that does not fit leaves the others of its document."""
    path = scratch_path(t.spark, "malformed-json")
    record = F.when(F.col("c_custkey") % 7 == 3, F.to_json(F.struct("c_custkey", "c_name", F.lit("none").alias("c_nationkey")))).otherwise(F.to_json(F.struct("c_custkey", "c_name", "c_nationkey")))
    paged = paging.paginate(t["customer"], "c_custkey", PAGE_SIZE).groupBy("page").agg(F.array_join(F.collect_list(record), ",\n").alias("records"))
    paged.select("page", F.concat(F.lit("["), "records", F.lit("]"))).write.partitionBy("page").text(path)
    routed = files.route_json(t.spark, path, "c_custkey long, c_name string, c_nationkey int")
    return routed.rows.select(F.col(files.CORRUPT).isNull().alias("fits"), "c_custkey", "c_name", "c_nationkey", F.col(files.CORRUPT).alias("record"))


@register
def csv_roundtrip(t: Tables) -> DataFrame:
    """Empty text and null stay apart."""
    path = scratch_path(t.spark, "csv")
    table = t["documents"].withColumn("note", F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.lit("a, \"b\"")))
    files.write_csv(table, path)
    return files.read_csv(t.spark, path, table.schema, null_mark=files.NULL_MARK)


@register
def multi_csv_concat(t: Tables) -> DataFrame:
    """Two extracts with a header in each of their files, read as one table of text columns."""
    table = t["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority")
    paths = [scratch_path(t.spark, "csv-page") for _ in range(2)]
    files.write_csv(table.filter(F.col("o_orderstatus") == "F"), paths[0])
    files.write_csv(table.filter(F.col("o_orderstatus") != "F"), paths[1])
    return files.read_csv(t.spark, paths)


@register
def json_array_scan(t: Tables) -> DataFrame:
    path, table = scratch_path(t.spark, "json-pages"), t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority")
    files.write_json_documents(paging.paginate(table, "o_orderkey", PAGE_SIZE), path)
    return files.read_json_documents(t.spark, path, table.schema)


@contextmanager
def _small_blocks(spark: SparkSession, size: str):
    """Scans inside cut files into small blocks, as if the files were large."""
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@register
def csv_split_scan(t: Tables) -> DataFrame:
    """One CSV file with line breaks and doubled quotes in its values, read by many tasks."""
    path = scratch_path(t.spark, "csv-split")
    note = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('say "'), F.substring("text", 1, 300), F.lit('"\n\n'))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit('"\n'), F.substring("text", 1, 5)))
    table = t["documents"].select("doc_id", "lang", note.alias("note"), "n_chars")
    files.write_csv(table.repartition(1), path)  # the one task that writes the file gets its columns, and not the whole texts
    with _small_blocks(t.spark, "64k"):
        return write_out(split.scan_csv(t.spark, path, table.schema, files.NULL_MARK).good.drop(files.FILE), "csv-split-rows")


@register
def json_split_scan(t: Tables) -> DataFrame:
    """One JSON array of all records, nested and with braces in their text, read by many tasks."""
    path = scratch_path(t.spark, "json-split")
    table = t["conversations"].select("conv_id", F.struct("role", F.concat(F.lit('}]"{'), F.substring("text", 1, 80)).alias("said")).alias("turn"), F.array("turn").alias("turns"))
    table.groupBy().agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*table.columns))), ",\n"), F.lit("]"))).write.text(path)
    with _small_blocks(t.spark, "16k"):
        found = write_out(split.scan_json(t.spark, path, table.schema).good, "json-split-rows")
    return found.select("conv_id", "turn.role", "turn.said", F.col("turns")[0].alias("number"))


@register
def json_single_load(t: Tables) -> DataFrame:
    """A JSON extract loaded outside a manifest, with lineage made from its path."""
    path, table = scratch_path(t.spark, "json-single"), t["customer"].select("c_custkey", "c_name", "c_nationkey")
    files.write_json_documents(paging.paginate(table, "c_custkey", PAGE_SIZE), path)
    schemas = {"customers": table.schema}
    loaded = Medallion(_lake(t, "json-load"), schemas=schemas).load_json(path, "customers")
    return loaded.select(
        *table.columns, F.startswith("_bronze_source", F.lit("local://")).alias("is_local"),
        F.col("_bronze_format").alias("bronze_format"),
    )


@register
def ndjson_roundtrip(t: Tables) -> DataFrame:
    path, table = scratch_path(t.spark, "ndjson"), t["conversations"]
    files.write_ndjson(table, path)
    return files.read_ndjson(t.spark, path, table.schema)


@register
def file_inventory(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "inventory")
    t["orders"].write.partitionBy("o_orderstatus").parquet(path)
    listed = files.list_files(t.spark, path).filter(F.col("path").endswith(".parquet") & (F.col("length") > 0))
    return listed.select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()


@register
def file_lengths(t: Tables) -> DataFrame:
    """Folder and length of every file, empty ones included."""
    path = scratch_path(t.spark, "lengths")
    text = F.when(F.col("o_custkey") % 4 == 0, F.lit(None)).otherwise(F.repeat(F.lit("x"), (F.col("o_custkey") % 50).cast("int")))
    folder = t["orders"].groupBy((F.col("o_custkey") % 40).alias("folder")).agg(F.min("o_custkey").alias("o_custkey")).select("folder", text.alias("value"))
    folder.select("folder", F.coalesce("value", F.lit(""))).write.partitionBy("folder").option("lineSep", "|").text(path)
    t.spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/folder=nothing")
    listed = files.list_files(t.spark, path)
    return listed.select(F.regexp_extract("path", "folder=([^/]+)/", 1).alias("folder"), "length").groupBy("folder").agg(F.sum("length").alias("length"), F.count(F.lit(1)).alias("listed"))


# Tables


def _lake(t: Tables, name: str) -> Lake:
    return Lake(t.spark, scratch_path(t.spark, name))


@register
def missing_table_empty(t: Tables) -> DataFrame:
    """Rows of every indicator table when there are cases but no vaccinations."""
    lake = _lake(t, "partial")
    lake.overwrite(t.cases(), "silver", fixed.CASES)
    cases = lake.read_optional("silver", fixed.CASES)
    daily = kpis.daily(cases)
    builders = gold_tables(daily, lake.read_optional("silver", fixed.VACCINATIONS))
    return reduce(DataFrame.unionByName, [
        (kpis.empty(t.spark, table) if build is None else build())
        .agg(F.count(F.lit(1)).alias("table_rows")).withColumn("table_name", F.lit(table))
        for table, build in builders.items()
    ])


@register
def schema_enforced_overwrite(t: Tables) -> DataFrame:
    """A table replaced by one of the same columns, after one with other columns was refused."""
    lake, table = _lake(t, "enforced"), t["customer"]
    lake.overwrite_enforced(table.limit(0), "silver", "customer")
    try:
        lake.overwrite_enforced(table.withColumn("c_acctbal", F.col("c_acctbal").cast("string")), "silver", "customer")
    except SchemaMismatch:
        lake.overwrite_enforced(table, "silver", "customer")
    return lake.read("silver", "customer")


@register
def append_log(t: Tables) -> DataFrame:
    lake, entries = _lake(t, "log"), t.manifest_files()
    for part in (manifest.documents(entries), entries.filter(F.col("format") != "pdf")):
        lake.append(lineage.ingestion_records(part), "bronze", "ingestion_log")
    return lake.read("bronze", "ingestion_log").groupBy("format", "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"),
        F.max("ingestion_time").cast("date").alias("last_date"),
    )


@register
def silver_counts(t: Tables) -> DataFrame:
    """Rows before and after the cleaning of each dataset, counted in the stored tables."""
    job = Medallion(_lake(t, "silver"), mode="full", datasets=[fixed.CASES, fixed.RESPIRATORY_DEATHS])
    job.lake.overwrite(t.cases_raw(), "bronze", fixed.CASES)
    job.lake.overwrite(t.respiratory_raw(), "bronze", fixed.RESPIRATORY_DEATHS)
    counts = [r for r in job.transform_silver()["transformations"] if r["dataset"] in job.datasets]
    return t.spark.createDataFrame(
        [(c["dataset"], c["input_rows"], c["output_rows"], c["rejected_rows"], c["status"]) for c in counts],
        "dataset string, input_rows long, output_rows long, rejected_rows long, status string",
    )


# Manifest


@register
def manifest_scan(t: Tables) -> DataFrame:
    """Manifests of up to 1,000 files each are written as nested documents, read and flattened."""
    names = [f.name for f in StructType.fromDDL(fixed.MANIFEST_FILE_SCHEMA)]
    entries = t.manifest_files()
    entry = F.struct(*[F.col(c) if c in entries.columns else F.lit(None).cast("string").alias(c) for c in names])
    paged = paging.paginate(entries, "position", PAGE_SIZE)
    nested = paged.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", entry.alias("file")))), lambda x: x["file"]).alias("files")
    )
    path = scratch_path(t.spark, "manifests")
    files.write_ndjson(nested.select(F.lit("full").alias("mode"), F.size("files").alias("total_files"), "files"), path)
    return manifest.read_manifest(t.spark, path, multi_line=False).select(
        "position", "dataset_key", "format", "file_size", "filename", "status"
    )


@register
def manifest_best_format(t: Tables) -> DataFrame:
    return manifest.structured_files(t.manifest_files().select("dataset_key", "position", "format", "file_size"))


@register
def manifest_best_format_many(t: Tables) -> DataFrame:
    """The same choice where the entries of a dataset are spread over many manifests, whose positions all start at 0."""
    names = [f.name for f in StructType.fromDDL(fixed.MANIFEST_FILE_SCHEMA)]
    entries = t.manifest_files()
    entry = F.struct(*[F.col(c) if c in entries.columns else F.lit(None).cast("string").alias(c) for c in names])
    nested = paging.paginate(entries, "position", PAGE_SIZE).groupBy(F.lpad(F.col("page").cast("string"), 9, "0").alias("part")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", entry.alias("file")))), lambda x: x["file"]).alias("files")
    )
    path = scratch_path(t.spark, "many-manifests")
    nested.write.partitionBy("part").option("ignoreNullFields", False).json(path)
    listed = manifest.read_manifest(t.spark, path, multi_line=False)
    return manifest.structured_files(listed).select("dataset_key", "format", "file_size", "filename")


@register
def failing_source(t: Tables) -> DataFrame:
    """The manifest of an extraction in which one of two sources fails."""
    job = Medallion(_lake(t, "failing"))
    broken = t["nation"].select(F.raise_error(F.lit("no such page")).cast("string").alias("n_name"))
    job.extract({"customer": Source(t["customer"], "c_custkey"), "broken": Source(broken, "n_name")})
    listed = manifest.read_manifest(t.spark, job.manifest_path)
    return listed.select("filename", "format", F.when(F.startswith("status", F.lit("error")), "error").otherwise(F.col("status")).alias("status"), "dataset_key", "record_count")


@register
def manifest_written(t: Tables) -> DataFrame:
    """Mode, totals and records of the manifest of a sample extraction, in both formats."""
    job = Medallion(_lake(t, "written"), mode="sample")
    done = job.extract({"customer": Source(t["customer"], "c_custkey"), "orders": Source(t["orders"], "o_orderkey")})
    document = t.spark.read.schema(fixed.MANIFEST_SCHEMA).json(job.manifest_path)
    total = F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + f["file_size"])
    return document.select(
        "mode", "total_files", (F.col("total_size_bytes") == total).alias("sizes_agree"), (F.col("total_size_bytes") == done["total_size_bytes"]).alias("reported"),
        F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + f["record_count"]).alias("records"),
    )


@register
def manifest_totals(t: Tables) -> DataFrame:
    return manifest.totals(t.manifest_files())


# Indicators


def _daily(t: Tables) -> DataFrame:
    return kpis.daily(t.cases())


def _vaccination_vs_cases(t: Tables) -> DataFrame:
    return kpis.vaccination_vs_cases(kpis.vaccination_daily(t.vaccinations()), _daily(t))


def _dashboard(t: Tables) -> DataFrame:
    return views.dashboard_from_daily(_daily(t), kpis.vaccination_daily(t.vaccinations()))


def _regional(t: Tables) -> DataFrame:
    return views.regional_summary(kpis.incidence_by_region(_daily(t)))


def _trends(t: Tables) -> DataFrame:
    return views.temporal_trends(kpis.temporal_evolution(_daily(t)))


@register
def kpi_incidence(t: Tables) -> DataFrame:
    return rounded(kpis.incidence_by_region(_daily(t)))


@register
def kpi_cases_per_day(t: Tables) -> DataFrame:
    return rounded(kpis.cases_per_day(_daily(t)))


@register
def kpi_deaths_per_day(t: Tables) -> DataFrame:
    return rounded(kpis.deaths_per_day(_daily(t)))


@register
def kpi_hospitalizations(t: Tables) -> DataFrame:
    return rounded(kpis.hospitalizations_by_region(_daily(t)))


@register
def kpi_vaccination_vs_cases(t: Tables) -> DataFrame:
    return rounded(_vaccination_vs_cases(t))


@register
def kpi_temporal_evolution(t: Tables) -> DataFrame:
    return rounded(kpis.temporal_evolution(_daily(t)))


# Warehouse


def _coerced(table: str, rows: DataFrame) -> DataFrame:
    return warehouse.coerce(kpis.stamped(rows), warehouse.schema_of(table)).drop("updated_at")


@register
def warehouse_cast(t: Tables) -> DataFrame:
    rows = _coerced("kpi_hospitalizations_by_region", kpis.hospitalizations_by_region(_daily(t)))
    return warehouse.accepted(rows)


@register
def warehouse_rejects(t: Tables) -> DataFrame:
    rows = _coerced("kpi_temporal_evolution_by_state", kpis.temporal_evolution(_daily(t)))
    return rounded(warehouse.rejected(rows))


@register
def reject_reasons(t: Tables) -> DataFrame:
    """Text beyond its length and numbers beyond their type, by reason."""
    rows = t["customer"].select(
        F.expr("repeat('x', 95 + CAST(c_custkey % 10 AS INT))").alias("region"), F.lit("CA").alias("state"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(1e19)).otherwise(F.col("c_acctbal")).alias("total_cases"), F.lit(0.0).alias("total_deaths"),
        F.lit(0.0).alias("incidence_rate"), F.lit(0.0).alias("mortality_rate"), F.lit("2024-01-01").cast("date").alias("report_date"),
    )
    bad = warehouse.rejected(warehouse.coerce(rows, warehouse.schema_of("kpi_incidence_by_region")))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


@register
def warehouse_views(t: Tables) -> DataFrame:
    """The dashboard as the warehouse serves it by name, joined from its stored tables."""
    job = Medallion(_lake(t, "views"))
    job.lake.overwrite(t.cases(), "silver", fixed.CASES)
    job.lake.overwrite(t.vaccinations(), "silver", fixed.VACCINATIONS)
    job.build_gold()
    job.load_warehouse()
    job.register_views()
    return t.spark.sql(
        "SELECT report_date, state, new_cases, cumulative_cases, new_deaths, cumulative_deaths, doses_administered, fully_vaccinated FROM v_kpi_dashboard"
    )


@register
def gold_input_unreadable(t: Tables) -> DataFrame:
    """Status of the indicators, and rows that they keep, when the folder of the cases has lost its files."""
    job = Medallion(_lake(t, "unreadable"))
    job.lake.overwrite(t.cases(), "silver", fixed.CASES)
    job.build_gold()
    # an empty partitioned table leaves a folder without any data file
    t.cases().limit(0).write.mode("overwrite").partitionBy("state").parquet(job.lake.path("silver", fixed.CASES))
    status = job.build_gold()["status"]
    return job.lake.read("gold", "kpi_cases_per_day").agg(F.count(F.lit(1)).alias("kept_rows")).select(F.lit(status).alias("status"), "kept_rows")


@register
def warehouse_load(t: Tables) -> DataFrame:
    lake = _lake(t, "warehouse")
    rows = warehouse.accepted(_coerced("kpi_cases_per_day", kpis.cases_per_day(_daily(t))))
    lake.overwrite(warehouse.with_ids(rows), "warehouse", "kpi_cases_per_day")
    return lake.read("warehouse", "kpi_cases_per_day")


@register
def run_metadata(t: Tables) -> DataFrame:
    """One run-metadata row per indicator table, appended to a log and read back."""
    lake, schema = _lake(t, "metadata"), StructType.fromDDL(fixed.RUN_METADATA_SCHEMA)
    builders = gold_tables(_daily(t), t.vaccinations())
    loaded = reduce(DataFrame.unionByName, [
        _coerced(table, build()).agg(
            F.lit("gold").alias("layer"), F.lit(table).alias("job_name"), F.lit("silver").alias("source"),
            F.count(F.when(F.col(warehouse.REASON).isNull(), 1)).alias("records_processed"),
            F.count(warehouse.REASON).alias("records_rejected"), F.lit("success").alias("status"),
        )
        for table, build in builders.items()
    ])
    lake.append(warehouse.accepted(warehouse.coerce(loaded, schema)), "warehouse", "run_metadata")
    return lake.read("warehouse", "run_metadata").select(
        "layer", "job_name", "source", "records_processed", "records_rejected", "status"
    )


# Views


@register
def v_kpi_dashboard(t: Tables) -> DataFrame:
    return rounded(views.newest_first(_dashboard(t)))


@register
def v_regional_summary(t: Tables) -> DataFrame:
    return rounded(views.most_cases_first(_regional(t)))


@register
def v_temporal_trends(t: Tables) -> DataFrame:
    return rounded(views.by_state_and_date(_trends(t)))


@register
def v_temporal_trends_ranged(t: Tables) -> DataFrame:
    """The same without a window over whole groups."""
    return rounded(views.temporal_trends(kpis.temporal_evolution(_daily(t)), ranged=True))


@register
def event_gaps(t: Tables) -> DataFrame:
    """The previous event of each type, of which there are a few with very many events each."""
    events = t["events"].select("event_type", "event_id", "ts")
    found = ranged.with_previous(events, ["event_type"], [F.asc("ts"), F.asc("event_id")], "event_id", "previous_event")
    return found.select("event_type", "event_id", "previous_event")


# Serving


def _without_national(table: DataFrame) -> DataFrame:
    return table.filter(~serving.is_national(F.col("state")))


@register
def summary(t: Tables) -> DataFrame:
    daily = _daily(t)
    vaccination = kpis.vaccination_vs_cases(kpis.vaccination_daily(t.vaccinations()), daily)
    return rounded(serving.summary_from_daily(daily, vaccination))


@register
def summary_with_fallback(t: Tables) -> DataFrame:
    """The three tables as they would be read from the warehouse, without a national row."""
    daily, vaccination = _daily(t), _without_national(_vaccination_vs_cases(t))
    return rounded(serving.summary(kpis.cases_per_day(daily), kpis.deaths_per_day(daily), vaccination))


@register
def national_snapshot(t: Tables) -> DataFrame:
    return rounded(serving.national_snapshot(_vaccination_vs_cases(t)))


@register
def latest_per_state(t: Tables) -> DataFrame:
    return rounded(serving.latest_per_state(_vaccination_vs_cases(t)))


@register
def top_states(t: Tables) -> DataFrame:
    return rounded(serving.top_states(_dashboard(t), 10))


@register
def top_states_by_cases(t: Tables) -> DataFrame:
    totals = kpis.cases_per_day(_daily(t)).groupBy("state").agg(F.sum("new_cases").alias("total_cases"))
    return rounded(totals.orderBy(F.desc("total_cases"), "state").limit(10))


@register
def timeline_cases(t: Tables) -> DataFrame:
    daily = _daily(t)
    return rounded(serving.timeline("cases", kpis.cases_per_day(daily), kpis.deaths_per_day(daily)))


@register
def timeline_deaths(t: Tables) -> DataFrame:
    daily = _daily(t)
    return rounded(serving.timeline("deaths", kpis.cases_per_day(daily), kpis.deaths_per_day(daily)))


@register
def regional_top(t: Tables) -> DataFrame:
    return rounded(serving.regional_top(_regional(t), 10))


@register
def regional_sample(t: Tables) -> DataFrame:
    return rounded(views.most_cases_first(_regional(t)).limit(20))


@register
def dashboard_latest(t: Tables) -> DataFrame:
    return rounded(serving.dashboard_latest(_dashboard(t), 50))


@register
def json_records(t: Tables) -> DataFrame:
    daily = _daily(t)
    values = serving.timeline("cases", kpis.cases_per_day(daily), kpis.deaths_per_day(daily))
    return serving.records(values.withColumn("value", F.col("value").cast("bigint")))


@register
def last_30_days(t: Tables) -> DataFrame:
    dashboard = _dashboard(t)
    as_of = kpis.cases_per_day(_daily(t)).agg(F.max("report_date")).scalar()
    return rounded(serving.trailing(dashboard, as_of, 30).orderBy(F.desc_nulls_first("report_date")))


@register
def last_30_days_stored(t: Tables) -> DataFrame:
    """The same from gold tables partitioned by month, of which the last months are read."""
    job = Medallion(_lake(t, "months"), by_month=True)
    job.lake.overwrite(t.cases(), "silver", fixed.CASES)
    job.lake.overwrite(t.vaccinations(), "silver", fixed.VACCINATIONS)
    job.build_gold()
    return rounded(job.last_days(30, "gold"))


@register
def state_metric_trend(t: Tables) -> DataFrame:
    return rounded(serving.metric_trend(_trends(t), "California", "new_cases"))


@register
def weekly_deaths(t: Tables) -> DataFrame:
    return rounded(serving.weekly_deaths(kpis.deaths_per_day(_daily(t))))


@register
def avg_rate_by_state(t: Tables) -> DataFrame:
    return rounded(serving.rate_by_state(_vaccination_vs_cases(t)))


@register
def latest100_top10(t: Tables) -> DataFrame:
    return rounded(serving.recent_top_states(kpis.cases_per_day(_daily(t))))


@register
def sql_with_parameters(t: Tables) -> DataFrame:
    kpis.cases_per_day(_daily(t)).createOrReplaceTempView("cases_by_day")
    return rounded(serving.query(
        t.spark, "SELECT state, sum(new_cases) AS total FROM cases_by_day WHERE report_date >= :since GROUP BY state",
        {"since": "1998-01-01"},
    ))


# Documents


@register
def doc_pages(t: Tables) -> DataFrame:
    return documents.page_records(t.pages(), max_pages=fixed.MODES["sample"]["max_pages"])


@register
def doc_text(t: Tables) -> DataFrame:
    return documents.document_text(documents.page_records(t.pages()), fixed.FULL_TEXT_CHARS).drop("text_preview")


@register
def doc_full_text(t: Tables) -> DataFrame:
    """The whole text of every document."""
    return documents.document_text(documents.page_records(t.pages())).drop("text_preview")


@register
def doc_text_long(t: Tables) -> DataFrame:
    return documents.document_text(documents.page_records(t.long_pages()), fixed.FULL_TEXT_CHARS).drop("text_preview")


@register
def doc_decoded(t: Tables) -> DataFrame:
    """Conversations written as text files of a page per line and decoded again; one kind of file cannot be decoded."""
    path = scratch_path(t.spark, "decoded")
    turns = t["conversations"].select("conv_id", F.struct("turn", F.translate("text", "\n\r", "  ").alias("line")).alias("turn"))
    whole = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("turn")), lambda x: x["line"]), "\n").alias("text"))
    broken = F.when(F.col("conv_id") % 5 == 2, F.lit("\u0000")).otherwise(F.lit(""))
    whole.select("conv_id", F.concat(broken, "text").alias("text")).write.partitionBy("conv_id").text(path)

    def decoder(content: bytes) -> list[str]:
        if content.startswith(b"\0"):
            raise ValueError("not a text file")
        return content.decode().removesuffix("\n").split("\n")

    job = Medallion(_lake(t, "documents"), datasets=[])
    job.load_documents(path, decoder, "*.txt")
    decoded = job.lake.read("bronze", "document_pages")
    conv = F.regexp_extract("source_file", "conv_id=([0-9]+)", 1).cast("long").alias("conv_id")
    return decoded.groupBy(conv).agg(F.count("page_number").alias("pages"), F.sum(F.length("text")).cast("long").alias("characters"), F.max("error").alias("error"))


@register
def doc_preview(t: Tables) -> DataFrame:
    return documents.document_text(documents.page_records(t.pages())).select("source_file", "total_pages", "text_preview")


# Quality


def _results(df: DataFrame, dataset: str) -> DataFrame:
    return rounded(quality.validate(df, dataset)).fillna("", ["column_name", "note"])


@register
def quality_cases(t: Tables) -> DataFrame:
    return _results(t.cases_raw(), fixed.CASES)


@register
def quality_vaccinations(t: Tables) -> DataFrame:
    return _results(t.vaccinations(), fixed.VACCINATIONS)


@register
def quality_respiratory(t: Tables) -> DataFrame:
    return _results(t.respiratory_raw(), fixed.RESPIRATORY_DEATHS)


@register
def quality_flu(t: Tables) -> DataFrame:
    return _results(t.flu_raw(), fixed.FLU_COVERAGE)


@register
def quality_default(t: Tables) -> DataFrame:
    return _results(t["lineitem"], "lineitem")


@register
def quality_empty(t: Tables) -> DataFrame:
    """The suite over a selection that matches no row."""
    return _results(t.cases_raw().filter(F.col("tot_cases").try_cast("double") < 0), fixed.CASES)


def _all_results(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.validate(t.cases_raw(), fixed.CASES),
        quality.validate(t.vaccinations(), fixed.VACCINATIONS),
        quality.validate(t.respiratory_raw(), fixed.RESPIRATORY_DEATHS),
        quality.validate(t.flu_raw(), fixed.FLU_COVERAGE),
    ])


@register
def quality_summary(t: Tables) -> DataFrame:
    return rounded(quality.dataset_summary(_all_results(t)))


@register
def quality_edge_cases(t: Tables) -> DataFrame:
    """Summaries of an empty suite, of a broken and an unknown expectation, and of a table that cannot be read."""
    results = [
        quality.validate(t["customer"], "no_suite", []),
        quality.validate(t["customer"], "broken_suite", [(fixed.NOT_NULL, {}), ("expect_something_new", {"column": "c_name"}), (fixed.NOT_NULL, {"column": "c_custkey"})]),
        quality.unreadable(t.spark, "unreadable", "table not found"),
    ]
    summary = quality.dataset_summary(reduce(DataFrame.unionByName, results), ["no_suite", "broken_suite", "unreadable"])
    return rounded(summary)


@register
def quality_report(t: Tables) -> DataFrame:
    """The report of a quality step, read back from its file."""
    job = Medallion(_lake(t, "report"), datasets=[fixed.CASES, fixed.VACCINATIONS])
    job.lake.overwrite(t.cases_raw(), "silver", fixed.CASES)
    job.lake.overwrite(t.vaccinations(), "silver", fixed.VACCINATIONS)
    job.check_quality()
    report = t.spark.read.schema(quality.RESULT_SCHEMA).json(job.lake.path("quality", "report"))
    return rounded(report).fillna("", ["column_name", "note"])


def _routed(t: Tables) -> tuple[Lake, DataFrame]:
    lake = _lake(t, "quarantine")
    reports = [quality.validate_and_route(rows, name, lambda bad, name=name: lake.overwrite(bad, "quarantine", name))
               for name, rows in ((fixed.CASES, t.cases_raw()), (fixed.FLU_COVERAGE, t.flu_raw()))]
    return lake, reduce(DataFrame.unionByName, reports)


@register
def quality_routed(t: Tables) -> DataFrame:
    """The report of two suites, from the pass that stores the rows that break a rule."""
    return rounded(_routed(t)[1]).fillna("", ["column_name", "note"])


@register
def quality_quarantine(t: Tables) -> DataFrame:
    """The rows that break rules of the two suites, with the rules."""
    lake, _ = _routed(t)
    rules = F.array_join("broken_rules", ", ").alias("rules")
    cases = lake.read("quarantine", fixed.CASES).select(F.lit(fixed.CASES).alias("dataset"), F.col("rec_id").cast("string").alias("row"), quality.VERDICT, rules)
    flu = lake.read("quarantine", fixed.FLU_COVERAGE).select(F.lit(fixed.FLU_COVERAGE), F.concat_ws("|", "year_season", "month", "geography", "dimension", "coverage_estimate"), quality.VERDICT, rules)
    return cases.union(flu).withColumnRenamed(quality.VERDICT, "verdict").groupBy("dataset", "row", "verdict", "rules").agg(F.count(F.lit(1)).alias("times"))


@register
def quality_totals(t: Tables) -> DataFrame:
    return quality.run_summary(quality.dataset_summary(_all_results(t)))


# Run log


@register
def run_files(t: Tables) -> DataFrame:
    return rounded(runlog.files_read(t.run_log(), ["layer", "format", "status"]))


@register
def run_rows(t: Tables) -> DataFrame:
    return rounded(runlog.rows_inserted(t.run_log()))


@register
def run_rejects(t: Tables) -> DataFrame:
    return rounded(runlog.rows_rejected(t.run_log()))


@register
def run_duration_mean(t: Tables) -> DataFrame:
    return rounded(runlog.mean_duration(t.run_log()))


@register
def run_duration_hist(t: Tables) -> DataFrame:
    return runlog.duration_histogram(t.run_log())


@register
def run_errors(t: Tables) -> DataFrame:
    return rounded(runlog.errors(t.run_log(), ["layer", "job_name", "error_type"]))


@register
def run_bytes(t: Tables) -> DataFrame:
    return rounded(runlog.bytes_processed(t.run_log()))


@register
def run_freshness(t: Tables) -> DataFrame:
    return runlog.freshness(t.run_log(), F.lit("2024-02-01 00:00:00"))


@register
def published_volumes(t: Tables) -> DataFrame:
    """Rows kept and dropped per dataset, as the run log of a cleaning step reports them."""
    job = Medallion(_lake(t, "published"), mode="full", datasets=[fixed.CASES, fixed.VACCINATIONS])
    job.lake.overwrite(t.cases_raw(), "bronze", fixed.CASES)
    job.lake.overwrite(t.vaccinations_raw(), "bronze", fixed.VACCINATIONS)
    job.run(["silver"])
    log = job.log.read().filter(F.col("metric").isin(runlog.ROWS, runlog.REJECTS))
    return log.groupBy("layer", "dataset", "metric", "mode").agg(F.sum("value").alias("rows"))


@register
def published_reasons(t: Tables) -> DataFrame:
    """What a cleaning step did to the values of two datasets, by reason, as its run log has it."""
    job = Medallion(_lake(t, "reasons"), mode="full", datasets=[fixed.CASES, fixed.RESPIRATORY_DEATHS])
    job.lake.overwrite(t.cases_raw(), "bronze", fixed.CASES)
    job.lake.overwrite(t.respiratory_raw(), "bronze", fixed.RESPIRATORY_DEATHS)
    job.run(["silver"])
    return runlog.values_replaced(job.log.read())


@register
def published_bytes(t: Tables) -> DataFrame:
    """Layers and directions whose bytes a whole run logs, and whether they agree with the files."""
    job = Medallion(_lake(t, "bytes"), mode="full", datasets=[fixed.CASES])
    job.run(sources={fixed.CASES: Source(t.cases_raw(), "rec_id")})
    log = runlog.bytes_processed(job.log.read())
    held = t.spark.createDataFrame([(layer, float(sum(files.folder_bytes(t.spark, job.lake.path(layer, n)) for n in names))) for layer, names in {
        "bronze": [fixed.CASES], "silver": [fixed.CASES], "gold": list(fixed.GOLD_SCHEMAS), "warehouse": list(fixed.GOLD_SCHEMAS),
    }.items()], "layer string, held double")
    written = log.join(held, "layer").filter("direction = 'write'").select("layer", "direction", (F.col("bytes") == F.col("held")).alias("agrees"))
    return written.unionByName(log.filter("direction = 'read'").select("layer", "direction", (F.col("bytes") > 0).alias("agrees")))


@register
def published_durations(t: Tables) -> DataFrame:
    """Steps of two runs with their durations and errors, one of which fails in the quality gate."""
    job = Medallion(_lake(t, "durations"), mode="full", datasets=[fixed.CASES, fixed.VACCINATIONS])
    job.lake.overwrite(t.cases_raw(), "bronze", fixed.CASES)
    job.run(["silver"])
    try:
        job.run(["silver", "quality", "gold"], gate=True)
    except RuntimeError:
        pass  # there are no vaccinations, and the gate stops the run
    log = job.log.read()
    steps = runlog.duration_histogram(log).filter("le = '+Inf'").drop("le")
    return steps.join(runlog.errors(log, ["layer", "job_name", "error_type"]), ["layer", "job_name"], "left").join(
        runlog.mean_duration(log).select("layer", "job_name", (F.col("mean_seconds") > 0).alias("timed")), ["layer", "job_name"])


# The whole run


@register
def end_to_end(t: Tables) -> DataFrame:
    """Rows of all tables after a full run from raw files to the warehouse, and values of those of gold and warehouse."""
    job = Medallion(_lake(t, "run"), mode="full", datasets=fixed.DATASETS)
    job.run(
        sources={
            fixed.CASES: Source(t.cases_raw(), "rec_id"),
            fixed.VACCINATIONS: Source(t.vaccinations_raw(), "date"),
            fixed.RESPIRATORY_DEATHS: Source(t.respiratory_raw(), "week_ending_date"),
            fixed.FLU_COVERAGE: Source(t.flu_raw(), "geography"),
        },
        pages=t.pages(),
    )
    written = [("bronze", d) for d in fixed.DATASETS] + [("silver", d) for d in [*fixed.DATASETS, "document_text"]]
    written += [(layer, table) for layer in ("gold", "warehouse") for table in fixed.GOLD_SCHEMAS]
    return reduce(DataFrame.unionByName, [_contents(job.lake.read(layer, table), layer, table) for layer, table in written])


VALUES = {
    "kpi_incidence_by_region": "total_cases", "kpi_cases_per_day": "new_cases", "kpi_deaths_per_day": "new_deaths",
    "kpi_hospitalizations_by_region": "hospitalized", "kpi_vaccination_vs_cases": "doses_administered", "kpi_temporal_evolution_by_state": "metric_value",
}


def _contents(rows: DataFrame, layer: str, table: str) -> DataFrame:
    value = F.round(F.sum(VALUES[table]).cast("double"), 2) if table in VALUES else F.lit(None).cast("double")
    dates = [f("report_date") if table in VALUES else F.lit(None).cast("date") for f in (F.min, F.max)]
    found = rows.agg(F.count(F.lit(1)).alias("table_rows"), value.alias("total"), dates[0].alias("first_date"), dates[1].alias("last_date"))
    return found.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "table_rows", "total", "first_date", "last_date")
