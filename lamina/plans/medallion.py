"""The batch run: extract, bronze, silver, quality, gold, warehouse, and its run log.

Tables hold the data between the steps, so a step can be repeated on its own. Only
file lists and step results, one entry per dataset or table, come to the driver.
"""

import argparse
import json
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.functions import fixed
from lamina.operators import cleaning, documents, kpis, lineage, paging, quality, runlog, serving, views, warehouse
from lamina.plans import increments
from lamina.session import build_session, size_session
from lamina.sources import extracts, files, manifest
from lamina.sources.tables import Lake

STEPS = ["extract", "bronze", "silver", "quality", "gold", "warehouse"]
LOG = "ingestion_log"
REGISTRY = "document_registry"
PAGES = "document_pages"
DOCUMENT_TEXT = "document_text"
RUN_METADATA = "run_metadata"
REJECTS = "bronze_rejects"


@dataclass(frozen=True)
class Source:
    """A table to extract, the column that orders its pages and those that break its ties."""

    table: DataFrame
    key: str
    ties: Sequence[str] = ()


@dataclass
class Medallion:
    lake: Lake
    mode: str = "full"
    datasets: Sequence[str] = tuple(fixed.DATASETS)
    # Column types of the files; a dataset without an entry is read as text. Extracts made here add their own.
    schemas: Mapping[str, StructType | str] = field(default_factory=dict)
    # Without line breaks inside CSV values a file can be split among tasks.
    multi_line: bool = True
    # Tables that are worked on at the same time within a step.
    parallel: int = 6
    # Bronze loads only files that are new or changed, silver only rewrites the buckets of their rows.
    incremental: bool = False
    # Gold and warehouse tables are partitioned by month, so that a query of some days reads a month or two.
    by_month: bool = False
    # The quality step stores rows that break a rule in quarantine/, in the same pass that makes the report.
    quarantine: bool = False
    # Rows of a page of a full extract, and buckets of a silver table; both are kept as long as the tables.
    page_rows: int = extracts.PAGE_ROWS
    silver_buckets: int = 64

    def __post_init__(self) -> None:
        if self.mode not in fixed.MODES:
            raise ValueError(f"mode must be one of {sorted(fixed.MODES)}")
        self.spark = self.lake.spark
        self.limits = fixed.MODES[self.mode]
        self.manifest_path = self.lake.path("raw", "manifest")
        self.log = runlog.RunLog(self.spark, self.lake.path("runs", "log"), mode=self.mode)

    def _each(self, job: Callable, items: Iterable) -> list:
        """Results of ``job`` per item, in order. The Spark jobs of different tables run side by side."""
        with ThreadPoolExecutor(self.parallel) as pool:
            return list(pool.map(job, items))

    # Extraction

    def extract(self, sources: Mapping[str, Source], more_files: Sequence[dict] = (), fresh: bool = False) -> dict:
        """Write every source as CSV (in sample mode also as JSON pages) and list the files in the manifest.

        In full mode a source is written in keyset pages and an extract that is in place is continued: only pages that are missing or have
        other rows now are written. ``fresh`` starts anew.

        A source that fails is listed with its error; the others go on. ``more_files`` are
        entries of files that are already in place, such as documents.
        """
        if not sources and not more_files:  # nothing to list: a manifest that is in place stays as it is
            return {"status": "no_sources", "total_files": 0, "total_size_bytes": 0}
        self.schemas = {name: source.table.schema for name, source in sources.items()} | dict(self.schemas)
        kinds = ["json", "csv"] if self.mode == "sample" else ["csv"]
        wanted = [(name, source, kind) for kind in kinds for name, source in sources.items()]
        entries = [*self._each(lambda e: self._extract_one(*e, fresh), wanted), *more_files]
        manifest.write_manifest(self.spark, self.manifest_path, entries, self.mode, _now())
        failed = [e for e in entries if str(e.get("status", "")).startswith("error")]
        return {
            "status": "partial" if failed else "success", "total_files": len(entries),
            "total_size_bytes": sum(e.get("file_size") or 0 for e in entries),
        }

    def _extract_one(self, name: str, source: Source, kind: str, fresh: bool) -> dict:
        path = self.lake.path("raw", f"{kind}/{name}")
        if self.limits["pagination"] == "keyset":
            return self._extract_pages(name, source, path, fresh)
        entry = {
            "source": f"table://{name}", "filename": f"{name}.{kind}", "ingestion_time": _now(), "format": kind,
            "pagination": "offset" if kind == "json" else None,  # only JSON extracts are written by pages
        }
        try:
            rows = paging.row_cap(source.table, source.key, self.limits["max_rows"])
            # Counted by the tasks that write, so the files are not read again.
            written = Observation()
            counted = (paging.paginate(rows, source.key) if kind == "json" else rows).observe(written, F.count(F.lit(1)).alias("rows"))
            if kind == "json":
                files.write_json_documents(counted, path)
            else:
                files.write_csv(counted, path)
            count = written.get["rows"]
            size = files.folder_bytes(self.spark, path)
            return entry | {
                "status": "success", "dataset_key": name, "local_path": path, "record_count": count, "file_size": size,
            }
        except Exception as error:
            return entry | {"status": f"error: {error}", "file_size": 0}

    def _extract_pages(self, name: str, source: Source, path: str, fresh: bool) -> dict:
        entry = {"source": f"table://{name}", "filename": f"{name}.csv", "ingestion_time": _now(), "format": "csv", "pagination": "keyset"}
        pages = extracts.KeysetExtract(self.spark, path, [source.key, *source.ties], self.page_rows)
        try:
            pages.run(source.table, fresh)
            marks = pages.marks()
            return entry | {
                "status": "success", "dataset_key": name, "local_path": path, "record_count": sum(m["rows"] for m in marks),
                "file_size": sum(m["bytes"] for m in marks),
            }
        except Exception as error:  # finished pages stay, and the next run goes on after them
            return entry | {"status": f"error: {error}", "file_size": 0}

    # Bronze

    def load_bronze(self, manifest_path: str | None = None) -> dict:
        """Load the chosen file of every dataset, register the documents and append to the ingestion log."""
        try:
            listed = manifest.read_manifest(self.spark, manifest_path or self.manifest_path)
        except PySparkException as error:
            return {"status": "error", "loaded_datasets": [], "total_files": 0, "errors": [f"manifest: {error}"]}
        chosen = [row.asDict() for row in manifest.structured_files(listed).collect()]
        log = self.lake.read_optional("bronze", LOG) if self.incremental else None
        found = self._each(lambda entry: self._load_entry(entry, log), chosen)
        records = [file for result in found for file in result.get("files", ())]
        loaded = [entry["dataset_key"] for entry, r in zip(chosen, found, strict=True) if "error" not in r and entry["format"] in ("json", "csv")]
        errors = [r["error"] for r in found if "error" in r]
        registered = lineage.document_registry(listed)
        if not registered.isEmpty():
            self.lake.overwrite(registered, "bronze", REGISTRY)
        logged = manifest.documents(listed).drop("manifest", "position")
        if records:
            known = self.spark.createDataFrame(
                [{c: r.get(c) for c in logged.columns} for r in records], fixed.MANIFEST_FILE_SCHEMA
            )
            logged = logged.unionByName(known)
        self.lake.append(lineage.load_records(logged), "bronze", LOG)
        return {
            "status": "partial" if errors else "success", "loaded_datasets": sorted(loaded), "loaded_files": len(records),
            "rejected": {e["dataset_key"]: r["rejected"] for e, r in zip(chosen, found, strict=True) if r.get("rejected")},
            "total_files": listed.count(), "errors": errors,
        }

    def _load_entry(self, entry: dict, log: DataFrame | None) -> dict:
        """Load the files of one entry, or those that are new or changed; records that do not fit go to the rejects of the dataset.

        Returns the loaded ``files`` and the number ``rejected``, or the ``error``. Other formats are only logged.
        """
        dataset = entry["dataset_key"]
        schema = self.schemas.get(dataset)
        try:
            if entry["format"] not in ("csv", "json"):
                return {"files": [entry]}
            load = increments.BronzeLoad(self.lake, entry, log) if self.incremental else None
            wanted = load.missing if load else increments.entry_files(self.lake, entry)
            if not wanted:
                return {"files": []}
            paths = [f["local_path"] for f in wanted]
            if entry["format"] == "csv":
                mark = files.NULL_MARK if str(entry.get("source") or "").startswith("table://") else None
                if entry.get("pagination") == "keyset":
                    routed = extracts.KeysetExtract(self.spark, entry["local_path"]).route(wanted, schema, self.multi_line, mark)
                else:
                    routed = files.route_csv(self.spark, paths, schema, self.multi_line, mark)
            else:
                routed = files.route_json(self.spark, paths, schema)
            seen = Observation()
            routed = files.Routed(routed.rows.observe(seen, F.count(files.CORRUPT).alias("bad"), F.count(F.lit(1)).alias("all")))
            if load:
                load.write(routed)
            else:
                self.lake.overwrite(lineage.enrich(routed.good.drop(files.FILE), entry), "bronze", dataset)
            rejected = seen.get["bad"]
            rejects = routed.bad.withColumn("dataset_key", F.lit(dataset)).withColumn("rejected_at", F.current_timestamp())
            if rejected or self.lake.read_optional(REJECTS, dataset) is not None:  # a clean load of clean files needs no second scan
                if load and not load.whole:
                    self.lake.append(rejects, REJECTS, dataset)
                else:
                    self.lake.overwrite(rejects, REJECTS, dataset)
            return {"files": wanted, "rejected": rejected}
        except Exception as error:
            return {"error": f"{entry['local_path']}: {error}"}

    def load_json(self, path: str, dataset: str) -> DataFrame:
        """Load one JSON file outside a manifest, with lineage made from its path."""
        table = files.read_json_documents(self.spark, path, self.schemas.get(dataset))
        name = path.rstrip("/").rsplit("/", 1)[-1]
        table = lineage.enrich(table, {"source": f"local://{path}", "filename": name, "format": "json"})
        self.lake.overwrite(table, "bronze", dataset)
        return table

    def load_documents(self, path: str, decoder: Callable[[bytes], list[str]], pattern: str = "*") -> dict:
        """Decode the files below ``path`` once and keep their pages; the errors of those that failed are in ``errors_in``."""
        self.lake.overwrite(documents.decode_documents(self.spark, path, decoder, pattern), "bronze", PAGES)
        failed = self.lake.read("bronze", PAGES).filter(F.col("error").isNotNull()).count()
        return {"status": "partial" if failed else "success", "failed": failed, "errors_in": self.lake.path("bronze", PAGES)}

    def ingestion_log(self) -> DataFrame:
        return self.lake.read("bronze", LOG)

    # Silver

    def transform_dataset(self, dataset: str) -> dict:
        """Clean one bronze table; what happens to its rows and values is counted by the tasks that write.

        The counts go along with the rows through the shuffle and are added up in the last stage, so a task that runs twice counts once.
        """
        try:
            if self.incremental:
                increments.merge_silver(self.lake, dataset, self.lake.read("bronze", LOG), self.silver_buckets)
                before, after = self.lake.count("bronze", dataset), self.lake.count("silver", dataset)
                replaced = {}
            else:
                raw, seen = self.lake.read("bronze", dataset), Observation()
                rows = cleaning.prepared(raw.withColumn(cleaning.DEFECTS, cleaning.defects(raw)))
                kept = cleaning.deduplicate(rows, fixed.DEDUP_KEYS.get(dataset), carry=cleaning.DEFECTS)
                sums = [F.coalesce(F.sum(F.col(f"{cleaning.DEFECTS}.`{c}`")), F.lit(0)).alias(c) for c in ("rows", *cleaning.REASONS)]
                counted = cleaning.stamped(kept, dataset).observe(seen, F.count(F.lit(1)).alias("kept"), *sums)
                self.lake.overwrite_enforced(counted.drop(cleaning.DEFECTS), "silver", dataset)
                found = seen.get
                before, after, replaced = found["rows"], found["kept"], {c: found[c] for c in cleaning.REASONS}
            return {
                "dataset": dataset, "status": "success", "input_rows": before, "output_rows": after, "rejected_rows": before - after,
                "reasons": {"duplicate": before - after}, "replaced_values": replaced, "bytes": files.folder_bytes(self.spark, self.lake.path("silver", dataset)),
            }
        except Exception as error:
            return {"dataset": dataset, "status": "error", "error": str(error)}

    def transform_documents(self, pages: DataFrame | None = None) -> dict:
        """Save the text of all documents from pages (source_file, page_number, text), by default the decoded ones."""
        stored = self.lake.read_optional("bronze", PAGES) if pages is None else None
        if stored is not None:
            pages = documents.decoded_pages(stored)
        if pages is None or pages.isEmpty():
            return {"dataset": DOCUMENT_TEXT, "status": "no_pdf", "count": 0}
        records = documents.page_records(pages, self.limits["max_pages"])
        text = documents.document_text(records).withColumn("extraction_time", F.lit(_now()))
        self.lake.overwrite_enforced(text, "silver", DOCUMENT_TEXT)
        stored = self.lake.read("silver", DOCUMENT_TEXT)
        found = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum("total_characters"), F.lit(0))).first()
        return {
            "dataset": DOCUMENT_TEXT, "status": "success", "pdf_count": found[0], "total_characters": found[1],
        }

    def transform_silver(self, pages: DataFrame | None = None) -> dict:
        results = [*self._each(self.transform_dataset, self.datasets), self.transform_documents(pages)]
        return {
            "status": _status(results), "transformations": results,
            "total_output_rows": sum(r.get("output_rows", 0) for r in results),
        }

    # Quality

    def check_quality(self, gate: bool = False) -> dict:
        """Validate all silver tables and save the report. Failures stop the run only with ``gate``."""
        results = reduce(DataFrame.unionByName, [self._validate(d) for d in self.datasets])
        path = self.lake.path("quality", "report")
        results.write.mode("overwrite").json(path)
        report = self.spark.read.schema(quality.RESULT_SCHEMA).json(path)
        summaries = quality.dataset_summary(report, self.datasets)
        found = [r.asDict() for r in summaries.orderBy("dataset").collect()]
        result = {
            "status": _status(found), "datasets_validated": len(found), "results": found,
            "total_passed": sum(r["passed"] for r in found), "total_failed": sum(r["failed"] for r in found),
        }
        if gate and (result["total_failed"] or result["status"] != "success"):
            raise RuntimeError(f"quality gate: {result['total_failed']} expectations failed")
        return result

    def _validate(self, dataset: str) -> DataFrame:
        try:
            table = self.lake.read_optional("silver", dataset)
        except PySparkException as error:
            return quality.unreadable(self.spark, dataset, f"unreadable: {error}")
        if table is None:
            return quality.unreadable(self.spark, dataset, "table not found")
        if self.quarantine:
            return quality.validate_and_route(table, dataset, lambda bad: self.lake.overwrite(bad, "quarantine", dataset))
        return quality.validate(table, dataset)

    # Gold

    def build_gold(self) -> dict:
        """Write the six indicator tables; one that fails does not stop the others.

        A table whose input does not exist is written empty, with the status ``no_input``. An input that exists but cannot
        be read is an error, and all tables stay as they were.
        """
        try:
            if self.incremental:  # from the states of all buckets, of which only those that loads have touched are made again
                daily, vaccination = (increments.daily_states(self.lake, d) for d in (fixed.CASES, fixed.VACCINATIONS))
            else:
                cases = self.lake.read_optional("silver", fixed.CASES)
                vaccinations = self.lake.read_optional("silver", fixed.VACCINATIONS)
                daily = None if cases is None else kpis.daily(cases)
                vaccination = None if vaccinations is None else kpis.vaccination_daily(vaccinations)
        except PySparkException as error:
            return {"status": "error", "kpis": [], "error": str(error)}
        # All case indicators come from this one aggregate, which is kept while they are written.
        daily = None if daily is None else daily.persist()
        try:
            results = self._each(lambda b: self._write_gold(*b), gold_tables(daily, None, vaccination).items())
        finally:
            if daily is not None:
                daily.unpersist()
        return {"status": _status(results), "kpis": results}

    def _write_gold(self, table: str, build: Callable[[], DataFrame] | None) -> dict:
        try:
            rows = kpis.empty(self.spark, table) if build is None else kpis.stamped(build())
            self._write_indicator(rows, "gold", table)
            return {
                "table": table, "status": "no_input" if build is None else "success", "rows": self.lake.count("gold", table),
                "bytes": files.folder_bytes(self.spark, self.lake.path("gold", table)),
            }
        except Exception as error:
            return {"table": table, "status": "error", "error": str(error)}

    def _write_indicator(self, rows: DataFrame, layer: str, table: str) -> None:
        if self.by_month:
            self.lake.overwrite(serving.with_month(rows), layer, table, [serving.MONTH])
        else:
            self.lake.overwrite(rows, layer, table)

    # Warehouse

    def load_table(self, table: str) -> dict:
        """Load one typed table with ids; rows that break its rules go to the rejects of that table."""
        try:
            coerced = warehouse.coerce(self.lake.read("gold", table), warehouse.schema_of(table))
            self._write_indicator(warehouse.with_ids(warehouse.accepted(coerced)), "warehouse", table)
            self.lake.overwrite(warehouse.rejected(coerced), "warehouse_rejects", table)
            rejected = self.lake.count("warehouse_rejects", table)
            return {
                "table": table, "status": "success", "rows": self.lake.count("warehouse", table), "rejected": rejected,
                "reasons": warehouse.reason_counts(self.lake.read("warehouse_rejects", table)) if rejected else {},
                "bytes": files.folder_bytes(self.spark, self.lake.path("warehouse", table)),
            }
        except Exception as error:
            return {"table": table, "status": "error", "error": str(error)}

    def load_warehouse(self) -> dict:
        start = time.monotonic()
        results = self._each(self.load_table, fixed.GOLD_SCHEMAS)
        total = sum(r.get("rows", 0) for r in results)
        rejected = sum(r.get("rejected", 0) for r in results)
        status = _status(results)
        self.log_run("gold", "load_warehouse", {
            "records_processed": total, "records_rejected": rejected, "status": status,
            "duration_seconds": time.monotonic() - start,
        })
        return {"status": status, "tables": results, "total_rows": total, "total_rejected": rejected}

    def log_run(self, layer: str, job_name: str, stats: Mapping) -> None:
        """Append one row of run metadata."""
        row = {"layer": layer, "job_name": job_name, **{k: stats.get(k, d) for k, d in fixed.RUN_METADATA_DEFAULTS.items()}}
        given = self.spark.createDataFrame([row], ", ".join(
            f"{f.name} {'STRING' if f.dataType.typeName() == 'varchar' else f.dataType.simpleString()}"
            for f in StructType.fromDDL(fixed.RUN_METADATA_SCHEMA) if f.name in row
        ))
        rows = warehouse.coerce(given, StructType.fromDDL(fixed.RUN_METADATA_SCHEMA))
        self.lake.append(warehouse.accepted(rows), "warehouse", RUN_METADATA)

    def register_views(self) -> None:
        """Make the warehouse tables and the three views known by name to SQL in this session."""
        tables = {t: self.lake.read("warehouse", t) for t in fixed.GOLD_SCHEMAS}
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
        for name, view in reporting_views(tables).items():
            view.createOrReplaceTempView(name)

    def last_days(self, days: int = 30, layer: str = "warehouse") -> DataFrame:
        """The dashboard of the last days with cases, from tables partitioned by month: only the months of these days are read."""
        names = ["kpi_cases_per_day", "kpi_deaths_per_day", "kpi_vaccination_vs_cases"]
        cases, deaths, vaccination = (self.lake.read(layer, name) for name in names)
        newest = self.lake.newest(layer, names[0], serving.MONTH)
        as_of = None if newest is None else cases.filter(F.col(serving.MONTH) == newest).agg(F.max("report_date")).first()[0]
        found = [serving.recent(t, F.lit(as_of).cast("date"), days) for t in (cases, deaths, vaccination)]
        return views.newest_first(views.dashboard(*found))

    # The whole run

    def size_session(self) -> None:
        """Fit splits and shuffle partitions to the bytes that the manifest lists, if there is one."""
        try:
            listed = self.spark.read.schema(fixed.MANIFEST_SCHEMA).json(self.manifest_path)
            size_session(self.spark, listed.agg(F.sum("total_size_bytes")).first()[0] or 0)
        except AnalysisException:
            pass

    def _log_bytes(self, layer: str, dataset: str, size: int) -> None:
        self.log.add(runlog.BYTES, size, layer=layer, dataset=dataset, direction="write")

    def publish(self, results: Mapping[str, dict]) -> None:
        """Log the volumes of the finished steps."""
        if "bronze" in results:
            self.log.add(
                runlog.FILES, results["bronze"]["total_files"], layer="bronze", format="mixed",
                status=results["bronze"]["status"],
            )
            for dataset, rows in results["bronze"].get("rejected", {}).items():
                self.log.add(runlog.REJECTS, rows, layer="bronze", dataset=dataset, reason="malformed")
            for dataset in results["bronze"]["loaded_datasets"]:
                self._log_bytes("bronze", dataset, files.folder_bytes(self.spark, self.lake.path("bronze", dataset)))
        for r in results.get("silver", {}).get("transformations", []):
            if "output_rows" in r:
                self.log.add(runlog.ROWS, r["output_rows"], layer="silver", dataset=r["dataset"])
                for reason, rows in r["reasons"].items():
                    self.log.add(runlog.REJECTS, rows, layer="silver", dataset=r["dataset"], reason=reason)
                for reason, values in r["replaced_values"].items():
                    self.log.add(runlog.VALUES, values, layer="silver", dataset=r["dataset"], reason=reason)
                self._log_bytes("silver", r["dataset"], r["bytes"])
        for r in results.get("gold", {}).get("kpis", []):
            if "bytes" in r:
                self._log_bytes("gold", r["table"], r["bytes"])
        for r in results.get("warehouse", {}).get("tables", []):
            if "rows" in r:
                self.log.add(runlog.ROWS, r["rows"], layer="gold", dataset=r["table"])
                for reason, rows in r["reasons"].items():
                    self.log.add(runlog.REJECTS, rows, layer="warehouse", dataset=r["table"], reason=reason)
                self._log_bytes("warehouse", r["table"], r["bytes"])
        if "extract" in results:
            self.log.add(
                runlog.BYTES, results["extract"]["total_size_bytes"], layer="bronze", direction="read"
            )
        self.log.flush()

    def run(
        self,
        steps: Sequence[str] = tuple(STEPS),
        sources: Mapping[str, Source] | None = None,
        more_files: Sequence[dict] = (),
        pages: DataFrame | None = None,
        gate: bool = False,
    ) -> dict[str, dict]:
        """Run the steps in order. Volumes are logged even if a step raises."""
        unknown = set(steps) - set(STEPS)
        if unknown:
            raise ValueError(f"unknown steps: {sorted(unknown)}; known are {STEPS}")
        jobs = {
            "extract": lambda: self.extract(sources or {}, more_files),
            "bronze": self.load_bronze,
            "silver": lambda: self.transform_silver(pages),
            "quality": lambda: self.check_quality(gate),
            "gold": self.build_gold,
            "warehouse": self.load_warehouse,
        }
        results: dict[str, dict] = {}
        try:
            for step in STEPS:
                if step in steps:
                    if step != "extract":
                        self.size_session()
                    start = time.monotonic()
                    with self.log.track(step, step):
                        results[step] = jobs[step]()
                    results[step]["duration_seconds"] = time.monotonic() - start
        finally:
            self.publish(results)
        return results


def gold_tables(
    daily: DataFrame | None, vaccinations: DataFrame | None, vaccination_daily: DataFrame | None = None
) -> dict[str, Callable[[], DataFrame] | None]:
    """How to build each indicator table, from vaccinations or their daily aggregate; None where an input is missing."""
    if vaccination_daily is None and vaccinations is not None:
        vaccination_daily = kpis.vaccination_daily(vaccinations)
    have_cases, have_both = daily is not None, daily is not None and vaccination_daily is not None
    builders: dict[str, Callable[[], DataFrame]] = {
        "kpi_incidence_by_region": lambda: kpis.incidence_by_region(daily),
        "kpi_cases_per_day": lambda: kpis.cases_per_day(daily),
        "kpi_deaths_per_day": lambda: kpis.deaths_per_day(daily),
        "kpi_hospitalizations_by_region": lambda: kpis.hospitalizations_by_region(daily),
        "kpi_vaccination_vs_cases": lambda: kpis.vaccination_vs_cases(vaccination_daily, daily),
        "kpi_temporal_evolution_by_state": lambda: kpis.temporal_evolution(daily),
    }
    needs_both = {"kpi_vaccination_vs_cases"}
    return {t: b if (have_both if t in needs_both else have_cases) else None for t, b in builders.items()}


def reporting_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    dashboard = views.dashboard(
        tables["kpi_cases_per_day"], tables["kpi_deaths_per_day"], tables["kpi_vaccination_vs_cases"]
    )
    return {
        "v_kpi_dashboard": views.newest_first(dashboard),
        "v_regional_summary": views.most_cases_first(views.regional_summary(tables["kpi_incidence_by_region"])),
        "v_temporal_trends": views.by_state_and_date(
            views.temporal_trends(tables["kpi_temporal_evolution_by_state"])
        ),
    }


def _status(results: Sequence[Mapping]) -> str:
    return "partial" if any(r.get("status") in ("error", "no_input") for r in results) else "success"


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one step or all steps over the layers below a root path.")
    parser.add_argument("root", help="root path of the layers")
    parser.add_argument("--mode", choices=sorted(fixed.MODES), default="full")
    parser.add_argument("--step", choices=[*STEPS, "all"], default="all")
    parser.add_argument(
        "--source", nargs=3, action="append", default=[], metavar=("DATASET", "PATH", "KEY"),
        help="a Parquet table to extract and its unique column; may be repeated",
    )
    parser.add_argument("--gate", action="store_true", help="stop if an expectation fails")
    args = parser.parse_args()
    spark = build_session("lamina")
    sources = {name: Source(spark.read.parquet(path), key) for name, path, key in args.source}
    # Without sources the manifest that is already in place is loaded.
    steps = [args.step] if args.step != "all" else STEPS if sources else STEPS[1:]
    job = Medallion(Lake(spark, args.root), args.mode)
    results = job.run(steps, sources=sources, gate=args.gate)
    print(json.dumps(results, indent=2, default=str))


if __name__ == "__main__":
    main()
