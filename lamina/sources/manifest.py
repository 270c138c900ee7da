"""The manifest of an extraction: its files, the file to load per dataset, its totals."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per listed file, with the path of its manifest and its place there (``manifest``, ``position``).

    ``multi_line`` reads a file as one document, with or without a byte order mark;
    without it each line is a manifest.
    """
    documents = spark.read.schema(fixed.MANIFEST_SCHEMA).option("multiLine", multi_line).json(path)
    rows = documents.select(F.col("_metadata.file_path").alias("manifest"), F.posexplode("files").alias("position", "file"))
    return rows.select("manifest", "position", "file.*")


def structured_files(files: DataFrame) -> DataFrame:
    """The file to load for every dataset: its first one, or its first CSV if the first one is JSON.

    Several manifests follow each other in the order of their paths. Documents and files without a dataset are left out. Both candidates are minima, so a
    dataset with very many files is combined before the shuffle.
    """
    candidates = files.filter((F.col("format") != "pdf") & (F.col("dataset_key") != ""))
    order = [c for c in ("manifest", "position") if c in files.columns]
    columns = [*order, *[c for c in files.columns if c not in (*order, "dataset_key")]]
    entry = F.struct(*columns)
    chosen = candidates.groupBy("dataset_key").agg(
        F.min(entry).alias("first"),
        F.min(F.when(F.col("format") == "csv", entry)).alias("first_csv"),
    )
    best = F.when(
        (F.col("first.format") == "json") & F.col("first_csv").isNotNull(), F.col("first_csv")
    ).otherwise(F.col("first"))
    return chosen.select("dataset_key", best.alias("best")).select("dataset_key", "best.*").select(*files.columns)


def documents(files: DataFrame) -> DataFrame:
    return files.filter(F.col("format") == "pdf")


def totals(files: DataFrame) -> DataFrame:
    """Number of files and their bytes, unknown sizes as 0."""
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum(F.coalesce("file_size", F.lit(0))), F.lit(0)).alias("total_size_bytes"),
    )


def write_manifest(spark: SparkSession, path: str, entries: list[dict], mode: str, extraction_time: str) -> None:
    """One manifest document for the files of one extraction (one entry per dataset and format)."""
    document = {
        "extraction_time": extraction_time, "mode": mode, "total_files": len(entries),
        "total_size_bytes": sum(e.get("file_size") or 0 for e in entries), "files": entries,
    }
    spark.createDataFrame([document], fixed.MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
