"""File scans and file sinks."""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Quotes inside values are doubled. Files written here mark null, so that it stays apart from empty text; in files
# from elsewhere, which are read without the mark, an empty value is null.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}
NULL_MARK = "\\N"
# The text of a record that does not fit, and the file of every record.
CORRUPT, FILE = "_corrupt_record", "_file_path"


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    sampling_ratio: float = 1.0,
    multi_line: bool = True,
    null_mark: str | None = None,
) -> DataFrame:
    """CSV with a header in every file; several files are concatenated.

    Without ``schema`` all columns are text and only headers are read in advance.
    ``infer_schema`` costs another pass over the files. Files with ``multi_line`` values
    cannot be split, so large extracts should be written as many files.
    """
    reader = spark.read.options(**CSV_FORMAT, multiLine=multi_line)
    if null_mark is not None:
        reader = reader.options(nullValue=null_mark, emptyValue="")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.options(inferSchema=True, samplingRatio=sampling_ratio)
    return reader.csv(paths)


def read_json_documents(spark: SparkSession, paths: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON files that each hold one array of records (or one record), in any folder below the paths."""
    reader = spark.read.options(multiLine=True, recursiveFileLookup=True)
    return (reader.schema(schema) if schema is not None else reader).json(paths)


def read_ndjson(spark: SparkSession, paths: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON with one record per line, which can be split."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(paths)


@dataclass(frozen=True)
class Routed:
    """Records of files with the text of those that do not fit their schema, from one scan."""

    rows: DataFrame

    @property
    def good(self) -> DataFrame:
        """Records that fit; FILE is the file of each."""
        return self.rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    @property
    def bad(self) -> DataFrame:
        """path and record (its text) of those that do not."""
        return self.rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(FILE).alias("path"), F.col(CORRUPT).alias("record"))


def with_corrupt(schema: StructType | str) -> StructType:
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return StructType([*[f for f in kind if f.name != CORRUPT], StructField(CORRUPT, StringType())])


def route_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None, multi_line: bool = True, null_mark: str | None = None
) -> Routed:
    """CSV whose records with too few or too many values, or with values that are not of their column's type, are kept apart.

    Without ``schema`` all columns of the header are text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kind = read_csv(spark, paths, multi_line=multi_line).schema if schema is None else schema
    reader = spark.read.options(**CSV_FORMAT, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT, recursiveFileLookup=True)
    if null_mark is not None:
        reader = reader.options(nullValue=null_mark, emptyValue="")
    rows = reader.schema(with_corrupt(kind)).csv(paths).withColumn(FILE, F.col("_metadata.file_path"))
    # Values are judged only where their column is read. The hash, of which nothing is kept, has all of them read by every query.
    others = [F.col(f"`{c}`") for c in rows.columns if c not in (CORRUPT, FILE)]
    return Routed(rows.withColumn(CORRUPT, F.concat(F.col(CORRUPT), F.substring(F.xxhash64(*others).cast("string"), 1, 0))))


def route_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None) -> Routed:
    """JSON documents, each an array of records or one record; records that do not fit are kept apart, the others of their document stay.

    A document that is no JSON is one bad record. Without ``schema`` it is inferred, in another pass.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kind = read_json_documents(spark, paths).schema if schema is None else schema
    documents = spark.read.text(paths, wholetext=True, recursiveFileLookup=True).withColumn(FILE, F.col("_metadata.file_path"))
    whole = F.regexp_replace("value", "^\\uFEFF", "")
    array = F.when(F.startswith(F.ltrim(F.regexp_replace(whole, r"^\s+", "")), F.lit("{")), F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole)
    elements = documents.select(FILE, F.explode(F.coalesce(F.from_json(array, "array<string>"), F.array(F.col("value")))).alias("element"))
    return Routed(parsed_elements(elements, with_corrupt(kind)))


def parsed_elements(elements: DataFrame, kind: StructType) -> DataFrame:
    """The columns of ``kind`` from the text in ``element``; text that does not fit is in CORRUPT."""
    text = F.coalesce("element", F.lit("null"))
    parsed = elements.select(FILE, F.from_json(text, kind, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"), text.alias("text"))
    corrupt = F.when(F.col("r").isNull(), F.col("text")).otherwise(F.col(f"r.{CORRUPT}"))
    return parsed.select(*[F.col("r").getField(f.name).alias(f.name) for f in kind.fields[:-1]], corrupt.alias(CORRUPT), FILE)


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """Path, size and time of every file below ``prefix``; the contents are not read.

    Spark's scans leave out files of length zero. They are in the scan's own list of names, and come from there, without a time.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
    listed = scan.select("path", "length", "modificationTime")
    names = sorted({re.sub("^file:/+", "file:/", unquote(f)) for f in scan.inputFiles()})  # names of files
    if not names:
        return listed
    empty = spark.createDataFrame([(n,) for n in names], "path string").join(listed, "path", "left_anti")
    return listed.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modificationTime")))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from the file system; 0 if there is no such path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def drop_folders(spark: SparkSession, path: str, prefix: str, keep: set[str]) -> None:
    """Delete the folders right below ``path`` whose names begin with ``prefix``, but for those to keep."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.listStatus(place) if system.exists(place) else ():
        name = found.getPath().getName()
        if found.isDirectory() and name.startswith(prefix) and name not in keep:
            system.delete(found.getPath(), True)


def bytes_by_folder(spark: SparkSession, path: str, by: str) -> dict[int, int]:
    """Bytes of the files in each folder ``by=number`` below ``path``, from the scan's list of files."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    folder = F.regexp_extract("path", f"/{by}=([0-9]+)/[^/]*$", 1)
    found = listed.select(folder.alias("folder"), "length").filter("folder <> ''").groupBy("folder").agg(F.sum("length").alias("length"))
    return {int(r["folder"]): r["length"] for r in found.collect()}  # one row per folder


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_mark: str = NULL_MARK) -> None:
    df.write.mode(mode).options(
        **CSV_FORMAT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue=null_mark
    ).csv(path)


def csv_bytes(columns: Sequence[str], null_mark: str = NULL_MARK) -> Column:
    """The bytes that a row of these columns takes in a file of :func:`write_csv`, with its line break."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": null_mark}
    return F.octet_length(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), {k: v for k, v in CSV_FORMAT.items() if k != "header"} | kept)) + F.lit(1)


def write_csv_folders(df: DataFrame, path: str, by: str, null_mark: str = NULL_MARK) -> None:
    """One folder per value of ``by`` below ``path``; those of other values stay as they are."""
    df.write.mode("overwrite").options(
        **CSV_FORMAT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue=null_mark, partitionOverwriteMode="dynamic"
    ).partitionBy(by).csv(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_documents(paged: DataFrame, path: str, page: str = "page") -> None:
    """One file per page, each an array of that page's records.

    An array document cannot be split, so its size is the page size, never the table's.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in paged.columns if c != page])
    arrays = paged.groupBy(page).agg(F.to_json(F.collect_list(record), {"ignoreNullFields": "false"}).alias("value"))
    arrays.write.mode("overwrite").partitionBy(page).text(path)
