"""Lineage columns, ingestion-log records and the document registry."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.functions.columns import iso_timestamp


def enrich(df: DataFrame, metadata: Mapping) -> DataFrame:
    """Add source, file name, ingestion time and format of the file a table came from."""
    time = metadata.get("ingestion_time")
    return df.withColumns({
        "_bronze_source": F.lit(metadata.get("source") or ""),
        "_bronze_filename": F.lit(metadata.get("filename") or ""),
        "_bronze_ingestion_time": iso_timestamp(F.lit(str(time))) if time else F.current_timestamp(),
        "_bronze_format": F.lit(metadata.get("format") or ""),
    })


def _with_default(df: DataFrame, name: str, data_type: T.DataType, default) -> Column:
    value = F.col(name) if name in df.columns else F.lit(None)
    return F.coalesce(value.cast(data_type), F.lit(default).cast(data_type)).alias(name)


def ingestion_records(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Bring file records into the fixed shape of the ingestion log, defaults filled in; columns of ``carry`` come after it.

    A missing time becomes now; text that is no ISO time raises, as it would corrupt the log.
    """
    def field(f: T.StructField) -> Column:
        if f.name != "ingestion_time":
            return _with_default(df, f.name, f.dataType, fixed.INGESTION_LOG_DEFAULTS.get(f.name))
        if f.name not in df.columns:
            return F.current_timestamp().alias(f.name)
        return F.coalesce(F.to_timestamp(F.col(f.name)), F.current_timestamp()).alias(f.name)

    return df.select(*[field(f) for f in T.StructType.fromDDL(fixed.INGESTION_LOG_SCHEMA)], *carry)


def document_registry(files: DataFrame) -> DataFrame:
    """The registry row of every document among the files; the format is always ``pdf``."""
    documents = files.filter(F.col("format") == "pdf")
    return documents.select(*[
        F.lit(default).alias(name) if name == "format"
        else _with_default(files, name, T.LongType() if name == "file_size" else T.StringType(), default)
        for name, default in fixed.REGISTRY_DEFAULTS.items()
    ])


def load_records(files: DataFrame) -> DataFrame:
    """Ingestion-log rows of loaded files, with what tells a file from its next version, and when it was loaded."""
    kept = T.StructType.fromDDL("local_path STRING, content_hash STRING")
    more = {f.name: (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType) for f in kept}
    known = ingestion_records(files.withColumn("_more", F.struct(*[c.alias(n) for n, c in more.items()])), carry=["_more"])
    return known.select("*", "_more.*", F.current_timestamp().alias("loaded_at")).drop("_more")


def latest_loads(log: DataFrame) -> DataFrame:
    """dataset_key, local_path, file_size and content_hash of the last load of every file."""
    found = log.filter(F.col("dataset_key").isNotNull() & F.col("local_path").isNotNull())
    last = F.max(F.struct("loaded_at", "file_size", "content_hash")).alias("last")
    return found.groupBy("dataset_key", "local_path").agg(last).select("dataset_key", "local_path", "last.file_size", "last.content_hash")


def new_files(listed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files that were never loaded, or whose size or content is another than at their last load."""
    names = ["dataset_key", "local_path", "file_size", "content_hash"]
    same = reduce(lambda a, b: a & b, [listed[c].eqNullSafe(loaded[c]) for c in names])
    return listed.join(loaded, same, "left_anti")
