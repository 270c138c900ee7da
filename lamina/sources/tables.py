"""Layered tables under one root path: reads, optional reads, overwrites and appends."""

import re
import threading
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lamina.sources.files import folder_bytes

#: Appends to one path wait for each other: Spark's committer clears the folder in which the files of another append still wait.
_appending: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)

LAYERS = ["bronze", "silver", "gold", "warehouse"]
#: A column by which the files of a table are laid out and nothing else: reads leave it out unless asked.
LAYOUT = "_layout"


class SchemaMismatch(ValueError):
    """The columns of a table and of the rows to be written differ."""


@dataclass(frozen=True)
class Lake:
    """Tables at ``{root}/{layer}/{name}``. ``format`` may be any table format the cluster has."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, layer: str, name: str, layout: bool = False) -> DataFrame:
        found = self.spark.read.format(self.format).load(self.path(layer, name))
        return found.drop(LAYOUT) if LAYOUT in found.columns and not layout else found

    def read_optional(self, layer: str, name: str, layout: bool = False) -> DataFrame | None:
        """The table, or None where there is no such path. A table that cannot be read raises."""
        try:
            return self.read(layer, name, layout)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def newest(self, layer: str, name: str, by: str) -> str | None:
        """The largest value of a partition column, from the names of the table's files; no file is opened."""
        found = [re.search(rf"/{re.escape(by)}=([^/]+)/", f) for f in self.read(layer, name).inputFiles()]
        return max((m[1] for m in found if m and m[1] != "__HIVE_DEFAULT_PARTITION__"), default=None)

    def count(self, layer: str, name: str) -> int:
        """Rows of a stored table. Parquet answers this from its footers."""
        return self.read(layer, name).count()

    def overwrite(self, df: DataFrame, layer: str, name: str, by: Sequence[str] = ()) -> None:
        """Replace rows and schema; ``by`` are the partition columns.

        A partitioned table without rows has no file and thus no schema, so it gets one file without partitions.
        """
        def save(rows: DataFrame, by: Sequence[str]) -> None:
            writer = rows.write.format(self.format).mode("overwrite").options(overwriteSchema="true", partitionOverwriteMode="static")
            (writer.partitionBy(*by) if by else writer).save(self.path(layer, name))

        save(df, by)
        if by and not folder_bytes(self.spark, self.path(layer, name)):
            save(self.spark.createDataFrame([], df.schema), ())

    def replace_partitions(self, df: DataFrame, layer: str, name: str, by: Sequence[str]) -> None:
        """Replace the partitions that ``df`` has rows of and leave the others as they are."""
        df.write.format(self.format).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(self.path(layer, name))

    def overwrite_enforced(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace the rows, and refuse columns that differ from those of the stored table."""
        stored = self.read_optional(layer, name)
        if stored is not None:
            check_schema(df.schema, stored.schema)
        df.write.format(self.format).mode("overwrite").save(self.path(layer, name))

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        with _appending[self.path(layer, name)]:
            df.write.format(self.format).mode("append").save(self.path(layer, name))


def check_schema(new: StructType, stored: StructType) -> None:
    """Raise unless both have the same columns with the same types; order and nullability may differ."""
    wanted = {f.name: f.dataType.simpleString() for f in stored}
    given = {f.name: f.dataType.simpleString() for f in new}
    if wanted != given:
        differing = sorted(c for c in wanted.keys() | given.keys() if wanted.get(c) != given.get(c))
        raise SchemaMismatch(
            "columns differ: " + ", ".join(f"{c} ({wanted.get(c)} stored, {given.get(c)} given)" for c in differing)
        )


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, **properties: str) -> None:
    """Replace the rows of a database table and keep the table itself, so views on it stay valid."""
    df.write.mode("overwrite").options(truncate=True, batchsize=batch_size, **properties).format("jdbc").options(
        url=url, dbtable=table
    ).save()
