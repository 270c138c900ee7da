"""The run log and the figures read from it.

A log row is (ts, layer, job_name, dataset, format, status, direction, reason,
error_type, metric, value, version, mode). Every figure is one aggregation that
combines before its shuffle.
"""

import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed

SCHEMA = (
    "ts TIMESTAMP, layer STRING, job_name STRING, dataset STRING, format STRING, status STRING, direction STRING, "
    "reason STRING, error_type STRING, metric STRING, value DOUBLE, version STRING, mode STRING"
)
LABELS = ["layer", "job_name", "dataset", "format", "status", "direction", "reason", "error_type"]
FILES, ROWS, REJECTS = "files_read", "rows_inserted", "rows_rejected"
VALUES = "values_replaced"
DURATION, ERRORS, BYTES, FRESHNESS = "job_duration", "errors", "bytes_processed", "freshness"


def _of(log: DataFrame, metric: str) -> DataFrame:
    return log.filter(F.col("metric") == metric)


def _sum(log: DataFrame, metric: str, by: list[str], name: str) -> DataFrame:
    return _of(log, metric).groupBy(*by).agg(F.sum("value").alias(name))


def files_read(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _sum(log, FILES, by or ["layer"], "files")


def rows_inserted(log: DataFrame) -> DataFrame:
    return _sum(log, ROWS, ["layer", "dataset"], "rows")


def rows_rejected(log: DataFrame) -> DataFrame:
    return _sum(log, REJECTS, ["layer", "reason"], "rows")


def values_replaced(log: DataFrame) -> DataFrame:
    return _sum(log, VALUES, ["layer", "dataset", "reason"], "values")


def errors(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _sum(log, ERRORS, by or ["layer"], "errors")


def bytes_processed(log: DataFrame) -> DataFrame:
    return _sum(log, BYTES, ["layer", "direction"], "bytes")


def mean_duration(log: DataFrame) -> DataFrame:
    return _of(log, DURATION).groupBy("layer", "job_name").agg(F.avg("value").alias("mean_seconds"))


def duration_histogram(log: DataFrame) -> DataFrame:
    """Cumulative counts per upper bound: jobs that took no longer than ``le``.

    The bounds are counted side by side and turned into rows afterwards, so the log
    rows themselves are never multiplied.
    """
    bounds = [str(b) for b in fixed.DURATION_BOUNDS]
    counts = [F.count(F.when(F.col("value") <= float(b), 1)).alias(b) for b in bounds]
    wide = _of(log, DURATION).groupBy("layer", "job_name").agg(*counts, F.count("value").alias("+Inf"))
    return wide.unpivot(["layer", "job_name"], [*[f"`{b}`" for b in bounds], "`+Inf`"], "le", "jobs")


def freshness(log: DataFrame, as_of: Column) -> DataFrame:
    """Seconds between the newest row of each layer and dataset and ``as_of``."""
    def seconds(c: Column) -> Column:
        return F.unix_timestamp(c.cast("timestamp"))

    return log.groupBy("layer", "dataset").agg((seconds(as_of) - seconds(F.max("ts"))).alias("age_seconds"))


class RunLog:
    """Appends the rows of one run. Rows are kept until :meth:`flush` writes them as one file."""

    def __init__(self, spark: SparkSession, path: str, version: str = "1.0.0", mode: str = "sample"):
        self.spark, self.path, self.version, self.mode = spark, path, version, mode
        self._rows: list[tuple] = []

    def add(self, metric: str, value: float, **labels: str) -> None:
        known = [labels.pop(name, None) for name in LABELS]
        if labels:
            raise TypeError(f"unknown labels: {sorted(labels)}")
        self._rows.append((time.time(), *known, metric, float(value), self.version, self.mode))

    def flush(self) -> int:
        """Write the pending rows and return their number."""
        rows, self._rows = self._rows, []
        if rows:
            seconds = SCHEMA.replace("ts TIMESTAMP", "ts DOUBLE")
            log = self.spark.createDataFrame(rows, seconds).withColumn("ts", F.timestamp_seconds("ts"))
            log.coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    @contextmanager
    def track(self, layer: str, job_name: str):
        """Record how long the block takes, and its error if it raises."""
        start = time.monotonic()
        try:
            yield
        except Exception as error:
            self.add(ERRORS, 1, layer=layer, job_name=job_name, error_type=type(error).__name__)
            raise
        finally:
            self.add(DURATION, time.monotonic() - start, layer=layer, job_name=job_name)
            self.flush()
