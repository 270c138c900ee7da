"""Session settings and the shared folder for written intermediates."""

import atexit
import math
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}

MB = 1024 * 1024
SCAN_BYTES, SHUFFLE_BYTES = 128 * MB, 512 * MB


def build_session(app_name: str = "lamina", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for; ``conf`` keys use ``__`` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_session(spark: SparkSession, input_bytes: int) -> None:
    """Set scan splits and shuffle partitions for an input of that size; adaptive execution merges small ones.

    A split has SCAN_BYTES and a shuffle partition SHUFFLE_BYTES whatever the size of the input; the number of shuffle
    partitions is raised, never lowered.
    """
    spark.conf.set("spark.sql.files.maxPartitionBytes", SCAN_BYTES)
    wanted = math.ceil(input_bytes / SHUFFLE_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.split("[")[0] == "local"
    if named:
        if named.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is {named}, a folder of one machine: name one that all executors share")
        return named.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lamina-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it; other machines have it installed or by --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{work_dir(spark)}/lamina/{name}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which pins its rows and cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share the rows of a scan among all cores if it has fewer tasks than there are cores.

    That is so for a few files that cannot be split; a scan of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
