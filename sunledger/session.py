"""Session settings the engine relies on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not speed; all of them are run-time settings.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # INT64 timestamps in Parquet, never INT96.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Partition values such as dates and ids stay text on read-back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Folders are listed by jobs of up to ten thousand tasks unless this is lower; a task of a job lists many.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 8

# Paths of the machine itself. The classes that stand for them by default write a checksum beside each file and, where Hadoop's
# native library is absent, start a process for every new file and folder, and (in Spark's Hive jars, as far as known) for every status
# asked for. The bare one starts one for what is new only. A session that names a class keeps it; other file systems stay as they are.
LOCAL_SYSTEM = "fs.file.impl"
BARE_LOCAL = {LOCAL_SYSTEM: "org.apache.hadoop.fs.RawLocalFileSystem", f"{LOCAL_SYSTEM}.disable.cache": "true"}

_local_scratch: str | None = None


def build_session(app_name: str = "sunledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        # Beyond this size the JVM would interpret a generated method instead of compiling it.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **REQUIRED_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built, bound the tasks of a listing and pick the local file system."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING)) > tasks:
        spark.conf.set(LISTING, str(tasks))
    if not spark._jsc.hadoopConfiguration().get(LOCAL_SYSTEM) and spark.conf.get(LOCAL_SYSTEM, None) is None:
        for key, value in BARE_LOCAL.items():
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder of the session.

    A cluster names a folder every executor can reach in ``spark.checkpoint.dir``.
    Only where that is unset (local tests) a folder of this machine is used.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="sunledger-")
        root = _local_scratch
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written table.

    Cuts lineage so that a lost executor costs a re-read, and gives the
    optimizer the true size of small intermediate tables.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
