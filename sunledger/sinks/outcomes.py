"""Per-run outcome tables. A run that is repeated replaces its own part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from sunledger.sinks import folders

TABLES = (
    "ledger", "dead_letter", "notifications", "validated_events", "quarantine_rows", "quarantine_records",
    "validation_summary", "reconciliation",
)

LEDGER_SCHEMA = """
    event_key STRING, event_id STRING, dataset_id STRING, status STRING, stage STRING, reason STRING,
    records_processed BIGINT, validation_pass_count BIGINT, validation_fail_count BIGINT,
    processing_duration_ms BIGINT, output_path STRING, superseded BOOLEAN, run_ts TIMESTAMP
"""
DEAD_LETTER_SCHEMA = """
    event_key STRING, event_id STRING, dataset_id STRING, registry_key STRING, storage_path STRING,
    payload STRING, raw STRING, delivery INT
"""


def write_part(
    df: DataFrame, root: str, table: str, run_id: str, part: str, by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    """Replace one part of one run of an outcome table, or with ``mode="append"`` add to it."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{root.rstrip('/')}/{table}/run_id={run_id}/part={part}")


def clear_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Remove what an earlier run of this id has left in the outcome tables."""
    for table in TABLES:
        folders.delete(spark, f"{root.rstrip('/')}/{table}/run_id={run_id}")


def read_run(spark: SparkSession, root: str, table: str, run_id: str, schema: str) -> DataFrame:
    """The rows of one run; other runs are not listed."""
    base = f"{root.rstrip('/')}/{table}"
    try:
        return spark.read.option("mergeSchema", True).option("basePath", base).parquet(f"{base}/run_id={run_id}")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """An outcome table over all runs; an empty one when nothing was written yet."""
    try:
        return spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/{table}")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
