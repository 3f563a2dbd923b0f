"""Which version of each dataset silver holds: small tables beside it, one for each commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.sinks import folders

FOLDER = "_versions"
SCHEMA = """
    dataset_id STRING, version BIGINT, event_time TIMESTAMP, event_id STRING, event_key STRING,
    registry_key STRING, written_on STRING
"""
# Later events have the greater value.
ORDER = ("version", "event_time", "event_id", "event_key")
# Tables that are read together before they are merged into one.
MANY = 64


def order(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}") for c in ORDER])


def newest(events: DataFrame) -> DataFrame:
    """The event of each dataset that counts: highest version, then latest time. A map-side aggregate, no window."""
    rest = [c for c in events.columns if c != "dataset_id"]
    top = F.max_by(F.struct(*rest), order())
    return events.groupBy("dataset_id").agg(top.alias("_top")).select("dataset_id", *[F.col(f"_top.{c}").alias(c) for c in rest])


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """The newest accepted event of each dataset, over all commits."""
    base = f"{root.rstrip('/')}/{FOLDER}"
    parts = [f"{base}/{name}" for name in folders.children(spark, base)]
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    return newest(spark.read.schema(SCHEMA).parquet(*parts))


def stage_versions(spark: SparkSession, accepted: DataFrame, root: str, staged: str, commit: str) -> tuple[list[str], list[str]]:
    """Write the versions a commit brings; returns the folders to move and to remove.

    When there are many tables the commit merges them into its own.
    """
    base = f"{root.rstrip('/')}/{FOLDER}"
    parts = [name for name in folders.children(spark, base) if name != f"commit={commit}"]
    rows, merged = accepted.select(*[f.split()[0] for f in SCHEMA.split(",")]), []
    if len(parts) >= MANY:
        rows = newest(rows.unionByName(spark.read.schema(SCHEMA).parquet(*[f"{base}/{name}" for name in parts])))
        merged = parts
    rows.coalesce(8).write.mode("overwrite").parquet(f"{staged}/{FOLDER}/commit={commit}")
    return [f"{FOLDER}/commit={commit}"], [f"{FOLDER}/{name}" for name in merged]
