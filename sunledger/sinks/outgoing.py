"""Downstream notifications: the flat message and the contract envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.outgoing import content_id, iso_time

# Fixed values of the outgoing contract.
VALIDATED_TYPE = "solar.pvdaq.dataset.validated.v1"
VALIDATED_SOURCE = "/dataset-processing/pvdaq"
SUBJECT = "dataset.bronze.available"
DEFAULT_VALIDATED_SCHEMA = "https://contracts.example.org/dataset-validated.v1.json"


def notifications(written: DataFrame, published_at: Column, carry: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One flat JSON message per written dataset.

    ``written``: dataset_id, record_count, silver_path, schema_version, correlation_id; columns ``carry`` are kept.
    """
    return written.select(
        *carry,
        "dataset_id",
        F.lit(SUBJECT).alias("subject"),
        "correlation_id",
        F.to_json(
            F.struct(
                "dataset_id",
                "record_count",
                F.col("silver_path").alias("bronze_path"),
                "schema_version",
                "correlation_id",
                iso_time(published_at).alias("published_at"),
            )
        ).alias("body"),
    )


def validated_envelopes(
    written: DataFrame, published_at: Column, dataschema: str = DEFAULT_VALIDATED_SCHEMA
) -> DataFrame:
    """One validated-event envelope per written dataset; ``written`` also has
    source_vendor, traceparent and event_key. The id is derived, so a replay repeats it."""
    body = F.struct(
        F.lit("1.0").alias("specversion"),
        F.lit(VALIDATED_TYPE).alias("type"),
        F.lit(VALIDATED_SOURCE).alias("source"),
        content_id(F.concat_ws("|", F.lit(VALIDATED_TYPE), "event_key")).alias("id"),
        iso_time(published_at).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        F.lit(dataschema).alias("dataschema"),
        F.col("source_vendor"),
        F.col("schema_version"),
        F.col("correlation_id"),
        F.col("traceparent"),
        F.struct("dataset_id", "record_count", "silver_path").alias("data"),
    )
    return written.select("dataset_id", "correlation_id", F.to_json(body).alias("body"))
