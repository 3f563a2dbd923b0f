"""Run accounting: metric totals, last status, reconciliation, dead-letter report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The life of a dataset job.
STAGES = ("Received", "Parsing", "Validating", "Transforming", "Writing", "Completed", "Failed")


def stage_of(reason: Column) -> Column:
    """The stage a job had reached when it ended with ``reason`` (NULL: completed)."""
    return (
        F.when(reason.isNull(), "Completed")
        .when(reason.isin("EmptyDataset", "UnsupportedEncoding", "SourceFileNotFound"), "Parsing")
        .when(reason == "ValidationFailed", "Validating")
        .otherwise("Received")
    )


def metric_totals(ledger: DataFrame) -> DataFrame:
    """Counters and duration distribution per dataset over all runs."""
    return ledger.groupBy("dataset_id").agg(
        F.sum("records_processed").alias("records_processed"),
        F.sum("validation_pass_count").alias("validation_pass_count"),
        F.sum("validation_fail_count").alias("validation_fail_count"),
        F.count("processing_duration_ms").alias("runs"),
        F.max("processing_duration_ms").alias("max_duration_ms"),
        F.percentile_approx("processing_duration_ms", 0.5).alias("median_duration_ms"),
    )


def last_status(ledger: DataFrame) -> DataFrame:
    """Status and reason of the last run per dataset."""
    latest = F.max(F.struct("run_ts", "status", "reason"))
    return ledger.groupBy("dataset_id").agg(latest.alias("_l")).select("dataset_id", "_l.status", "_l.reason", "_l.run_ts")


def reconcile(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events without exactly one outcome, and outcomes without an event.

    ``outcomes`` has one ``event_key`` per notification, dead letter or
    superseded event. An empty result is the healthy one.
    """
    counted = outcomes.groupBy("event_key").agg(F.count("*").alias("outcomes"))
    known = events.select("event_key").distinct().withColumn("_known", F.lit(True))
    return (
        known.join(counted, "event_key", "full_outer")
        .select("event_key", F.col("_known").isNotNull().alias("known_event"), F.coalesce("outcomes", F.lit(0)).alias("outcomes"))
        .filter(~F.col("known_event") | (F.col("outcomes") != 1))
    )


def dead_letter_report(dead_letters: DataFrame) -> DataFrame:
    """Dead letters per reason, with a first and last example."""
    return dead_letters.groupBy("reason").agg(
        F.count("*").alias("messages"),
        F.countDistinct("dataset_id").alias("datasets"),
        F.min("event_id").alias("first_event_id"),
        F.max("event_id").alias("last_event_id"),
    )


def dead_letter_listing(dead_letters: DataFrame) -> DataFrame:
    """Reason, description, message id and storage path of every dead letter."""
    return dead_letters.select("reason", F.col("payload").alias("description"), "event_id", "storage_path")
