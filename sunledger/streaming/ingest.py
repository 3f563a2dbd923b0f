"""Structured Streaming: every micro-batch of events runs through the batch job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from sunledger.plans.ingest import IngestConfig, run_batch
from sunledger.session import prepare, work_dir
from sunledger.sinks import folders
from sunledger.sources.events import latest_delivery


def drop_redelivered(messages: DataFrame, within: str) -> DataFrame:
    """Drop copies of a message that arrive within a time span of each other.

    The watermark follows the arrival time, so no message is ever late and none
    but true copies is dropped; a re-driven message has another delivery number.
    """
    arrived = messages.withColumn("arrived_at", F.current_timestamp())
    return arrived.withWatermark("arrived_at", within).dropDuplicatesWithinWatermark(["event_key", "delivery"]).drop("arrived_at")


def _batch_time(spark: SparkSession, cfg: IngestConfig, batch_id: int, pinned: datetime | None) -> datetime:
    """The ingestion time of a micro-batch, written down before it is used.

    A batch that is run again after a crash reads the first time back, and so
    replaces the same partitions even on a later day.
    """
    path = f"{cfg.outcome_root.rstrip('/')}/batch_times/run_id={cfg.run_id}/batch={batch_id}"
    try:
        known = spark.read.schema("micros bigint").json(path).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known:
        return datetime.fromtimestamp(known.micros / 1e6, timezone.utc)
    moment = pinned or datetime.now(timezone.utc)
    micros = round(moment.timestamp() * 1e6)
    spark.createDataFrame([(micros,)], "micros bigint").coalesce(1).write.mode("overwrite").json(path)
    return datetime.fromtimestamp(micros / 1e6, timezone.utc)


def run_stream(
    spark: SparkSession,
    messages: DataFrame,
    registry: Callable[[SparkSession], DataFrame],
    config: IngestConfig,
    checkpoint: str,
    *,
    available_now: bool = False,
    processing_time: str = "30 seconds",
    drop_copies_within: str | None = None,
    pinned_time: datetime | None = None,
) -> StreamingQuery:
    """Start the job on a stream of ``raw``/``event_key`` messages.

    What silver holds of each dataset is kept beside it, so a late older
    version changes nothing. Delivery is at least once and every effect is a
    replacement keyed by the batch number, which makes a repeated batch
    harmless. ``registry`` is
    called per batch and so sees mappings published while the stream runs.

    The job runs in the caller's session. The stream's own one plans without
    adaptive execution, so every small table would be as many tasks and files
    as there are shuffle partitions; there a batch is only written down.
    """
    prepare(spark)
    if drop_copies_within:
        messages = drop_redelivered(messages, drop_copies_within)

    def process(batch: DataFrame, batch_id: int) -> None:
        moment = _batch_time(spark, config, batch_id, pinned_time)
        cfg = replace(config, run_id=f"{config.run_id}-{batch_id}", ingestion_time=moment)
        path = work_dir(spark, f"sent-{cfg.run_id}")
        batch.write.mode("overwrite").parquet(path)
        sent = spark.read.schema(batch.schema).parquet(path)
        run_batch(spark, latest_delivery(sent), registry(spark), cfg)
        folders.delete(spark, path)

    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
