"""Dataset-available events as a batch or a stream of raw JSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.outgoing import content_id


# A re-driven message lies in a folder that says how often it has been delivered.
DELIVERY = "delivery"


def _delivery_of_file() -> Column:
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/{DELIVERY}=([0-9]+)/[^/]*$", 1)
    return F.coalesce(folder.try_cast("int"), F.lit(1))


def with_event_key(messages: DataFrame, delivery: Column | None = None) -> DataFrame:
    """Key every message by its content; a redelivered copy gets the same key. ``delivery`` counts re-drives, 1 at first."""
    number = F.lit(1) if delivery is None else delivery
    return messages.select(F.col("value").alias("raw"), content_id(F.col("value")).alias("event_key"), number.alias("delivery"))


def latest_delivery(messages: DataFrame) -> DataFrame:
    """One row for each message, that of its last delivery."""
    return messages.groupBy("event_key").agg(F.max_by("raw", "delivery").alias("raw"), F.max("delivery").alias("delivery"))


def read_events(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """JSON lines, or one (possibly pretty-printed) event per file, re-driven ones included. Copies collapse."""
    reader = spark.read.option("recursiveFileLookup", True)
    messages = reader.text(path, wholetext=one_per_file)
    return latest_delivery(with_event_key(messages.filter(F.trim("value") != ""), _delivery_of_file()))


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int = 1000, **options: str) -> DataFrame:
    """The same as a stream. For Kafka use ``format("kafka")`` and cast ``value`` to text."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", True)
    for key, value in options.items():
        reader = reader.option(key, value)
    messages = reader.text(path)
    return with_event_key(messages.filter(F.trim("value") != ""), _delivery_of_file())
