"""Which dead letters can be put back into the input, and putting them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators.registry import with_problem
from sunledger.sources.events import DELIVERY

# Fixed: deliveries after which a message is left to its readers.
MAX_DELIVERIES = 3


def redrive_candidates(
    dead_letters: DataFrame,
    registry: DataFrame,
    present_paths: DataFrame,
    completed: DataFrame,
    resolvable_only: bool = True,
    max_deliveries: int = MAX_DELIVERIES,
) -> DataFrame:
    """Dead letters whose cause is gone and that have not succeeded since.

    ``present_paths`` has one ``storage_path`` per existing source file,
    ``completed`` one ``event_key`` per succeeded event. With
    ``resolvable_only=False`` every dead letter goes back, whatever its reason.
    A letter of several runs goes back once, unless it has been delivered
    ``max_deliveries`` times; letters without ``delivery`` count as delivered once.
    """
    if "delivery" not in dead_letters.columns:
        dead_letters = dead_letters.withColumn("delivery", F.lit(1))
    last = dead_letters.groupBy("event_key").agg(F.max("delivery").alias("delivery")).filter(F.col("delivery") < max_deliveries)
    dead_letters = dead_letters.join(last, ["event_key", "delivery"], "left_semi").dropDuplicates(["event_key"])
    open_letters = dead_letters.join(completed.select("event_key").distinct(), "event_key", "left_anti")
    if not resolvable_only:
        return open_letters
    usable = with_problem(registry).filter(F.col("problem").isNull()).select("registry_key")
    mapped = open_letters.filter(F.col("reason") == "UnknownSchema").join(usable, "registry_key", "left_semi")
    found = open_letters.filter(F.col("reason") == "SourceFileNotFound").join(
        present_paths.select("storage_path").distinct(), "storage_path", "left_semi"
    )
    return mapped.unionByName(found)


def write_redrive(candidates: DataFrame, events_path: str) -> None:
    """Append the original messages, unchanged, as JSON lines to the event input.

    They go to the folder of their next delivery, which also tells the stream
    that they are no copies of what it has seen.
    """
    one_line = F.regexp_replace("raw", r"[\r\n]+", " ")
    number = F.coalesce("delivery", F.lit(1)) if "delivery" in candidates.columns else F.lit(1)
    out = candidates.select(one_line.alias("value"), (number + 1).alias(DELIVERY))
    out.write.mode("append").partitionBy(DELIVERY).text(events_path)
