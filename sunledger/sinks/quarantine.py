"""Rejected rows and the reason record next to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.functions.outgoing import iso_time
from sunledger.operators.quality import REASON_CODES

LISTED_ROWS = 10
WRITER = "processing-func"
# The record contract requires members such as the device id even when there is no value.
KEEP_NULLS = {"ignoreNullFields": "false"}


def quarantine_rows(bad: DataFrame) -> DataFrame:
    """Rejected rows; the row position is 0-based here, unlike in failure details."""
    return bad.withColumn("row_index", F.col("row_index") - 1).withColumn(
        "reason_code", F.col("failures")[0]["code"]
    )


def _source() -> Column:
    return F.struct(
        F.col("source_vendor"),
        F.col("site_id"),
        F.lit(None).cast("string").alias("device_id"),
        F.col("category"),
        F.col("storage_path").alias("source_uri"),
        F.col("version"),
    ).alias("source")


def _head(reason: Column, scope: str, moment: Column) -> list[Column]:
    return [
        reason.alias("reason_code"),
        F.lit(scope).alias("scope"),
        iso_time(moment).alias("quarantined_at"),
        F.lit(WRITER).alias("quarantined_by"),
        F.col("correlation_id"),
        F.col("traceparent"),
        F.col("schema_version"),
        F.col("mapping_version"),
    ]


def row_sidecars(failures: DataFrame, events: DataFrame, moment: Column, data_path: Column) -> DataFrame:
    """One record per dataset with rejected rows; the listed rows are the first few.

    ``failures`` is the exploded failure table (1-based rows); the counts come
    from all of it, only the listing is short.
    """
    order = W.partitionBy("dataset_id").orderBy("row_index", "pos")
    listed = (
        failures.withColumn("seq", F.row_number().over(order))
        .filter(F.col("seq") <= LISTED_ROWS)
        .groupBy("dataset_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "seq",
                        (F.col("row_index") - 1).alias("row_index"),
                        F.col("code").alias("reason_code"),
                        "field",
                        "rule",
                        "detail",
                    )
                )
            ).alias("_rows")
        )
    )
    counted = failures.groupBy("dataset_id").agg(
        F.countDistinct("row_index").alias("record_count"),
        F.min("code").alias("_low"),
        F.max("code").alias("_high"),
    )
    reason = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.lit(REASON_CODES["UnknownSchema"]))
    return (
        counted.join(listed, "dataset_id")
        .join(events, "dataset_id")
        .select(
            "dataset_id",
            F.to_json(
                F.struct(
                    *_head(reason, "row", moment),
                    F.col("record_count"),
                    data_path.alias("data_path"),
                    _source(),
                    F.transform("_rows", lambda r: r.dropFields("seq")).alias("rows"),
                ),
                KEEP_NULLS,
            ).alias("body"),
        )
    )


def file_sidecars(rejected: DataFrame, moment: Column) -> DataFrame:
    """One record per dataset rejected as a whole; ``rejected`` has ``reason`` and event columns."""
    codes = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("EmptyDataset", REASON_CODES["EmptyDataset"]),
                ("UnsupportedEncoding", REASON_CODES["UnsupportedEncoding"]),
                ("UnknownSchema", REASON_CODES["UnmappedSchema"]),
                ("ValidationFailed", REASON_CODES["UnknownSchema"]),
            )
            for x in pair
        ]
    )
    known = rejected.withColumn("_code", codes[F.col("reason")]).filter(F.col("_code").isNotNull())
    return known.select(
        "dataset_id",
        F.to_json(
            F.struct(
                *_head(F.col("_code"), "file", moment),
                F.col("storage_path").alias("data_path"),
                _source(),
                F.from_json("payload", "map<string,string>").alias("detail"),
            ),
            KEEP_NULLS,
        ).alias("body"),
    )
