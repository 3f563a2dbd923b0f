"""Row positions inside a dataset, computed without one task per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_WIDTH = 1_000_000


def number_rows(rows: DataFrame, key: str, order_by: str, width: int = BUCKET_WIDTH) -> DataFrame:
    """Add ``row_index``: 1-based position per ``key`` in the order of a unique whole number, never NULL.

    Rows are numbered inside fixed ranges of ``order_by``, so no task ever sorts
    more than ``width`` rows of one key; the counts of the ranges before give the
    offset. Join and window share one shuffle on (key, range).
    """
    ranged = rows.withColumn("_range", F.expr(f"`{order_by}` div {width}"))
    sizes = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(key).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(key, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(W.partitionBy(key, "_range").orderBy(order_by))
    return (
        ranged.join(offsets, [key, "_range"])
        .withColumn("row_index", (F.col("_offset") + local).cast("bigint"))
        .drop("_range", "_offset")
    )


def split_offsets(rows: DataFrame) -> DataFrame:
    """Per file split: its first scan id and the number of rows of the file before it.

    ``rows`` carry ``file_path``, ``block_start`` and ``scan_id``, an id that
    grows by one per row inside a split. The result has one row per split.
    """
    splits = rows.groupBy("file_path", "block_start").agg(
        F.min("scan_id").alias("first_id"), (F.max("scan_id") - F.min("scan_id") + 1).alias("_n")
    )
    before = W.partitionBy("file_path").orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    return splits.select(
        "file_path", "block_start", "first_id", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("rows_before")
    )


def with_row_index(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Replace the scan position by ``row_index``, the 1-based position in the file."""
    return (
        rows.join(offsets, ["file_path", "block_start"])
        .withColumn("row_index", F.col("scan_id") - F.col("first_id") + F.col("rows_before") + F.lit(1))
        .drop("block_start", "scan_id", "first_id", "rows_before")
    )
