"""Canonical rows as Parquet, one replaceable partition per dataset and date."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.operators.registry import LINEAGE, Mapping
from sunledger.operators.transform import output_schema
from sunledger.sinks import folders

# Schemas of what was written below a mapping's root, one small text each.
SCHEMAS = "_schema"


def silver_root(root: str, registry_key: str) -> str:
    """Every mapping has its own root, because mappings differ in schema."""
    return f"{root.rstrip('/')}/{registry_key}"


def partition_date(partition_by: str, ingestion_date: str) -> Column:
    if partition_by == "data_date":
        return F.date_format("timestamp", "yyyy-MM-dd")
    return F.lit(ingestion_date)


def _partitioned(rows: DataFrame, ingestion_date: str, partition_by: str):
    dated = rows.withColumn(partition_by, partition_date(partition_by, ingestion_date))
    return dated.write.partitionBy("source_dataset_id", partition_by)


def write_silver(rows: DataFrame, root: str, ingestion_date: str, partition_by: str = "ingestion_date") -> None:
    """Replace the partitions of the datasets in ``rows``; others stay as they are.

    Running it again with the same date gives the same table. No shuffle: staged
    rows already lie together by source file, and a dataset spread over many
    tasks becomes several files of one partition.
    """
    _partitioned(rows, ingestion_date, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def stage_silver(rows: DataFrame, staged: str, registry_key: str, ingestion_date: str, partition_by: str) -> None:
    """Add the rows of some datasets to what a commit will put in place; nothing below the root changes.

    All rows of a commit have one ingestion date, so no folder of it is staged:
    the move gives it, and a dataset costs a folder less.
    """
    if partition_by == "data_date":
        writer = _partitioned(rows, ingestion_date, partition_by)
    else:
        writer = rows.write.partitionBy("source_dataset_id")
    writer.mode("append").parquet(silver_root(staged, registry_key))


def staged_moves(
    spark: SparkSession, root: str, staged: str, keys: list[str], ingestion_date: str, partition_by: str
) -> list[tuple[str, str]]:
    """Where each dataset written by :func:`stage_silver` lies below the staging folder, and where it goes below the root."""
    if partition_by == "data_date":
        return [(folder, folder) for folder in staged_partitions(spark, root, staged, keys, ingestion_date, partition_by)]
    written = [f"{key}/{name}" for key in keys for name in sorted(folders.names(spark, silver_root(staged, key)))]
    return [(folder, f"{folder}/{partition_by}={ingestion_date}") for folder in written if "/source_dataset_id=" in folder]


def staged_partitions(spark: SparkSession, root: str, staged: str, keys: list[str], ingestion_date: str, partition_by: str) -> list[str]:
    """The folders to put in place: a dataset's partition of the date; the whole dataset if it is new or with ``data_date``."""
    tail = "" if partition_by == "data_date" else f"/{partition_by}={ingestion_date}"
    found = []
    for key in keys:
        held = folders.names(spark, silver_root(root, key)) if tail else set()
        written = sorted(folders.names(spark, silver_root(staged, key)))
        found += [f"{key}/{name}{tail if name in held else ''}" for name in written if name.startswith("source_dataset_id=")]
    return found


def replaced_partition(spark: SparkSession, registry_key: str, dataset_id: str, ingestion_date: str, partition_by: str) -> str:
    """The folder that holds what a dataset wrote earlier and a new version takes the place of."""
    folder = f"{registry_key}/{folders.partition_folder(spark, 'source_dataset_id', dataset_id)}"
    return folder if partition_by == "data_date" else f"{folder}/{partition_by}={ingestion_date}"


def _schemas(spark: SparkSession, root: str) -> list[T.StructType]:
    base = f"{root.rstrip('/')}/{SCHEMAS}"
    names = sorted(folders.children(spark, base))
    if not names:
        return []
    return [T.StructType.fromJson(json.loads(r.value)) for r in spark.read.text([f"{base}/{n}" for n in names]).orderBy("value").collect()]


def _union(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, each under its first spelling."""
    every, known = T.StructType(), set()
    for schema in schemas:
        for f in schema.fields:
            if f.name.lower() not in known:
                known.add(f.name.lower())
                every.add(T.StructField(f.name, f.dataType, True))
    return every


def stage_schema(spark: SparkSession, written: list[T.StructType], root: str, staged: str, registry_key: str, commit: str) -> list[str]:
    """Note columns that are new below a mapping's root; returns the folder to move, if any."""
    now, before = _union(written), _union(_schemas(spark, silver_root(root, registry_key)))
    known = {(f.name.lower(), f.dataType) for f in before.fields}
    new = T.StructType([f for f in now.fields if (f.name.lower(), f.dataType) not in known])
    if not new.fields:
        return []
    folder = f"{registry_key}/{SCHEMAS}/{commit}"
    spark.createDataFrame([(new.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{staged}/{folder}")
    return [folder]


def read_silver(spark: SparkSession, root: str, mapping: Mapping | None = None) -> DataFrame:
    """Read back: lineage columns first, then the mapped and raw columns.

    Pass-through files of one mapping differ in their raw columns. Their union
    is kept by the writer; only a root without it is read for its schemas.
    """
    noted = _union(_schemas(spark, root))
    if noted.fields:
        partitions = [c for c in ("ingestion_date", "data_date") if c in noted.fieldNames()]
        plain = [f for f in noted.fields if f.name not in ("source_dataset_id", *partitions)]
        held = T.StructType([*plain, *[T.StructField(c, T.StringType()) for c in ("source_dataset_id", *partitions)]])
        found = spark.read.schema(held).parquet(root)
    else:
        found = spark.read.option("mergeSchema", True).parquet(root)
    own = [f.name for f in output_schema(mapping)] if mapping else list(LINEAGE)
    return found.select(*own, *[f"`{c.replace('`', '``')}`" for c in found.columns if c not in own])


def partition_uri(base: str, registry_key: Column, dataset_id: Column, date: Column | None) -> Column:
    folder = F.concat(
        F.lit(base.rstrip("/") + "/"),
        registry_key,
        F.lit("/source_dataset_id="),
        F.replace(F.url_encode(dataset_id), F.lit("+"), F.lit("%20")),
    )
    return folder if date is None else F.concat(folder, F.lit("/ingestion_date="), date)
