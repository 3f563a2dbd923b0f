"""Telemetry, events and mappings derived from the given tables.

The tables are clean, so defects are derived from row ids; every row of a table
is used, and the derived data grows with it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.operators.layout import RawLayout
from sunledger.operators.positions import number_rows
from sunledger.operators.registry import ColumnRule, Mapping
from sunledger.operators.transform import conform
from sunledger.session import materialise, work_dir
from sunledger.sinks import folders
from sunledger.sources import files

TELEMETRY = Mapping(
    columns=(
        ColumnRule("ts", "timestamp", "datetime"),
        ColumnRule("sid", "site_id", "string"),
        ColumnRule("pwr_kw", "power_w", "decimal", "kw_to_w", Decimal(0), Decimal(1000)),
    ),
    required_fields=("ts", "sid"),
)
RUN_TIME = "2026-01-01 00:00:00"
TRACE = "00-5ca1ab1e0f00d4c0ffee0123456789ab-0decade0facade01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; ``spark.sql.files.maxPartitionBytes`` decides over how many tasks it is read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money_text(column: str) -> Column:
    """A double with two fraction digits as plain text."""
    return F.col(column).cast("decimal(12,2)").cast("string")


def _every(n: int, column: str = "event_id") -> Column:
    return F.col(column) % n == 0


def telemetry_fields() -> dict[str, Column]:
    """Vendor text columns of one event row, some of them broken."""
    power = money_text("value")
    return {
        "ts": F.when(_every(97), "")
        .when(_every(89), "not-a-datetime")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
        "sid": F.when(_every(101), "").otherwise(F.concat(F.lit("site-"), F.col("user_id"))),
        "pwr_kw": F.when(_every(83), "bad")
        .when(_every(79), F.concat(F.lit("-"), power))
        .when(_every(73), F.concat(F.lit("9999"), power))
        .otherwise(power),
    }


def raw_telemetry(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """``dataset_id``, ``row_index`` and text columns ``ts, sid, pwr_kw`` from ``events``."""
    fields = telemetry_fields()
    rows = table(spark, sf_dir, "events").select(
        F.concat_ws("_", "user_id", "event_type").alias("dataset_id"),
        "event_id",
        *[c.alias(n) for n, c in fields.items()],
    )
    return number_rows(rows, "dataset_id", "event_id") if numbered else rows


def checked_telemetry(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """Telemetry after checks and conversion: ``dataset_id``, ``row_index``, ``failures``, stored columns."""
    rows = raw_telemetry(spark, sf_dir, numbered)
    return conform(
        rows,
        TELEMETRY,
        RawLayout.of_columns(["ts", "sid", "pwr_kw"]),
        carry=["dataset_id", "row_index"] if numbered else ["dataset_id"],
        dataset_id=F.col("dataset_id"),
        schema_version=F.lit("v2"),
        ingestion_time=F.lit(RUN_TIME).cast("timestamp"),
    )


# Attribute spellings of a derived event, in the order they are written.
_JSON = """concat(
    '{"specversion":"1.0",',
    CASE WHEN event_id % 37 = 1 THEN '' WHEN event_id % 11 = 1 THEN '"type":"solar.pvdaq.dataset.available",'
         ELSE '"type":"solar.pvdaq.dataset.available.v1",' END,
    '"source":"/energy-ingestion-boundary/pvdaq",',
    '"id":"00000000-0000-4000-8000-', lpad(CAST(event_id AS STRING), 12, '0'), '",',
    '"time":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z",',
    '"datacontenttype":"application/json",',
    '"dataschema":"https://contracts.example.org/dataset-available.v1.json",',
    CASE WHEN event_id % 13 = 1 THEN '' ELSE '"tenant_id":"research",' END,
    CASE WHEN event_id % 17 = 1 THEN '"mapping_hint":"x",' ELSE '' END,
    '"source_vendor":"PVDAQ","schema_version":"v', CAST(event_id % 3 + 1 AS STRING), '",',
    '"mapping_version":"unknown",',
    '"correlation_id":"', CASE WHEN event_id % 41 = 1 THEN 'ABC' ELSE '10000000-0000-4000-8000-' END,
    lpad(CAST(event_id AS STRING), 12, '0'), '",',
    '"ingestion_timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00",',
    '"traceparent":"00-', CASE WHEN event_id % 31 = 1 THEN repeat('0', 32) ELSE md5(CAST(event_id AS STRING)) END,
    '-', substr(md5(event_type), 1, 16), '-01",',
    '"data":{"site_id":', CASE WHEN event_id % 47 = 1 THEN concat('"', CAST(user_id AS STRING), '"')
                               WHEN event_id % 23 = 1 THEN concat(CAST(user_id + 1 AS STRING), '.0')
                               ELSE CAST(user_id + 1 AS STRING) END, ',',
    '"category":"', event_type, '","file_format":"csv",',
    '"storage_path":"', CASE WHEN event_id % 29 = 1 THEN 'abfss://bronze@acct/'
                             WHEN event_id % 43 = 1 THEN 'http://:80/'
                             ELSE 'http://127.0.0.1:10000/devstoreaccount1/bronze/' END,
    CAST(event_id AS STRING), '_v1.csv",',
    '"version":', CAST(event_id % 7 + 1 AS STRING), ',',
    '"ingestion_id":"20000000-0000-4000-8000-', lpad(CAST(event_id AS STRING), 12, '0'), '",',
    '"source_url":"https://example.org/', CAST(event_id AS STRING), '.csv",',
    '"file_size":', CAST(event_id AS STRING), ',"file_hash":"', repeat(md5(event_type), 2), '"}',
    CASE WHEN event_id % 19 = 1 THEN '' ELSE '}' END,
    CASE WHEN event_id % 53 = 1 THEN ' x' ELSE '' END)"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON event text per row of ``events``, with ``source_id`` (its event number)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("source_id"), F.expr(_JSON).alias("raw"), F.col("event_id").cast("string").alias("event_key")
    )


def derived_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mapping per row of ``customer``; some lack fields or contradict themselves."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('vendor-', c_custkey, '-v', c_nationkey % 3 + 1) AS registry_key",
        "CASE WHEN c_custkey % 17 = 0 THEN '|' WHEN c_custkey % 3 = 0 THEN ';' ELSE ',' END AS delimiter",
        "CASE WHEN c_custkey % 19 = 0 THEN 'latin1' ELSE 'UTF-8' END AS encoding",
        "c_custkey % 10 = 0 AS pass_through_unmapped",
        "array('ts') AS required_fields",
        """filter(array(
            CASE WHEN c_custkey % 7 <> 0 THEN named_struct('vendor_column', 'ts', 'canonical_field', 'Timestamp',
                'data_type', 'datetime', 'unit_conversion', CAST(NULL AS STRING),
                'min_value', CAST(NULL AS DECIMAL(30,12)), 'max_value', CAST(NULL AS DECIMAL(30,12))) END,
            CASE WHEN c_custkey % 5 <> 0 THEN named_struct('vendor_column', 'sid', 'canonical_field', 'site_id',
                'data_type', CASE WHEN c_custkey % 23 = 0 THEN 'text' ELSE 'string' END, 'unit_conversion', CAST(NULL AS STRING),
                'min_value', CAST(NULL AS DECIMAL(30,12)), 'max_value', CAST(NULL AS DECIMAL(30,12))) END,
            named_struct('vendor_column', 'pwr', 'canonical_field', 'power_w', 'data_type', 'decimal',
                'unit_conversion', CASE WHEN c_custkey % 29 = 0 THEN 'f_to_c' ELSE 'kw_to_w' END,
                'min_value', CAST(CASE WHEN c_custkey % 11 = 0 THEN 10 ELSE 0 END AS DECIMAL(30,12)),
                'max_value', CAST(5 AS DECIMAL(30,12))),
            CASE WHEN c_custkey % 13 = 0 THEN named_struct('vendor_column', 'pwr2', 'canonical_field', 'POWER_W',
                'data_type', 'decimal', 'unit_conversion', CAST(NULL AS STRING),
                'min_value', CAST(NULL AS DECIMAL(30,12)), 'max_value', CAST(NULL AS DECIMAL(30,12))) END
        ), m -> m IS NOT NULL) AS column_mappings""",
    )


# Spark's folder name of rows without a partition value.
NO_NUMBER = "__HIVE_DEFAULT_PARTITION__"


def write_lines(lines: DataFrame, root: str) -> DataFrame:
    """Text files from ``file_no``, ``place`` and ``value`` below a new folder: one file per number, lines by place.

    Returns the ``path`` of each file, relative to the folder.
    """
    spark = lines.sparkSession
    placed = lines.repartition("file_no").sortWithinPartitions("file_no", "place").select("file_no", "value")
    folders.make(spark, root)
    here = folders.local(spark, root)
    if here is None:
        placed.write.mode("overwrite").partitionBy("file_no").text(root)
        return files.list_files(spark, root).select(files.relative_path(F.col("file_path"), root).alias("path"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        out, open_no, name, paths = None, None, "", []

        def close() -> None:
            if out is not None:
                out.close()
                path = f"{name}/part-{part:05d}.txt"
                os.replace(f"{name}/.{attempt}", path)
                paths.append(path[len(here) + 1 :])

        for batch in batches:
            numbers, values = batch.column("file_no").to_pylist(), batch.column("value").to_pylist()
            for number, group in groupby(zip(numbers, values), lambda line: line[0]):
                if out is None or number != open_no:
                    close()
                    open_no, name = number, f"{here}/file_no={NO_NUMBER if number is None else number}"
                    os.makedirs(name, exist_ok=True)
                    out = open(f"{name}/.{attempt}", "wb")
                out.writelines((value or b"") + b"\n" for _, value in group)
        close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    # Lines need not be valid UTF-8, so they travel as bytes.
    sent = placed.select("file_no", F.col("value").cast("binary").alias("value"))
    return materialise(sent.mapInArrow(write, "path string"), work_dir(spark, "written"))


# Events per vendor file and documents per text file, so the number of files follows the table.
FILE_ROWS, FILE_TEXTS = 250, 20


def vendor_lines(events: DataFrame, width: int) -> DataFrame:
    """Lines of vendor files of ``width`` consecutive events each, header first.

    Of every eight files one has broken values and one ends with an invalid
    byte; every second file has another column order and an extra column with
    quoted commas.
    """
    events = events.withColumn("file_no", F.expr(f"event_id div {width}"))
    broken = telemetry_fields()
    kind, swapped = F.col("file_no") % 8, F.col("file_no") % 2 == 1
    stamp = F.when(kind == 1, broken["ts"]).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    site = F.when(kind == 1, broken["sid"]).otherwise(F.concat(F.lit("site-"), F.col("user_id")))
    site = F.when(
        (kind == 6) & (F.col("event_id") % width == width - 1), F.unhex(F.lit("FF")).cast("string")
    ).otherwise(site)
    power = F.when(kind == 1, broken["pwr_kw"]).otherwise(money_text("value"))
    note = F.concat(F.lit('"kind '), F.col("event_type"), F.lit(", "), F.col("event_id").cast("string"), F.lit('"'))
    rows = events.select(
        "file_no",
        F.col("event_id").alias("place"),
        F.when(swapped, F.concat_ws(",", power, note, stamp, site))
        .otherwise(F.concat_ws(",", stamp, site, power))
        .alias("value"),
    )
    heads = (
        events.select("file_no")
        .distinct()
        .select(
            "file_no",
            F.lit(-1).cast("bigint").alias("place"),
            F.when(F.col("file_no") % 2 == 1, "pwr_kw,note,ts,sid").otherwise("ts,sid,pwr_kw").alias("value"),
        )
    )
    return rows.unionByName(heads)
