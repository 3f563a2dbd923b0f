"""The registered queries: every operator over the whole given tables.

Each takes (spark, sf_dir) and returns a DataFrame. The input tables are read
with Spark and derived data is described in :mod:`sunledger.plans.inputs`.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.functions import scalars as S
from sunledger.functions import uris
from sunledger.functions.outgoing import content_id
from sunledger.operators import accounting as A
from sunledger.operators import envelope as E
from sunledger.operators import quality as Q
from sunledger.operators import registry as R
from sunledger.operators.contracts import Contract, quarantine_document, validated_document
from sunledger.operators.layout import RawLayout
from sunledger.operators.positions import split_offsets, with_row_index
from sunledger.operators.redrive import redrive_candidates
from sunledger.operators.registry import ColumnRule, Mapping
from sunledger.operators.transform import conform
from sunledger.plans import inputs as I
from sunledger.plans.ingest import IngestConfig, run_batch
from sunledger.session import materialise, prepare, work_dir
from sunledger.sinks import folders, outgoing, quarantine, silver
from sunledger.sources import csv as C
from sunledger.sources import events as Ev
from sunledger.sources import files as Fs
from sunledger.sources.mappings import read_registry
from sunledger.streaming.ingest import run_stream

RUN = datetime(2026, 1, 1, tzinfo=timezone.utc)
Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    REGISTERED[function.__name__] = run
    return run


def _local_time(column: str = "timestamp") -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


# --- data quality and transform over telemetry -------------------------------------------


@query
def canonical_transform(spark, sf_dir):
    """Canonical rows of the datasets in which every row passes."""
    good = Q.accepted_rows(_written_once(spark, I.checked_telemetry(spark, sf_dir, numbered=False)))
    return good.select("site_id", _local_time(), "source_dataset_id", "schema_version", "power_w")


@query
def row_silver(spark, sf_dir):
    """Canonical rows that pass by themselves (row mode)."""
    good = Q.good_rows(I.checked_telemetry(spark, sf_dir, numbered=False))
    return good.select("site_id", _local_time(), "source_dataset_id", "schema_version", "power_w")


def _written_once(spark, rows: DataFrame) -> DataFrame:
    """Checked rows or failures as a table, for what is made from them more than once."""
    return materialise(rows, work_dir(spark, "checked"))


def _failures(spark, sf_dir) -> DataFrame:
    return Q.explode_failures(I.checked_telemetry(spark, sf_dir), "dataset_id")


@query
def validation_failures(spark, sf_dir):
    return _failures(spark, sf_dir)


@query
def validation_summary(spark, sf_dir):
    return Q.summary(_failures(spark, sf_dir))


@query
def first10_failures(spark, sf_dir):
    return Q.first_failures(_failures(spark, sf_dir)).select("dataset_id", "seq", "row_index", "field", "rule", "detail")


@query
def failure_payloads(spark, sf_dir):
    """The dead-letter payload of every failed dataset."""
    report = Q.failure_report(_written_once(spark, _failures(spark, sf_dir)))
    body = F.struct(F.lit("ValidationFailed").alias("error_type"), "dataset_id", "fail_count", "failures")
    return report.select("dataset_id", F.to_json(body).alias("payload"))


@query
def dataset_verdict(spark, sf_dir):
    return Q.verdicts(I.checked_telemetry(spark, sf_dir, numbered=False)).drop("bad_rows")


@query
def row_quarantine_split(spark, sf_dir):
    """Rejected rows with 0-based position and reason code."""
    bad = quarantine.quarantine_rows(Q.bad_rows(I.checked_telemetry(spark, sf_dir)))
    return bad.select("dataset_id", "row_index", "reason_code", F.size("failures").alias("failures"))


@query
def quarantine_records(spark, sf_dir):
    """One reason record per dataset with rejected rows, its main members."""
    events = I.table(spark, sf_dir, "events").select(
        F.concat_ws("_", "user_id", "event_type").alias("dataset_id"),
        (F.col("user_id") + 1).alias("site_id"),
        F.col("event_type").alias("category"),
    ).distinct()
    described = events.select(
        "*",
        F.lit("PVDAQ").alias("source_vendor"),
        F.lit("v2").alias("schema_version"),
        F.lit("unknown").alias("mapping_version"),
        content_id(F.col("dataset_id")).alias("correlation_id"),
        F.lit(I.TRACE).alias("traceparent"),
        F.concat(F.lit("https://storage.example.org/bronze/"), "dataset_id").alias("storage_path"),
        F.lit(1).cast("bigint").alias("version"),
    )
    path = F.concat(F.lit("https://storage.example.org/quarantine/"), F.col("dataset_id"))
    records = quarantine.row_sidecars(_written_once(spark, _failures(spark, sf_dir)), described, F.lit(I.RUN_TIME).cast("timestamp"), path)

    def member(name: str) -> Column:
        return F.get_json_object("body", f"$.{name}")

    return records.select(
        "dataset_id",
        member("reason_code").alias("reason_code"),
        member("scope").alias("scope"),
        member("record_count").cast("bigint").alias("record_count"),
        member("correlation_id").alias("correlation_id"),
        member("source.site_id").cast("bigint").alias("site_id"),
        member("rows[0].row_index").cast("bigint").alias("first_row"),
        member("rows[0].reason_code").alias("first_code"),
    )


@query
def conservation_check(spark, sf_dir):
    """Source rows = silver rows + quarantine rows, per dataset."""
    counted = Q.conservation(I.checked_telemetry(spark, sf_dir, numbered=False))
    return counted.withColumn("balanced", F.col("source_rows") == F.col("silver_rows") + F.col("quarantine_rows"))


# --- header check, pass-through and typed columns over lineitem and orders --------------

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _line_texts(spark, sf_dir) -> DataFrame:
    money = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    texts = [
        I.money_text(c).alias(c) if c in money
        else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "l_shipdate"
        else F.col(c).cast("string").alias(c)
        for c in LINE_COLUMNS
    ]
    return I.table(spark, sf_dir, "lineitem").select(*texts)


@query
def header_check(spark, sf_dir):
    """Mapped columns a supplier's file header lacks; names compare without case."""
    headers = I.table(spark, sf_dir, "lineitem").select("l_suppkey").distinct().select(
        F.concat(F.lit("supplier-"), F.col("l_suppkey")).alias("dataset_id"),
        F.array_compact(
            F.array(
                F.when(F.col("l_suppkey") % 2 == 0, "L_ORDERKEY").otherwise("l_orderkey"),
                F.when(F.col("l_suppkey") % 3 != 0, "l_shipdate"),
                F.when(F.col("l_suppkey") % 5 != 0, "L_Quantity"),
                F.lit("unmapped"),
            )
        ).alias("header"),
    )
    found = Q.header_failures(headers, ["l_orderkey", "L_SHIPDATE", "l_quantity"])
    return found.select("dataset_id", "row_index", "pos", "field", "rule", "detail")


LINE_RULES = (
    ColumnRule("L_SHIPDATE", "timestamp", "datetime"),
    ColumnRule("l_suppkey", "site_id", "string"),
    ColumnRule("l_extendedprice", "energy_wh", "decimal", "kWh_to_Wh", Decimal(0), None),
)


def _conform_lines(spark, sf_dir, pass_through: bool) -> DataFrame:
    layout = RawLayout.of_columns(LINE_COLUMNS)
    return conform(
        _line_texts(spark, sf_dir),
        Mapping(columns=LINE_RULES, pass_through=pass_through),
        layout,
        carry=[],
        dataset_id=F.concat_ws("-", F.lit("order"), F.col("l_orderkey")),
        schema_version=F.lit("v1"),
        ingestion_time=F.lit(I.RUN_TIME).cast("timestamp"),
    )


@query
def pass_through_columns(spark, sf_dir):
    """Unmapped columns kept as raw text next to the canonical ones."""
    rows = _conform_lines(spark, sf_dir, pass_through=True)
    return rows.withColumn("timestamp", _local_time()).drop("failures", "ingestion_time")


@query
def strict_projection(spark, sf_dir):
    """Unmapped columns dropped."""
    rows = _conform_lines(spark, sf_dir, pass_through=False)
    return rows.withColumn("timestamp", _local_time()).drop("failures", "ingestion_time")


ORDER_RULES = tuple(
    ColumnRule(name, name, kind, unit)
    for name, kind, unit in (
        ("as_time", "datetime", None), ("as_decimal", "decimal", "kw_to_w"), ("as_double", "double", "mwh_to_wh"),
        ("as_float", "float", None), ("as_int", "int", "kw_to_w"), ("as_long", "LONG", None),
        ("as_bool", "bool", None), ("as_text", "varchar", None),
    )
)


def _order_texts(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("when_at"),
        F.when(key % 5 == 0, "someday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).alias("as_time"),
        I.money_text("o_totalprice").alias("as_decimal"),
        F.concat(F.lit(" "), I.money_text("o_totalprice"), F.lit("e-2")).alias("as_double"),
        F.when(key % 4 == 0, "0.5").otherwise((key % 100).cast("string")).alias("as_float"),
        F.when(key % 3 == 0, "12.5").otherwise(key.cast("string")).alias("as_int"),
        F.when(key % 7 == 0, "x").otherwise((key * 10_000_000_000).cast("string")).alias("as_long"),
        F.when(key % 3 == 0, "TRUE").when(key % 3 == 1, " false ").otherwise("1").alias("as_bool"),
        F.col("o_orderpriority").alias("as_text"),
    )


def _typed(spark, sf_dir, compat: bool) -> DataFrame:
    texts = _order_texts(spark, sf_dir)
    return conform(
        texts,
        Mapping(columns=(ColumnRule("when_at", "timestamp", "datetime"), *ORDER_RULES)),
        RawLayout.of_columns(texts.columns),
        carry=["order_key"],
        dataset_id=F.lit("orders"),
        schema_version=F.lit("v1"),
        ingestion_time=F.lit(I.RUN_TIME).cast("timestamp"),
        compat=compat,
    )


@query
def typed_cast_matrix(spark, sf_dir):
    """Every data type; unreadable whole numbers, flags and times take their defaults."""
    rows = _typed(spark, sf_dir, compat=True)
    return rows.select(
        "order_key", _local_time(), _local_time("as_time"), "as_decimal", "as_double",
        F.col("as_float").cast("double").alias("as_float"), "as_int", "as_long", "as_bool", "as_text",
    )


@query
def typed_cast_strict(spark, sf_dir):
    """The same without defaults: unreadable values are failures."""
    return Q.explode_failures(
        _typed(spark, sf_dir, compat=False).withColumn("row_index", F.col("order_key").cast("bigint") + 1), "order_key"
    ).select("order_key", "field", "rule", "code", "detail")


@query
def numeric_normalise(spark, sf_dir):
    """Number spellings: signs, parentheses, thousands commas, blanks, exponents, rejects."""
    text, form = I.money_text("l_extendedprice"), F.col("l_orderkey") % 12
    spelled = (
        F.when(form == 0, F.concat(F.lit("("), text, F.lit(")")))
        .when(form == 1, F.concat(text, F.lit("-")))
        .when(form == 2, F.regexp_replace(text, r"([0-9]{3}\.)", ",$1"))
        .when(form == 3, F.concat(F.lit("+"), text))
        .when(form == 4, F.concat(F.lit(" "), text, F.lit("\t ")))
        .when(form == 5, F.concat(text, F.lit("E1")))
        .when(form == 6, "abc")
        .when(form == 7, "")
        .when(form == 8, "NaN")
        .when(form == 9, F.concat(F.lit("-"), text))
        .when(form == 10, F.concat(F.lit("-("), text, F.lit(")")))
        .otherwise(text)
    )
    literal = S.number_text(F.col("spelled"))
    return (
        I.table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", spelled.alias("spelled"))
        .select("l_orderkey", "l_linenumber", "spelled", S.number(literal).cast(S.STORED_DECIMAL).alias("value"))
    )


@query
def unit_conversion(spark, sf_dir):
    """Four conversions, an unknown one and none, by line number."""
    units = {1: "kw_to_w", 2: "MW_to_W", 3: "kwh_to_wh", 4: "mwh_to_wh", 5: "f_to_c"}
    literal = S.number_text(F.col("amount"))
    converted = S.numeric_value(literal, "decimal", None)
    for line, unit in units.items():
        converted = F.when(F.col("l_linenumber") == line, S.numeric_value(literal, "decimal", unit)).otherwise(converted)
    return (
        I.table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", I.money_text("l_extendedprice").alias("amount"))
        .select("l_orderkey", "l_linenumber", "amount", converted.alias("converted"))
    )


@query
def timestamp_parse(spark, sf_dir):
    """Order dates in several spellings; what is no full date is NULL."""
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 10
    spelled = (
        F.when(form == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(form == 2, F.date_format(day, "MM/dd/yyyy HH:mm"))
        .when(form == 3, F.date_format(day, "d MMM yyyy"))
        .when(form == 4, F.date_format(day, "yyyy"))
        .when(form == 5, "10:00")
        .when(form == 6, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("Z ")))
        .when(form == 7, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("x")))
        .when(form == 8, F.date_format(day, "yyyy/M/d"))
        .otherwise("")
    )
    return (
        I.table(spark, sf_dir, "orders")
        .select("o_orderkey", spelled.alias("spelled"))
        .select("o_orderkey", "spelled", S.parse_time(F.col("spelled")).cast("timestamp_ntz").alias("moment"))
    )


# --- events ------------------------------------------------------------------------------


def _checked_events(spark, sf_dir) -> DataFrame:
    return E.check_events(I.raw_events(spark, sf_dir))


@query
def envelope_validation(spark, sf_dir):
    """First reject reason and the list of contract violations of every event."""
    return _checked_events(spark, sf_dir).select("source_id", "reason", F.array_join("errors", "; ").alias("errors"))


@query
def event_type_routing(spark, sf_dir):
    """Events per announced type and route."""
    return (
        _checked_events(spark, sf_dir)
        .groupBy("actual_type", (F.col("reason") == "UnrecognizedEventType").alias("unrecognised"))
        .agg(F.count("*").alias("events"))
        .select("actual_type", F.coalesce("unrecognised", F.lit(False)).alias("unrecognised"), "events")
        .groupBy("actual_type", "unrecognised")
        .agg(F.sum("events").alias("events"))
    )


@query
def reject_precedence(spark, sf_dir):
    """Dead-letter payload of every rejected event; the first failing check wins."""
    rejected = _checked_events(spark, sf_dir).filter(F.col("reason").isNotNull())
    return rejected.select("source_id", "reason", "payload")


@query
def event_projection(spark, sf_dir):
    """Typed columns of the accepted events."""
    good = _checked_events(spark, sf_dir).filter(F.col("reason").isNull())
    return good.select(
        "event_id", "dataset_id", "site_id", "category", "storage_path", "version", "file_size",
        "schema_version", "correlation_id",
    )


@query
def correlation_fallback(spark, sf_dir):
    """Events of which half have a blank correlation id: those get one derived from the message."""
    blank = F.when(F.col("source_id") % 4 == 0, '"correlation_id":""').when(F.col("source_id") % 4 == 1, '"correlation_id":"  "')
    sent = I.raw_events(spark, sf_dir)
    changed = sent.withColumn("raw", F.coalesce(F.regexp_replace("raw", F.lit('"correlation_id":"[^"]*"'), blank), F.col("raw")))
    return E.check_events(changed).select("source_id", "correlation_id")


@query
def storage_path_parse(spark, sf_dir):
    """Container, blob and path keys of storage URIs built from page addresses."""
    page, number = F.col("page_id"), F.col("page_id").cast("string")
    tail = F.concat(
        F.lit("/source%3Dweb/dataset=page%20"), number, F.lit("/ingestion_date=2026-01-02/a+b_v"),
        (page % 9 + 1).cast("string"), F.lit(".csv"),
    )
    path = F.regexp_extract("url", r"^https?://[^/?#]+(/[^?#]*[^/?#])", 1)
    uri = (
        F.when(page % 4 == 0, F.concat(F.lit("http://127.0.0.1:10000/devstoreaccount1"), path, tail))
        .when(page % 4 == 1, F.concat(F.lit("http://azurite:10000/devstoreaccount1"), path, tail))
        .when(page % 4 == 2, F.col("url"))
        .otherwise(F.concat(F.lit("not a uri "), F.col("url")))
    )
    rows = I.table(spark, sf_dir, "pages").select("page_id", uri.alias("uri"))
    keys = uris.storage_fields(F.col("uri"))
    return rows.select("page_id", uris.is_absolute(F.col("uri")).alias("is_absolute"), *[c.alias(n) for n, c in keys.items()])


@query
def latest_event_per_dataset(spark, sf_dir):
    """The event that counts per dataset: highest version, then latest time."""
    good = _checked_events(spark, sf_dir).filter(F.col("reason").isNull())
    kept = good.select("dataset_id", "event_id", "event_key", "event_time", "version")
    latest = E.latest_per_dataset(materialise(kept, work_dir(spark, "events"))).filter(~F.col("superseded"))
    return latest.select("dataset_id", "event_id", "version")


# --- registry ----------------------------------------------------------------------------


@query
def registry_lookup(spark, sf_dir):
    """Mapping found, missing or unusable, for every event."""
    events = I.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("vendor-"), F.col("user_id")).alias("source_vendor"),
        F.concat(F.lit("v"), F.col("event_id") % 3 + 1).alias("schema_version"),
    )
    return R.resolve(events, I.derived_registry(spark, sf_dir)).select("event_id", "registry_key", "problem")


@query
def registry_lint(spark, sf_dir):
    """Contract findings of every mapping."""
    return R.lint(I.derived_registry(spark, sf_dir))


@query
def mapping_explode(spark, sf_dir):
    """Column mappings as rows, in mapping order."""
    exploded = I.derived_registry(spark, sf_dir).select("registry_key", F.posexplode("column_mappings").alias("pos", "m"))
    return exploded.select("registry_key", "pos", "m.vendor_column", "m.canonical_field", "m.data_type", "m.unit_conversion")


# --- sinks, accounting, re-drive ---------------------------------------------------------


def _written(spark, sf_dir) -> DataFrame:
    verdicts = Q.verdicts(I.checked_telemetry(spark, sf_dir, numbered=False)).filter("is_success")
    return verdicts.select(
        "dataset_id",
        F.col("pass_count").alias("record_count"),
        silver.partition_uri("https://storage.example.org/silver", F.lit("PVDAQ-v2"), F.col("dataset_id"), F.lit("2026-01-01")).alias(
            "silver_path"
        ),
        F.lit("v2").alias("schema_version"),
        content_id(F.col("dataset_id")).alias("correlation_id"),
        F.lit("PVDAQ").alias("source_vendor"),
        F.lit(I.TRACE).alias("traceparent"),
        F.col("dataset_id").alias("event_key"),
    )


@query
def notification_events(spark, sf_dir):
    """Flat downstream message per written dataset."""
    return outgoing.notifications(_written(spark, sf_dir), F.lit(I.RUN_TIME).cast("timestamp"))


@query
def validated_envelopes(spark, sf_dir):
    """Contract envelope per written dataset."""
    return outgoing.validated_envelopes(_written(spark, sf_dir), F.lit(I.RUN_TIME).cast("timestamp"))


@query
def idempotent_replace(spark, sf_dir):
    """Write all datasets, write those of two event types again with other values, read back."""
    root = work_dir(spark, "silver")
    rows = I.table(spark, sf_dir, "events").select(
        F.concat(F.lit("site-"), F.col("user_id")).alias("site_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(I.RUN_TIME).cast("timestamp").alias("ingestion_time"),
        F.concat_ws("_", "event_type", F.col("user_id") % 10).alias("source_dataset_id"),
        F.lit("v2").alias("schema_version"),
        F.col("value").cast("decimal(18,6)").alias("power_w"),
        "event_id",
    )
    silver.write_silver(rows, root, "2026-01-01")
    again = rows.filter(F.col("source_dataset_id").startswith("error") | F.col("source_dataset_id").startswith("view"))
    silver.write_silver(again.withColumn("power_w", (-F.col("power_w")).cast("decimal(18,6)")), root, "2026-01-01")
    return silver.read_silver(spark, root).select(
        "site_id", _local_time(), "source_dataset_id", "schema_version", "power_w", "event_id", "ingestion_date"
    )


def _ledger(spark, sf_dir) -> DataFrame:
    """One run per dataset and day; some days fail."""
    day = F.to_date("ts")
    runs = I.table(spark, sf_dir, "events").groupBy(
        F.concat_ws("_", "user_id", "event_type").alias("dataset_id"), day.alias("day")
    ).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))
    failed = F.col("first_id") % 9 == 0
    return runs.select(
        "dataset_id",
        F.col("day").cast("timestamp").alias("run_ts"),
        F.when(failed, "Failed").otherwise("Completed").alias("status"),
        F.when(failed, "ValidationFailed").alias("reason"),
        F.when(failed, 0).otherwise(F.col("n")).alias("records_processed"),
        F.when(failed, 0).otherwise(F.col("n")).alias("validation_pass_count"),
        F.when(failed, F.col("n")).otherwise(0).alias("validation_fail_count"),
        (F.col("first_id") % 1000 + F.col("n")).alias("processing_duration_ms"),
    )


@query
def processing_metrics(spark, sf_dir):
    return A.metric_totals(_ledger(spark, sf_dir))


@query
def run_status(spark, sf_dir):
    return A.last_status(_ledger(spark, sf_dir)).withColumn("run_ts", _local_time("run_ts"))


@query
def outcome_reconciliation(spark, sf_dir):
    """Events without exactly one outcome, and outcomes of unknown events."""
    events = I.table(spark, sf_dir, "events").select(F.col("event_id").alias("event_key"), "event_type")
    once = events.filter(F.col("event_type") != "error")
    twice = events.filter(F.col("event_type") == "signup")
    strangers = events.filter(F.col("event_type") == "view").withColumn("event_key", -F.col("event_key") - 1)
    return A.reconcile(events, once.unionByName(twice).unionByName(strangers))


def _dead_letters(spark, sf_dir) -> DataFrame:
    return _checked_events(spark, sf_dir).filter(F.col("reason").isNotNull())


@query
def dead_letter_report(spark, sf_dir):
    return A.dead_letter_report(_dead_letters(spark, sf_dir))


@query
def dead_letter_listing(spark, sf_dir):
    return A.dead_letter_listing(_dead_letters(spark, sf_dir))


@query
def redrive(spark, sf_dir):
    """Dead letters whose mapping or file has turned up and that have not succeeded since."""
    events = I.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    letters = events.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.when(kind.isin("error", "click"), "UnknownSchema")
        .when(kind.isin("signup", "purchase"), "SourceFileNotFound")
        .otherwise("ValidationFailed")
        .alias("reason"),
        F.concat(F.lit("vendor-"), F.col("user_id"), F.lit("-v"), F.col("event_id") % 3 + 1).alias("registry_key"),
        F.concat(F.lit("file-"), F.col("event_id")).alias("storage_path"),
    )
    present = events.filter(F.col("value") < 40).select(F.concat(F.lit("file-"), F.col("event_id")).alias("storage_path"))
    completed = events.filter(F.col("value").between(20, 30)).select(F.col("event_id").cast("string").alias("event_key"))
    found = redrive_candidates(letters, I.derived_registry(spark, sf_dir), present, completed)
    return found.select("event_key", "reason")


# --- files -------------------------------------------------------------------------------


def _file_no(path: str = "file_path") -> Column:
    return F.regexp_extract(path, "file_no=([0-9]+)", 1).cast("bigint")


@query
def encoding_gate(spark, sf_dir):
    """Encoding and data lines of text files made from the documents, a fifth of the files of each kind."""
    root = work_dir(spark, "texts")
    documents = I.table(spark, sf_dir, "documents")
    width = I.FILE_TEXTS
    numbered = documents.select(F.expr(f"doc_id div {width}").alias("file_no"), "doc_id", "text")
    lines = numbered.select(
        "file_no", F.posexplode(F.split("text", "[\r\n]+")).alias("n", "value"), (F.col("doc_id") * 1_000_000).alias("base")
    ).select("file_no", (F.col("base") + F.col("n")).alias("place"), "value")
    mark = (
        F.when(F.col("file_no") % 5 == 1, F.concat(F.unhex(F.lit("FFFE")).cast("string"), F.lit("h")))
        .when(F.col("file_no") % 5 == 2, F.concat(F.unhex(F.lit("EFBBBF")).cast("string"), F.lit("h")))
        .when(F.col("file_no") % 5 == 4, F.concat(F.unhex(F.lit("FEFF")).cast("string"), F.lit("h")))
        .otherwise("h")
    )
    first = numbered.select("file_no").distinct().select("file_no", F.lit(-1).cast("bigint").alias("place"), mark.alias("value"))
    last = numbered.select("file_no").distinct().filter(F.col("file_no") % 5 == 3).select(
        "file_no", F.lit(2**62).cast("bigint").alias("place"), F.unhex(F.lit("636166E9")).cast("string").alias("value")
    )
    I.write_lines(lines.unionByName(first).unionByName(last), root)
    profile = C.profile_files(spark, [root])
    return profile.select(_file_no().alias("file_no"), "detected_encoding", "data_lines", "header_line")


def _same(lines: DataFrame) -> DataFrame:
    return lines


def _vendor_files(spark, events: DataFrame, root: str) -> DataFrame:
    """Write the vendor files; returns ``file_no`` and ``file_path`` of each."""
    I.write_lines(I.vendor_lines(events, I.FILE_ROWS), root)
    return Fs.list_files(spark, root).select(_file_no().alias("file_no"), "file_path").filter(F.col("file_no").isNotNull())


@query
def csv_scan_row_index(spark, sf_dir):
    """Rows of all vendor files, whatever their header, with their position in the file."""
    root = work_dir(spark, "vendor")
    listed = _vendor_files(spark, I.table(spark, sf_dir, "events"), root)
    heads = C.profile_files(spark, [root]).join(listed, "file_path").select(
        "header_line", "may_span_lines", Fs.decoded_path(F.col("file_path")).alias("path")
    )
    groups: dict[tuple, list[str]] = {}
    for row in heads.collect():  # one short row per file
        key = (row.header_line, row.may_span_lines)
        groups.setdefault(key, []).append(row.path)
    scans = None
    for (line, spanning), paths in sorted(groups.items()):
        layout = RawLayout(C.header_names(line, ","), C.text_column)
        width = len(layout.header)
        if spanning:
            rows = C.scan_spanning_rows(spark, sorted(paths), width, ",", work_dir(spark, "lines"))
        else:
            rows = C.scan_rows(spark, sorted(paths), width, ",")
        named = rows.select("file_path", "block_start", "scan_id", *[layout.get(c).alias(c) for c in ("ts", "sid", "pwr_kw")])
        scans = named if scans is None else scans.unionByName(named)
    rows = materialise(scans, work_dir(spark, "scanned"))
    placed = with_row_index(rows, split_offsets(rows))
    return placed.select(_file_no().alias("file_no"), "row_index", "ts", "sid", "pwr_kw")


@query
def header_groups(spark, sf_dir):
    """Files per distinct header."""
    root = work_dir(spark, "vendor")
    _vendor_files(spark, I.table(spark, sf_dir, "events"), root)
    return C.profile_files(spark, [root]).groupBy("header_line").agg(
        F.count("*").alias("files"), F.sum("data_lines").alias("data_lines")
    )


FILE_MAPPING = {
    "VendorId": "PVDAQ", "SchemaVersion": "v1", "Delimiter": ",", "PassThroughUnmapped": True,
    "RequiredFields": ["ts", "sid"],
    "ColumnMappings": [
        {"VendorColumn": "ts", "CanonicalField": "timestamp", "DataType": "datetime"},
        {"VendorColumn": "sid", "CanonicalField": "site_id", "DataType": "string"},
        {"VendorColumn": "pwr_kw", "CanonicalField": "power_w", "DataType": "decimal",
         "UnitConversion": "kw_to_w", "MinValue": 0, "MaxValue": 1000},
    ],
}


def _awkward(lines: DataFrame) -> DataFrame:
    """Of every sixteen files one has a header only, and one has a record with thousands of fields."""
    kind = F.col("file_no") % 16
    lines = lines.filter((kind != 8) | (F.col("place") < 0))
    counted = lines.withColumn("second", F.min(F.when(F.col("place") >= 0, F.col("place"))).over(W.partitionBy("file_no")))
    wide = (kind == 3) & (F.col("place") == F.col("second"))
    return counted.withColumn("value", F.when(wide, F.concat("value", F.lit(",more" * 21_000))).otherwise(F.col("value"))).drop("second")


def vendor_inputs(spark, events: DataFrame, width: int = I.FILE_ROWS, change=_same) -> tuple[str, DataFrame]:
    """A new folder with vendor files and a registry, and ``file_no`` and ``blob`` of every file.

    Of every sixteen files one has a name that begins with an underscore, and one is announced as an empty file.
    """
    root = work_dir(spark, "ingest")
    bronze = f"{root}/bronze-root/bronze"
    written = I.write_lines(_awkward(change(I.vendor_lines(events, width))), bronze)
    listed = written.select(_file_no("path").alias("file_no"), "path").filter(F.col("file_no").isNotNull())
    path = F.col("path")
    hidden, hollow = F.col("file_no") % 16 == 11, F.col("file_no") % 16 == 13
    blob = (
        F.when(hidden, F.regexp_replace(path, "/([^/]*)$", "/_$1"))
        .when(hollow, F.concat(F.lit("empty/"), F.col("file_no").cast("string"), F.lit(".csv")))
        .otherwise(path)
    )
    named = materialise(listed.select("file_no", "path", blob.alias("blob")), f"{root}/listed")
    odd = named.filter("path <> blob").collect()
    folders.at_once(lambda r: folders.move(spark, f"{bronze}/{r.path}", f"{bronze}/{r.blob}"), [r for r in odd if r.file_no % 16 == 11])
    folders.at_once(lambda r: folders.write_text(spark, f"{bronze}/{r.blob}", ""), [r for r in odd if r.file_no % 16 == 13])
    folders.write_text(spark, f"{root}/registry/PVDAQ-v1.json", json.dumps(FILE_MAPPING))
    return root, named.select("file_no", "blob")


def event_texts(files: DataFrame, version: int = 1) -> DataFrame:
    """One announcement for each row of ``files`` (file_no, blob): dataset ``file_no + 1`` as a version."""
    kind = F.col("file_no") % 8
    number = F.concat(F.lit(f"{version:04d}"), F.lpad(F.col("file_no").cast("string"), 8, "0"))
    uri = F.concat(
        F.lit("http://127.0.0.1:10000/devstoreaccount1/bronze/"), F.col("blob"), F.when(kind == 4, ".gone").otherwise("")
    )
    text = F.to_json(
        F.struct(
            F.lit(E.SPEC_VERSION).alias("specversion"),
            F.when(kind == 7, E.EXPECTED_TYPE.removesuffix(".v1")).otherwise(E.EXPECTED_TYPE).alias("type"),
            F.lit(E.PRODUCER).alias("source"),
            F.concat(F.lit("00000000-0000-4000-8000-"), number).alias("id"),
            F.lit("2026-01-01T00:00:00Z").alias("time"),
            F.lit(E.CONTENT_TYPE).alias("datacontenttype"),
            F.lit(E.DEFAULT_DATASCHEMA).alias("dataschema"),
            F.lit("research").alias("tenant_id"),
            F.lit(E.VENDOR).alias("source_vendor"),
            F.when(kind == 2, "v9").otherwise("v1").alias("schema_version"),
            F.lit("unknown").alias("mapping_version"),
            F.concat(F.lit("10000000-0000-4000-8000-"), number).alias("correlation_id"),
            F.lit("2026-01-01T00:00:00Z").alias("ingestion_timestamp"),
            F.lit(I.TRACE).alias("traceparent"),
            F.struct(
                (F.col("file_no") + 1).alias("site_id"),
                F.lit("telemetry").alias("category"),
                F.lit(E.FILE_FORMAT).alias("file_format"),
                uri.alias("storage_path"),
                F.lit(version).alias("version"),
                F.concat(F.lit("20000000-0000-4000-8000-"), number).alias("ingestion_id"),
                F.lit("https://example.org/source.csv").alias("source_url"),
                F.lit(1).alias("file_size"),
                F.lit("0" * 64).alias("file_hash"),
            ).alias("data"),
        )
    )
    return files.select(text.alias("value"))


def ingest_inputs(spark, events: DataFrame, width: int = I.FILE_ROWS, change=_same) -> str:
    """Vendor files, a registry and one event per file below a new folder."""
    root, files = vendor_inputs(spark, events, width, change)
    event_texts(files).write.text(f"{root}/events")
    return root


def _eighth_next(files: DataFrame) -> DataFrame:
    """Every file number with the file eight further on, which is of the same kind; the last eight have none."""
    later = files.select((F.col("file_no") - 8).alias("file_no"), "blob")
    return files.select("file_no").join(later, "file_no")


def run_files(spark, root: str, events: str = "events", **changes) -> DataFrame:
    """The batch job over the inputs below ``root``; returns its ledger."""
    sent, registry = Ev.read_events(spark, f"{root}/{events}"), read_registry(spark, f"{root}/registry")
    return run_batch(spark, sent, registry, replace(ingest_config(root), **changes))


def ingest_config(root: str) -> IngestConfig:
    return IngestConfig(
        bronze_root=f"{root}/bronze-root", silver_root=f"{root}/silver", outcome_root=f"{root}/out", run_id="query",
        ingestion_time=RUN,
    )


def _outcomes(ledger: DataFrame) -> DataFrame:
    return ledger.select("dataset_id", "status", "stage", "reason", "records_processed", "validation_fail_count")


@query
def ingest_outcomes(spark, sf_dir):
    """The batch job over vendor files, events and a registry: one outcome per event."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    return _outcomes(run_files(spark, root))


@query
def ingest_silver(spark, sf_dir):
    """The silver rows the batch job writes, read back."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root)
    rows = silver.read_silver(spark, silver.silver_root(f"{root}/silver", "PVDAQ-v1"))
    return rows.select("site_id", _local_time(), "source_dataset_id", "schema_version", "power_w", "note", "ingestion_date")


@query
def older_version_survives(spark, sf_dir):
    """Every event again as version 2 of its dataset, announcing a file that is not there: what silver holds after."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    sent = spark.read.text(f"{root}/events")
    newer = F.replace("value", F.lit('"version":1'), F.lit('"version":2'))
    newer = F.replace(newer, F.lit('"id":"00000000-0000-4000-8'), F.lit('"id":"00000000-0000-4000-9'))
    newer = F.regexp_replace(newer, '"storage_path":"([^"]*)"', '"storage_path":"$1.none"')
    materialise(sent, f"{root}/first").select(newer.alias("value")).write.mode("append").text(f"{root}/events")
    ledger = run_files(spark, root)
    done = ledger.groupBy("dataset_id").agg(
        F.count_if(F.col("status") == "Completed").alias("completed"), F.count_if(F.col("status") == "Failed").alias("failed")
    )
    rows = silver.read_silver(spark, silver.silver_root(f"{root}/silver", "PVDAQ-v1"))
    held = rows.groupBy(F.col("source_dataset_id").alias("dataset_id")).agg(F.count(F.lit(1)).alias("n"))
    return done.join(held, "dataset_id", "left").select(
        "dataset_id", "completed", "failed", F.coalesce("n", F.lit(0)).cast("bigint").alias("silver_rows")
    )


def _vendor_names(lines: DataFrame) -> DataFrame:
    """The extra column under a name with a dot and brackets, and one more column named like a work column."""
    head, odd = F.col("place") == -1, F.col("file_no") % 2 == 1
    renamed = F.replace("value", F.lit(",note,"), F.lit(",dc_1.1_(kw),"))
    value = F.when(odd & head, F.concat(renamed, F.lit(",file_path"))).when(odd, F.concat("value", F.lit(",mine")))
    return lines.withColumn("value", value.otherwise(F.col("value")))


@query
def ingest_pass_through(spark, sf_dir):
    """The batch job over vendor files with awkward column names, read back."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"), change=_vendor_names)
    run_files(spark, root)
    rows = silver.read_silver(spark, silver.silver_root(f"{root}/silver", "PVDAQ-v1"))
    return rows.select(
        "site_id", _local_time(), "source_dataset_id", "power_w", F.col("`dc_1.1_(kw)`").alias("dc"), "vendor_file_path"
    )


def _streamed(spark, root: str, parts: list[DataFrame]) -> None:
    """The job on a stream: every part is one file of messages and one micro-batch, in this order."""
    for part in parts:
        part.coalesce(1).write.mode("append").text(f"{root}/sent")
    stream = run_stream(
        spark,
        Ev.stream_events(spark, f"{root}/sent", max_files_per_trigger=1),
        lambda session: read_registry(session, f"{root}/registry"),
        ingest_config(root),
        os.path.join(root, "checkpoint"),
        available_now=True,
        drop_copies_within="1 hour",
        pinned_time=RUN,
    )
    stream.awaitTermination()


@query
def streaming_equals_batch(spark, sf_dir):
    """The same events as a stream of three micro-batches, one with copies of earlier messages; the outcomes of all batches."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    sent = spark.read.text(f"{root}/events")
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    parts = [sent.filter(third == n) for n in range(3)]
    _streamed(spark, root, [parts[0], parts[1], parts[2].unionByName(parts[0])])
    return _outcomes(spark.read.parquet(f"{root}/out/ledger"))


def _silver_rows(spark, root: str) -> DataFrame:
    rows = silver.read_silver(spark, silver.silver_root(f"{root}/silver", "PVDAQ-v1"))
    return rows.select("site_id", _local_time(), "source_dataset_id", "schema_version", "power_w", "note", "ingestion_date")


def _two_versions(spark, sf_dir) -> tuple[str, DataFrame, DataFrame]:
    """Version 1 of every dataset is the file eight further on, version 2 the own file."""
    root, files = vendor_inputs(spark, I.table(spark, sf_dir, "events"))
    return root, event_texts(_eighth_next(files), 1), event_texts(files, 2)


@query
def late_older_version(spark, sf_dir):
    """Newer versions first, older ones in later micro-batches: silver keeps the newest version that passes."""
    root, older, newer = _two_versions(spark, sf_dir)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    _streamed(spark, root, [newer.filter(half == 0), newer.filter(half == 1).unionByName(older.filter(half == 0)), older.filter(half == 1)])
    return _silver_rows(spark, root)


@query
def versions_in_one_batch(spark, sf_dir):
    """All versions at once: the newest one that passes is written."""
    root, older, newer = _two_versions(spark, sf_dir)
    older.unionByName(newer).write.text(f"{root}/events")
    run_files(spark, root)
    return _silver_rows(spark, root)


@query
def batch_replace(spark, sf_dir):
    """A second run, itself repeated, replaces what a first one wrote where the newer version passes."""
    root, files = vendor_inputs(spark, I.table(spark, sf_dir, "events"))
    event_texts(files, 1).write.text(f"{root}/events")
    event_texts(_eighth_next(files), 2).write.text(f"{root}/newer")
    run_files(spark, root)
    for _ in range(2):
        run_files(spark, root, "newer", run_id="second")
    return _silver_rows(spark, root)


@query
def written_dead_letters(spark, sf_dir):
    """The dead letters the batch job writes, with the failures they list."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root)
    letters = spark.read.parquet(f"{root}/out/dead_letter")
    member = lambda name: F.get_json_object("payload", f"$.{name}")
    return letters.select(
        "dataset_id", "reason", member("error_type").alias("error_type"), member("fail_count").cast("bigint").alias("fail_count"),
        member("failures[0].row").cast("bigint").alias("first_row"), F.col("delivery").cast("bigint").alias("delivery"),
    )


@query
def written_summary(spark, sf_dir):
    """The validation summary the batch job writes for every file it has read, by rule; a file without failures has none."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root)
    report = spark.read.parquet(f"{root}/out/validation_summary").filter("status = 'Completed' or size(reasons) > 0")
    each = report.select("dataset_id", "row_count", F.explode_outer("reasons").alias("r"))
    return each.select("dataset_id", "row_count", "r.rule", "r.failures", "r.failed_rows")


@query
def run_reconciliation(spark, sf_dir):
    """Outcomes of the events of a run of two versions: one each, and none that reconciliation finds odd."""
    root, older, newer = _two_versions(spark, sf_dir)
    older.unionByName(newer).write.text(f"{root}/events")
    ledger = run_files(spark, root)
    names = ("events", "superseded", "failed", "notified", "odd_events")
    marks = lambda frame, **one: frame.select(*[F.coalesce(one.get(n, F.lit(0)).cast("bigint"), F.lit(0)).alias(n) for n in names])
    each = marks(ledger, events=F.lit(1), superseded=F.col("superseded"), failed=F.col("status") == "Failed")
    each = each.unionByName(marks(spark.read.parquet(f"{root}/out/notifications"), notified=F.lit(1)))
    each = each.unionByName(marks(spark.read.parquet(f"{root}/out/reconciliation"), odd_events=F.lit(1)))
    return each.agg(*[F.sum(n).alias(n) for n in names])


@query
def written_quarantine(spark, sf_dir):
    """Rows that the job rejects in row mode, read back."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root, mode="row")
    rows = spark.read.parquet(f"{root}/out/quarantine_rows")
    return rows.select(F.col("dataset_id").cast("string").alias("dataset_id"), "row_index", "reason_code", F.size("failures").alias("failures"))


@query
def written_sidecars(spark, sf_dir):
    """Reason records of rows and of whole files that the job writes in row mode."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root, mode="row")
    member = lambda name: F.get_json_object("body", f"$.{name}")
    return spark.read.parquet(f"{root}/out/quarantine_records").select(
        "dataset_id", member("scope").alias("scope"), member("reason_code").alias("reason_code"),
        member("record_count").cast("bigint").alias("record_count"), member("source.version").cast("bigint").alias("version"),
        member("rows[0].row_index").cast("bigint").alias("first_row"), member("rows[0].reason_code").alias("first_code"),
    )


@query
def outgoing_contracts(spark, sf_dir):
    """Violations of their contracts by the messages and quarantine records that the job has written; there are none."""
    root = ingest_inputs(spark, I.table(spark, sf_dir, "events"))
    run_files(spark, root, mode="row")
    address = "https://contracts.example.org/quarantine-record.v1.json"
    kinds = (
        ("validated_events", Contract(validated_document(outgoing.DEFAULT_VALIDATED_SCHEMA), outgoing.DEFAULT_VALIDATED_SCHEMA)),
        ("quarantine_records", Contract(quarantine_document(address), address)),
    )
    found = None
    for table, contract in kinds:
        bodies = spark.read.parquet(f"{root}/out/{table}").withColumn("errors", contract.errors(F.col("body")))
        listed = bodies.select(F.lit(table).alias("written"), "dataset_id", F.array_join("errors", "; ").alias("errors"))
        found = listed if found is None else found.unionByName(listed)
    return found
