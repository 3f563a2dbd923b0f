"""The whole batch job on small vendor files."""

import json
import os
from datetime import datetime, timezone
from decimal import Decimal

import pytest

from sunledger.plans.ingest import IngestConfig, run_batch
from sunledger.sinks.outcomes import read_table
from sunledger.sinks.silver import read_silver, silver_root
from sunledger.sources.events import read_events
from sunledger.sources.mappings import read_registry
from tests import helpers as H

MOMENT = datetime(2026, 4, 10, 12, 0, tzinfo=timezone.utc)


def run(spark, ws, **changes):
    cfg = IngestConfig(
        bronze_root=ws.bronze, silver_root=f"{ws.root}/silver", outcome_root=f"{ws.root}/out",
        ingestion_time=MOMENT, **{"run_id": "batch", **changes},
    )
    ledger = run_batch(spark, read_events(spark, ws.events), read_registry(spark, ws.registry), cfg)
    return {r.dataset_id or r.event_id: r for r in ledger.collect()}


def dead(spark, ws):
    rows = read_table(spark, f"{ws.root}/out", "dead_letter", "raw string").collect()
    return {r.dataset_id or r.event_id: r for r in rows}


@pytest.fixture
def ws(tmp_path):
    return H.Workspace(tmp_path)


def test_valid_file_becomes_canonical_rows(spark, ws):
    ws.file("source=pvdaq/dataset=a b/1_v1.csv", H.VALID)
    ws.send(H.event(1, "source=pvdaq/dataset=a b/1_v1.csv"))
    ledger = run(spark, ws)
    assert (ledger["1_ac_power"].status, ledger["1_ac_power"].records_processed) == ("Completed", 5)
    rows = read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v2"))
    assert rows.columns[:5] == ["site_id", "timestamp", "ingestion_time", "source_dataset_id", "schema_version"]
    assert dict(rows.dtypes)["power_w"] == "decimal(18,6)" and dict(rows.dtypes)["ingestion_date"] == "string"
    got = rows.orderBy("timestamp").collect()
    assert [int(r.power_w) for r in got] == [4200, 5100, 7000, 12600, 20000]
    assert [r.site_id for r in got] == ["dune", "dune", "fen", "fen", "moor"]
    assert {(r.source_dataset_id, r.schema_version, r.ingestion_date) for r in got} == {("1_ac_power", "v2", "2026-04-10")}
    message = json.loads(read_table(spark, f"{ws.root}/out", "notifications", "body string").first().body)
    assert message == {
        "dataset_id": "1_ac_power",
        "record_count": 5,
        "bronze_path": "https://storage.example.org/silver/PVDAQ-v2/source_dataset_id=1_ac_power/ingestion_date=2026-04-10",
        "schema_version": "v2",
        "correlation_id": "10000000-0000-4000-8000-000000000001",
        "published_at": "2026-04-10T12:00:00.0000000+00:00",
    }


def test_every_defect_has_its_reason(spark, ws):
    ws.file("missing.csv", H.MISSING_TIMESTAMP)
    ws.file("number.csv", H.BAD_NUMBER)
    ws.file("empty.csv", H.HEADER_ONLY)
    ws.file("zero.csv", "")
    ws.file("latin.csv", b"read_at,plant,out_mw\n2025-07-02T04:20:00Z,caf\xe9,1\n")
    ws.file("utf16.csv", H.VALID.encode("utf-16"))
    ws.file("header.csv", "read_at,plant\n2025-07-02T04:20:00Z,dune\n")
    ws.file("good.csv", "\ufeff" + H.VALID)
    ws.mapping("PVDAQ-v7", {**H.STRICT, "ColumnMappings": H.STRICT["ColumnMappings"][:1]})
    ws.mapping("PVDAQ-v8", "not json")
    ws.send(
        H.event(1, "missing.csv"), H.event(2, "number.csv"), H.event(3, "empty.csv"), H.event(4, "zero.csv", data__file_size=0),
        H.event(5, "latin.csv"), H.event(6, "utf16.csv"), H.event(7, "header.csv"), H.event(8, "good.csv"),
        H.event(9, "absent.csv"), H.event(10, "good.csv", schema_version="v9"),
        H.event(11, "good.csv", schema_version="v7"), H.event(12, "good.csv", schema_version="v8"),
        H.event(13, type="solar.pvdaq.dataset.available"), H.event(14, tenant_id=...), "not json",
        H.event(16, data__storage_path="http://:80/x"),
    )
    ledger = run(spark, ws)
    letters = dead(spark, ws)
    reasons = {k: r.reason for k, r in letters.items()}
    assert reasons == {
        "1_ac_power": "ValidationFailed",
        "2_ac_power": "ValidationFailed",
        "3_ac_power": "EmptyDataset",
        "4_ac_power": "EmptyDataset",
        "5_ac_power": "UnsupportedEncoding",
        "6_ac_power": "UnsupportedEncoding",
        "7_ac_power": "ValidationFailed",
        "9_ac_power": "SourceFileNotFound",
        "10_ac_power": "UnknownSchema",
        "11_ac_power": "UnknownSchema",
        "12_ac_power": "UnknownSchema",
        "13_ac_power": "UnrecognizedEventType",
        "14_ac_power": "EnvelopeValidationFailed",
        None: "DeserializationFailed",
        "16_ac_power": "InvalidStoragePath",
    }
    assert len(ledger) == 16 and ledger["8_ac_power"].status == "Completed"
    body = json.loads(letters["1_ac_power"].payload)
    assert body == {
        "error_type": "ValidationFailed",
        "dataset_id": "1_ac_power",
        "fail_count": 1,
        "failures": [
            {"row": 2, "field": "read_at", "rule": "RequiredField", "detail": "Required field 'read_at' is null or empty at row 2."}
        ],
    }
    failure = json.loads(letters["2_ac_power"].payload)["failures"][0]
    assert failure["rule"] == "NumericParse" and failure["detail"] == (
        "Field 'out_mw' value 'twelve' is not a valid number at row 2."
    )
    failure = json.loads(letters["7_ac_power"].payload)["failures"][0]
    assert (failure["row"], failure["field"], failure["rule"]) == (0, "out_mw", "UnknownSchema")
    assert json.loads(letters["5_ac_power"].payload)["detected_encoding"] == "non-UTF-8"
    assert json.loads(letters["6_ac_power"].payload)["detected_encoding"] == "UTF-16 LE"
    silver = read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v2"))
    assert [r.source_dataset_id for r in silver.select("source_dataset_id").distinct().collect()] == ["8_ac_power"]


def test_pass_through_files_with_different_headers(spark, ws):
    ws.file("a.csv", H.OPEN_HEADER + "\n" + "\n".join(H.OPEN_ROWS) + "\n")
    # Other column order, one column more, mapped columns missing, values with quotes and line breaks.
    ws.file("b.csv", 'Dc.Volts_(V),clock,note,dataset_id,file_path,\n3.75,2025-07-02T05:30:00Z,"x, ""y""",d1,f1,e1\n4,2025-07-02T06:30:00Z,"two\nlines",d2,f2,e2\n')
    ws.send(H.event(1, "a.csv", schema_version="v1"), H.event(2, "b.csv", schema_version="v1"))
    ledger = run(spark, ws)
    assert [ledger[f"{i}_ac_power"].records_processed for i in (1, 2)] == [3, 2]
    rows = read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v1"))
    a = rows.filter("source_dataset_id = '1_ac_power'").orderBy("timestamp").collect()
    assert [r.yield_north_wh for r in a] == [Decimal(400), Decimal(1750), Decimal(2600)]
    assert {r.site_id for r in a} == {""} and {r["Dc.Volts_(V)"] for r in a} == {None}
    b = rows.filter("source_dataset_id = '2_ac_power'").orderBy("timestamp").collect()
    assert [(r["Dc.Volts_(V)"], r.note) for r in b] == [("3.75", 'x, "y"'), ("4", "two\nlines")]
    assert [(r.vendor_dataset_id, r.vendor_file_path, r.vendor_) for r in b] == [("d1", "f1", "e1"), ("d2", "f2", "e2")]
    assert {r.yield_north_wh for r in b} == {None}


def test_row_mode_splits_rows(spark, ws):
    rows = ["read_at,plant,out_mw"] + [f"2025-07-02T11:{i:02d}:00Z,dune,{'x' if i % 3 == 0 else i}" for i in range(40)]
    ws.file("a.csv", "\n".join(rows) + "\n")
    ws.file("b.csv", H.HEADER_ONLY)
    ws.send(H.event(1, "a.csv"), H.event(2, "b.csv"), H.event(3, "a.csv", schema_version="v9"))
    ledger = run(spark, ws, mode="row")
    assert (ledger["1_ac_power"].status, ledger["1_ac_power"].records_processed) == ("Completed", 26)
    bad = spark.read.parquet(f"{ws.root}/out/quarantine_rows").orderBy("row_index").collect()
    assert [r.row_index for r in bad] == list(range(0, 40, 3)) and {r.reason_code for r in bad} == {"TYPE_MISMATCH"}
    records = {r.dataset_id: json.loads(r.body) for r in spark.read.parquet(f"{ws.root}/out/quarantine_records").collect()}
    assert records["1_ac_power"]["record_count"] == 14 and len(records["1_ac_power"]["rows"]) == 10
    assert records["1_ac_power"]["rows"][1]["row_index"] == 3
    assert (records["2_ac_power"]["scope"], records["2_ac_power"]["reason_code"]) == ("file", "EMPTY_DATASET")
    assert (records["3_ac_power"]["scope"], records["3_ac_power"]["reason_code"]) == ("file", "UNMAPPED_SCHEMA")
    assert all(r["source"]["device_id"] is None for r in records.values())
    assert records["1_ac_power"]["data_path"].startswith("https://") and "1_ac_power" in records["1_ac_power"]["data_path"]


def test_replay_and_new_version_replace(spark, ws):
    ws.file("a_v1.csv", H.VALID)
    ws.file("b.csv", H.VALID)
    ws.send(H.event(1, "a_v1.csv"), H.event(2, "b.csv"), H.event(1, "a_v1.csv"))
    run(spark, ws)
    run(spark, ws)
    root = silver_root(f"{ws.root}/silver", "PVDAQ-v2")
    assert read_silver(spark, root).count() == 10
    ws.file("a_v2.csv", "read_at,plant,out_mw\n2025-07-03T04:20:00Z,tarn,1\n")
    ws.send(H.event(101, "a_v2.csv", data__site_id=1, data__version=2))
    ledger = run(spark, ws, run_id="next")
    assert read_silver(spark, root).groupBy("source_dataset_id").count().collect().__len__() == 2
    assert read_silver(spark, root).count() == 6
    statuses = sorted(r.status for r in spark.read.parquet(f"{ws.root}/out/ledger/run_id=next").collect())
    assert statuses == ["Completed"] * 3 and len(ledger) == 2


def test_waves_and_small_jobs_give_the_same_result(spark, ws):
    for n in range(1, 8):
        ws.file(f"{n}.csv", H.VALID.replace("plant", "plant" if n % 2 else "PLANT"))
    ws.send(*[H.event(n, f"{n}.csv") for n in range(1, 8)])
    ledger = run(spark, ws, max_files_per_wave=2, max_layouts_per_job=1)
    assert {r.records_processed for r in ledger.values()} == {5} and len(ledger) == 7
    assert read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v2")).count() == 35


def test_folder_inside_a_listed_folder(spark, ws):
    ws.file("1.csv", H.VALID)
    ws.file("deep/2.csv", H.VALID)
    ws.send(H.event(1, "1.csv"), H.event(2, "deep/2.csv"), H.event(3, "none/3.csv"))
    ledger = run(spark, ws)
    assert [ledger[f"{n}_ac_power"].records_processed for n in (1, 2, 3)] == [5, 5, 0] and len(ledger) == 3
    assert ledger["3_ac_power"].reason == "SourceFileNotFound"


def test_no_sound_event(spark, ws):
    ws.send("not json")
    ledger = run(spark, ws)
    assert [r.reason for r in ledger.values()] == ["DeserializationFailed"]


def test_older_version_survives_a_bad_newer_one(spark, ws):
    ws.file("a_v1.csv", H.VALID)
    ws.send(H.event(1, "a_v1.csv"), H.event(2, "gone.csv", data__site_id=1, data__version=2))
    run(spark, ws)
    ledger = spark.read.parquet(f"{ws.root}/out/ledger").collect()
    assert sorted((r.status, r.reason) for r in ledger) == [("Completed", None), ("Failed", "SourceFileNotFound")]
    assert read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v2")).count() == 5


def test_replace_leaves_nothing_old(spark, ws):
    ws.mapping("PVDAQ-v3", {**H.STRICT, "SchemaVersion": "v3"})
    ws.file("a.csv", H.VALID)
    ws.send(H.event(1, "a.csv"), H.event(2, "a.csv"))
    run(spark, ws, mode="row")
    ws.file("a.csv", H.HEADER_ONLY + "bad,dune,1\n")
    ws.file("b.csv", H.VALID)
    ws.send(H.event(11, "b.csv", data__site_id=2, data__version=2, schema_version="v3"))
    ledger = run(spark, ws, mode="row", run_id="second")
    assert ledger["1_ac_power"].records_processed == 0
    root = f"{ws.root}/silver"
    counts = {
        (key, r.source_dataset_id): r["count"]
        for key in ("PVDAQ-v2", "PVDAQ-v3")
        if os.listdir(f"{root}/{key}") and any(n.startswith("source") and os.listdir(f"{root}/{key}/{n}") for n in os.listdir(f"{root}/{key}"))
        for r in read_silver(spark, silver_root(root, key)).groupBy("source_dataset_id").count().collect()
    }
    assert counts == {("PVDAQ-v3", "2_ac_power"): 5}


def test_a_repeated_run_replaces_its_outcomes(spark, ws):
    ws.file("a.csv", H.VALID)
    ws.send(H.event(1, "a.csv"), H.event(2, "none.csv"))
    run(spark, ws)
    run(spark, ws, run_id="other")
    run(spark, ws)
    ledger = spark.read.parquet(f"{ws.root}/out/ledger").groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in ledger} == {"batch": 2, "other": 2}
