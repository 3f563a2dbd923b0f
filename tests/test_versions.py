"""Versions of one dataset, staged commits, awkward files, and what the job writes about a run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sunledger.operators.redrive import redrive_candidates, write_redrive
from sunledger.plans import ingest
from sunledger.sinks import commits, folders, silver, versions
from sunledger.sinks.silver import read_silver, silver_root
from sunledger.sources.events import stream_events
from sunledger.sources.mappings import read_registry
from sunledger.streaming.ingest import run_stream
from tests import helpers as H
from tests.test_ingest import dead, run, ws  # noqa: F401

ROW = "2025-07-03T04:20:00Z,{},1\n"


def site_rows(spark, ws, key="PVDAQ-v2"):  # noqa: F811
    rows = read_silver(spark, silver_root(f"{ws.root}/silver", key))
    return {(r.source_dataset_id, r.site_id): r["count"] for r in rows.groupBy("source_dataset_id", "site_id").count().collect()}


def test_a_late_older_version_changes_nothing(spark, ws):  # noqa: F811
    for n in (1, 2, 3):
        ws.file(f"v{n}.csv", H.HEADER_ONLY + ROW.format(f"plant{n}"))
    ws.send(H.event(2, "v2.csv", data__site_id=7, data__version=2))
    run(spark, ws, run_id="a")
    ws.send(H.event(1, "v1.csv", data__site_id=7, data__version=1))
    ledger = run(spark, ws, run_id="b")
    assert site_rows(spark, ws) == {("7_ac_power", "plant2"): 1}
    late = spark.read.parquet(f"{ws.root}/out/ledger/run_id=b").filter("superseded").collect()
    assert [(r.event_id[-1], r.status, r.output_path) for r in late] == [("1", "Completed", None)]
    assert spark.read.parquet(f"{ws.root}/out/notifications/run_id=b").count() == 1
    ws.send(H.event(3, "v3.csv", data__site_id=7, data__version=3))
    run(spark, ws, run_id="c")
    assert site_rows(spark, ws) == {("7_ac_power", "plant3"): 1} and ledger["7_ac_power"].status == "Completed"


def test_equal_versions_go_by_time(spark, ws):  # noqa: F811
    for n in (1, 2):
        ws.file(f"v{n}.csv", H.HEADER_ONLY + ROW.format(f"plant{n}"))
    ws.send(H.event(2, "v2.csv", data__site_id=7, time="2026-05-02T00:00:00Z"), H.event(1, "v1.csv", data__site_id=7, time="2026-05-01T00:00:00Z"))
    run(spark, ws)
    assert site_rows(spark, ws) == {("7_ac_power", "plant2"): 1}


def test_many_versions_cost_as_many_jobs_as_one(spark, ws, monkeypatch):  # noqa: F811
    waves = []
    whole = ingest._wave
    monkeypatch.setattr(ingest, "_wave", lambda *a: waves.append(a[-1]) or whole(*a))
    for n in range(1, 31):
        ws.file(f"v{n}.csv", H.HEADER_ONLY + ROW.format(f"plant{n}"))
        bad = "gone.csv" if n > 28 else f"v{n}.csv"
        ws.send(H.event(n, bad, data__site_id=7, data__version=n))
    run(spark, ws)
    assert waves == ["wave-0"] and site_rows(spark, ws) == {("7_ac_power", "plant28"): 1}
    ledger = spark.read.parquet(f"{ws.root}/out/ledger")
    assert ledger.filter("status = 'Completed'").count() == 28 and ledger.filter("superseded").count() == 27
    assert spark.read.parquet(f"{ws.root}/out/reconciliation").count() == 0


def test_a_failed_write_leaves_the_old_rows(spark, ws, monkeypatch):  # noqa: F811
    ws.mapping("PVDAQ-v3", {**H.STRICT, "SchemaVersion": "v3"})
    ws.file("a.csv", H.VALID)
    ws.send(H.event(1, "a.csv"))
    run(spark, ws, partition_by="data_date")
    before = site_rows(spark, ws)
    ws.file("b.csv", H.HEADER_ONLY + ROW.format("new"))
    ws.send(H.event(2, "b.csv", data__site_id=1, data__version=2, schema_version="v3"))

    def broken(*a):
        raise OSError("disk is gone")

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", broken)
        with pytest.raises(OSError):
            run(spark, ws, partition_by="data_date", run_id="next")
    assert site_rows(spark, ws) == before and sum(before.values()) == 5

    # A commit that is cut off after its note is finished by the next run.
    moves = []
    whole = folders.move

    def twice(s, source, target):
        moves.append(target)
        if len(moves) > 1:
            raise OSError("cut off")
        whole(s, source, target)

    with monkeypatch.context() as m:
        m.setattr(folders, "move", twice)
        with pytest.raises(OSError):
            run(spark, ws, partition_by="data_date", run_id="next")
    assert folders.children(spark, f"{ws.root}/silver/_commits") == ["next-wave-0"]
    run(spark, ws, partition_by="data_date", run_id="next")
    assert site_rows(spark, ws, "PVDAQ-v3") == {("1_ac_power", "new"): 1}
    assert not any(n.startswith("source") for n in os.listdir(f"{ws.root}/silver/PVDAQ-v2"))
    for kind in ("_staging", "_commits", "_retired"):
        assert folders.children(spark, f"{ws.root}/silver/{kind}") == []


def test_versions_are_merged_when_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MANY", 3)
    root = str(tmp_path)
    for n in range(6):
        rows = spark.createDataFrame([("d", n % 4, None, "e", str(n), "k", "2026-01-01"), (f"d{n}", 1, None, "e", "k", "k", "2026-01-01")], versions.SCHEMA)
        staged = commits.begin(spark, root, f"c{n}")
        moves, merged = versions.stage_versions(spark, rows, root, staged, f"c{n}")
        commits.publish(spark, root, f"c{n}", moves, merged)
    found = {r.dataset_id: (r.version, r.event_key) for r in versions.read_versions(spark, root).collect()}
    assert found == {"d": (3, "3"), **{f"d{n}": (1, "k") for n in range(6)}}
    assert len(folders.children(spark, f"{root}/_versions")) <= 3


def test_files_that_listings_pass_over(spark, ws):  # noqa: F811
    ws.file("_hidden.csv", H.VALID)
    ws.file("in/.dotted one.csv", H.VALID)
    ws.file("zero.csv", "")
    ws.file("plain.csv", H.VALID)
    ws.send(H.event(1, "_hidden.csv"), H.event(2, "in/.dotted one.csv"), H.event(3, "zero.csv"), H.event(4, "plain.csv"), H.event(5, "_gone.csv"))
    ledger = run(spark, ws)
    assert {k: (r.reason, r.records_processed) for k, r in ledger.items()} == {
        "1_ac_power": (None, 5), "2_ac_power": (None, 5), "3_ac_power": ("EmptyDataset", 0), "4_ac_power": (None, 5),
        "5_ac_power": ("SourceFileNotFound", 0),
    }


def test_a_record_of_too_many_fields_ends_nothing(spark, ws):  # noqa: F811
    wide = ",".join(f"c{i}" for i in range(21_000))
    ws.file("wide.csv", H.HEADER_ONLY + f"2025-07-03T04:20:00Z,dune,1,{wide}\n" + ROW.format("fen") + f'2025-07-03T04:20:00Z,"a, ""b"",\n",2,"{wide}",{wide}\n')
    ws.file("head.csv", "read_at,plant,out_mw," + wide + "\n" + ROW.format("dune"))
    ws.file("good.csv", H.VALID)
    ws.send(H.event(1, "wide.csv"), H.event(2, "good.csv"), H.event(3, "head.csv"))
    ledger = run(spark, ws)
    assert {k: (r.reason, r.records_processed) for k, r in ledger.items()} == {
        "1_ac_power": (None, 3), "2_ac_power": (None, 5), "3_ac_power": (None, 1),
    }
    assert ("1_ac_power", 'a, "b",\n') in site_rows(spark, ws)


def test_line_ends_inside_quotes_are_kept(spark, ws):  # noqa: F811
    body = "clock,note\r\n2025-07-02T05:30:00Z,\"one\r\ntwo\"\r\n2025-07-02T06:30:00Z,\"three\nfour\rfive\"\r\n2025-07-02T07:30:00Z,six\r\n"
    ws.file("a.csv", body)
    ws.file("b.csv", 'clock,"two\r\nlines"\n2025-07-02T05:30:00Z,x\n2025-07-02T06:30:00Z,y\n')
    ws.send(H.event(1, "a.csv", schema_version="v1"), H.event(2, "b.csv", schema_version="v1"))
    run(spark, ws)
    rows = read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v1")).orderBy("source_dataset_id", "timestamp").collect()
    assert [r.note for r in rows[:3]] == ["one\r\ntwo", "three\nfour\rfive", "six"]
    assert [r["two\r\nlines"] for r in rows[3:]] == ["x", "y"]


def test_read_back_needs_no_footers(spark, ws, monkeypatch):  # noqa: F811
    ws.file("a.csv", "clock,one\n2025-07-02T05:30:00Z,1\n")
    ws.file("b.csv", "clock,two\n2025-07-02T05:30:00Z,2\n")
    ws.send(H.event(1, "a.csv", schema_version="v1"), H.event(2, "b.csv", schema_version="v1"))
    run(spark, ws)
    root = silver_root(f"{ws.root}/silver", "PVDAQ-v1")
    noted = read_silver(spark, root)
    with monkeypatch.context() as m:
        m.setattr(silver, "_schemas", lambda s, r: [])
        merged = read_silver(spark, root)
    assert set(noted.columns) == set(merged.columns) and dict(noted.dtypes) == dict(merged.dtypes)
    key = lambda rows: sorted(map(str, (r.asDict() for r in rows.select(*sorted(rows.columns)).collect())))
    assert key(noted) == key(merged) and len(folders.children(spark, f"{root}/_schema")) == 1
    run(spark, ws, run_id="again")
    assert len(folders.children(spark, f"{root}/_schema")) == 1


def test_summary_and_durations(spark, ws):  # noqa: F811
    slow = H.HEADER_ONLY + "".join(ROW.format(f"p{i}") for i in range(60_000))
    ws.file("slow.csv", slow)
    ws.file("bad.csv", H.BAD_NUMBER)
    ws.file("header.csv", "read_at,plant\n2025-07-02T04:20:00Z,dune\n")
    ws.file("empty.csv", H.HEADER_ONLY)
    ws.send(H.event(1, "slow.csv"), H.event(2, "bad.csv"), H.event(3, "header.csv"), H.event(4, "empty.csv"), "not json")
    ledger = run(spark, ws)
    took = {k: r.processing_duration_ms for k, r in ledger.items() if k}
    assert len({took[k] for k in ("1_ac_power", "2_ac_power", "4_ac_power")}) == 3 and took["1_ac_power"] > took["4_ac_power"] > 0
    report = {r.dataset_id: r for r in spark.read.parquet(f"{ws.root}/out/validation_summary").collect()}
    assert {k: (r.validation_pass_count, r.validation_fail_count) for k, r in report.items()} == {
        "1_ac_power": (60_000, 0), "2_ac_power": (0, 1), "3_ac_power": (0, 1), "4_ac_power": (0, 0),
    }
    assert [tuple(x) for x in report["2_ac_power"].reasons] == [("NumericParse", 1, 1)]
    assert [tuple(x) for x in report["3_ac_power"].reasons] == [("UnknownSchema", 1, 1)]
    assert json.loads(dead(spark, ws)["3_ac_power"].payload)["failures"][0]["field"] == "out_mw"
    assert spark.read.parquet(f"{ws.root}/out/reconciliation").count() == 0


def test_an_event_without_outcome_is_reported(spark, ws, monkeypatch):  # noqa: F811
    ws.file("a.csv", H.VALID)
    ws.send(H.event(1, "a.csv"), H.event(2, "a.csv"))
    whole = ingest._publish
    monkeypatch.setattr(ingest, "_publish", lambda out, cfg, part: whole(out.filter(F.coalesce(F.col("site_id") != 2, F.lit(True))), cfg, part))
    run(spark, ws)
    odd = spark.read.parquet(f"{ws.root}/out/reconciliation").collect()
    assert [(r.known_event, r.outcomes) for r in odd] == [(True, 0)]
    assert read_registry(spark, ws.registry).count() == 2


def test_redrives_reach_the_stream_until_the_limit(spark, ws):  # noqa: F811
    """A file turns up after its event was dead-lettered; another never does and is given up."""
    def go():
        cfg = ingest.IngestConfig(bronze_root=ws.bronze, silver_root=f"{ws.root}/silver", outcome_root=f"{ws.root}/out", run_id="s")
        run_stream(
            spark, stream_events(spark, ws.events), lambda s: read_registry(s, ws.registry), cfg, f"{ws.root}/checkpoint",
            available_now=True, drop_copies_within="1 hour",
        ).awaitTermination()

    def redrive():
        letters = spark.read.parquet(f"{ws.root}/out/dead_letter")
        done = spark.read.parquet(f"{ws.root}/out/ledger").filter("status = 'Completed'").select("event_key")
        paths = spark.createDataFrame([(H.event(n, f"{n}.csv")["data"]["storage_path"],) for n in (1, 2)], "storage_path string")
        found = redrive_candidates(letters, read_registry(spark, ws.registry), paths, done)
        write_redrive(found, ws.events)
        return sorted((r.dataset_id, r.delivery) for r in found.collect())

    ws.send(H.event(1, "1.csv"), H.event(2, "2.csv"))
    go()
    ws.file("1.csv", H.VALID)
    assert redrive() == [("1_ac_power", 1), ("2_ac_power", 1)]
    go()
    assert site_rows(spark, ws) and redrive() == [("2_ac_power", 2)]
    go()
    assert redrive() == []
    ledger = spark.read.parquet(f"{ws.root}/out/ledger").groupBy("dataset_id", "status").count().collect()
    assert sorted(tuple(r) for r in ledger) == [("1_ac_power", "Completed", 1), ("1_ac_power", "Failed", 1), ("2_ac_power", "Failed", 3)]


def test_the_stream_runs_the_job_in_the_session_of_its_caller(spark, ws):  # noqa: F811
    """The stream's own session has no adaptive execution: each small table was as many files as shuffle partitions."""
    seen = []
    ws.file("1.csv", H.HEADER_ONLY + ROW.format("plant1"))
    ws.send(H.event(1, "1.csv"), H.event(2, "2.csv"))
    cfg = ingest.IngestConfig(bronze_root=ws.bronze, silver_root=f"{ws.root}/silver", outcome_root=f"{ws.root}/out", run_id="s")
    run_stream(
        spark, stream_events(spark, ws.events), lambda s: seen.append(s.conf.get("spark.sql.adaptive.enabled")) or read_registry(s, ws.registry),
        cfg, f"{ws.root}/checkpoint", available_now=True, drop_copies_within="1 hour",
    ).awaitTermination()
    assert seen and set(seen) == {spark.conf.get("spark.sql.adaptive.enabled")} == {"true"}
    rows = spark.read.parquet(f"{ws.root}/out/ledger").select("dataset_id", "status").collect()
    assert sorted(map(tuple, rows)) == [("1_ac_power", "Completed"), ("2_ac_power", "Failed")]
