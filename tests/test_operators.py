"""Positions, registry, accounting, re-drive, profile and streaming."""

import csv as pycsv
import json
from datetime import datetime, timezone
from io import StringIO
from random import Random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.operators import accounting as A
from sunledger.operators import registry as R
from sunledger.operators.positions import number_rows, split_offsets, with_row_index
from sunledger.operators.redrive import redrive_candidates, write_redrive
from sunledger.plans.ingest import IngestConfig
from sunledger.sinks.outcomes import read_table
from sunledger.sinks.silver import read_silver, silver_root
from sunledger.sources import csv as C
from sunledger.sources import files as Fs
from sunledger.sources.events import read_events, stream_events
from sunledger.sources.mappings import read_registry
from sunledger.streaming.ingest import run_stream
from tests import helpers as H


def test_numbering_of_a_hot_key(spark):
    rows = spark.range(5000).select((F.col("id") * 3).alias("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"))
    plain = rows.withColumn("row_index", F.row_number().over(W.partitionBy("k").orderBy("id")).cast("bigint"))
    assert number_rows(rows, "k", "id", width=100).exceptAll(plain.select("k", "id", "row_index")).isEmpty()


def test_row_index_over_splits(spark, tmp_path):
    expected = {}
    for name, n in (("a", 5000), ("b", 17), ("c", 3000)):
        with open(tmp_path / f"{name}.csv", "w") as f:
            f.write("x,y\n" + "".join(f"{i},{name}\n" + ("\n" if i % 50 == 0 else "") for i in range(n)))
        expected[name] = n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = C.scan_rows(spark, [str(tmp_path / f"{n}.csv") for n in expected], 2, ",")
        assert rows.rdd.getNumPartitions() > 10
        got = with_row_index(rows, split_offsets(rows)).groupBy("_c1").agg(
            F.count("*").alias("n"), F.count_if(F.col("row_index") == F.col("_c0").cast("int") + 1).alias("right")
        )
        assert {r._c1: (r.n, r.right) for r in got.collect()} == {k: (n, n) for k, n in expected.items()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("delimiter", [",", ";", "\t"])
def test_records_over_lines_and_splits(spark, tmp_path, delimiter):
    """Against Python's own reader, in splits far smaller than a file."""
    random, expected = Random(7), {}
    for name in "abc":
        rows = [
            [f"{name}{i}", *["".join(random.choice('xy "\n' + delimiter) for _ in range(random.randint(0, 9))) for _ in range(2)]]
            for i in range(400)
        ]
        if name == "b":
            rows.append(["b400", "y" * 3000 + "\n" + "z" * 3000, ""])
        body = StringIO()
        pycsv.writer(body, delimiter=delimiter, lineterminator="\n").writerows([["k", "p\nq", "r"], *rows])
        text = body.getvalue() + f'{name}-stray{delimiter}5" pipe{delimiter}x\n\n{name}-last{delimiter}"a""b"{delimiter}\n'
        rows += [[f"{name}-stray", '5" pipe', "x"], [f"{name}-last", 'a"b', ""]]
        (tmp_path / f"{name}.csv").write_text(text, newline="")
        expected |= {row[0]: (i, row[1], row[2]) for i, row in enumerate(rows, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        paths = [str(tmp_path / f"{n}.csv") for n in "abc"]
        rows = C.scan_spanning_rows(spark, paths, 3, delimiter, str(tmp_path / "scratch"))
        got = with_row_index(rows, split_offsets(rows)).fillna("").collect()
        assert {r._c0: (r.row_index, r._c1, r._c2) for r in got} == expected and len(got) == len(expected)
        assert spark.read.parquet(str(tmp_path / "scratch" / "begins")).count() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_profile(spark, tmp_path):
    texts = {
        "plain": b"a;b\n1;2\n", "bom": b"\xef\xbb\xbfa,b\n\n1,2\n", "late": b"a,b\n" + b"1,2\n" * 5000 + b"\xff,1\n",
        "be": "a,b\n1,2\n".encode("utf-16-be").join([b"\xfe\xff", b""]), "blank": b"\n\na,b\n1,2\n  \n",
        "quoted": b'a,b\n"1\n2",3\n', "genuine": "a,b\n�,1\n".encode(),
    }
    for name, body in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(body)
    profile = C.profile_files(spark, [str(tmp_path)])
    got = {r.file_path.rsplit("/", 1)[1][:-4]: tuple(r)[1:] for r in profile.collect()}
    assert got == {
        "plain": (None, 1, "a;b", False),
        "bom": (None, 1, "a,b", False),
        "late": ("non-UTF-8", 5001, "a,b", False),
        "be": ("UTF-16 BE", got["be"][1], None, got["be"][3]),
        "blank": (None, 2, "a,b", True),
        "quoted": (None, 2, "a,b", True),
        "genuine": (None, 1, "a,b", False),
    }
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort " not in plan


def test_registry_files(spark, tmp_path):
    ws = H.Workspace(tmp_path)
    ws.mapping("x-y-v1", {**H.STRICT, "ColumnMappings": H.STRICT["ColumnMappings"][:1]})
    ws.mapping("x-y-v2", {**H.STRICT, "ColumnMappings": H.STRICT["ColumnMappings"][1:]})
    bounds = [{**H.STRICT["ColumnMappings"][2], "MinValue": 2.5, "MaxValue": 1}]
    ws.mapping("x-y-v3", {**H.STRICT, "ColumnMappings": H.STRICT["ColumnMappings"][:2] + bounds})
    ws.mapping("x-y-v4", "[1]")
    ws.mapping("x-y-v5", {**H.STRICT, "ColumnMappings": H.STRICT["ColumnMappings"] + H.STRICT["ColumnMappings"][2:]})
    registry = read_registry(spark, ws.registry)
    got = {r.registry_key: r for r in R.with_problem(registry).collect()}
    assert {k: r.problem for k, r in got.items()} == {
        "PVDAQ-v1": None,
        "PVDAQ-v2": None,
        "x-y-v1": "no mapping for site_id",
        "x-y-v2": "no mapping for timestamp",
        "x-y-v3": "min_value exceeds max_value",
        "x-y-v4": "mapping is not readable",
        "x-y-v5": "canonical field is mapped twice",
    }
    strict, open_ = R.Mapping.from_row(got["PVDAQ-v2"]), R.Mapping.from_row(got["PVDAQ-v1"])
    assert [c.canonical_field for c in strict.columns] == ["timestamp", "site_id", "power_w"]
    assert len(open_.columns) == 4 and open_.pass_through and open_.columns[1].min_value == 0
    assert {(r.registry_key, r.finding) for r in R.lint(registry).collect()} == {("x-y-v3", "bounds")}


def test_ledger_reports(spark):
    ledger = spark.createDataFrame(
        [("a", datetime(2026, 1, 1), "Failed", "EmptyDataset", 0, 0, 0, 10), ("a", datetime(2026, 1, 2), "Completed", None, 5, 5, 0, 30)],
        "dataset_id string, run_ts timestamp, status string, reason string, records_processed bigint,"
        " validation_pass_count bigint, validation_fail_count bigint, processing_duration_ms bigint",
    )
    total = A.metric_totals(ledger).first()
    assert (total.records_processed, total.runs, total.max_duration_ms) == (5, 2, 30)
    assert A.last_status(ledger).first().status == "Completed"


def test_stream_with_redelivery_then_redrive(spark, tmp_path):
    ws = H.Workspace(tmp_path)
    ws.file("1.csv", H.VALID)
    cfg = IngestConfig(bronze_root=ws.bronze, silver_root=f"{ws.root}/silver", outcome_root=f"{ws.root}/out", run_id="s")

    def drain():
        stream = run_stream(
            spark, stream_events(spark, ws.events), lambda s: read_registry(s, ws.registry), cfg, f"{ws.root}/cp",
            available_now=True, drop_copies_within="1 hour", pinned_time=datetime(2026, 4, 10, tzinfo=timezone.utc),
        )
        stream.awaitTermination()
        return {r.dataset_id: r.status for r in spark.read.parquet(f"{ws.root}/out/ledger").orderBy("run_id").collect()}

    ws.send(H.event(1, "1.csv"), H.event(2, "2.csv"), H.event(1, "1.csv"))
    assert drain() == {"1_ac_power": "Completed", "2_ac_power": "Failed"}
    ws.send(H.event(1, "1.csv"))
    assert drain() == {"1_ac_power": "Completed", "2_ac_power": "Failed"}
    assert spark.read.parquet(f"{ws.root}/out/ledger").count() == 2

    ws.file("2.csv", H.VALID)
    letters = read_table(spark, f"{ws.root}/out", "dead_letter", "raw string")
    event = json.loads(letters.first().raw)
    present = Fs.list_files(spark, ws.bronze).select(
        F.concat(F.lit("http://127.0.0.1:10000/devstoreaccount1/"), Fs.relative_path(F.col("file_path"), ws.bronze)).alias("storage_path")
    )
    done = spark.read.parquet(f"{ws.root}/out/ledger").filter("status = 'Completed'")
    found = redrive_candidates(letters, read_registry(spark, ws.registry), present, done)
    assert [r.storage_path for r in found.collect()] == [event["data"]["storage_path"]]
    write_redrive(found, f"{ws.root}/again")
    again = read_events(spark, f"{ws.root}/again")
    assert json.loads(again.first().raw) == event
    assert read_silver(spark, silver_root(f"{ws.root}/silver", "PVDAQ-v2")).count() == 5
