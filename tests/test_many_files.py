"""Calls and tasks that grow with the number of files: listings in one go, folders asked for once."""

import os

import pytest
from pyspark.sql.readwriter import DataFrameReader

from sunledger import session
from sunledger.sinks import commits, folders, silver
from sunledger.sources import files as Fs


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def texts(root):
    """Text of every file by its folder below ``root``, checksums left out."""
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if not n.startswith("."):
                with open(f"{folder}/{n}") as f:
                    found[os.path.relpath(folder, root)] = f.read()
    return found


def test_a_listing_has_few_tasks(spark):
    spark.conf.set(session.LISTING, "10000")
    session.prepare(spark)
    assert int(spark.conf.get(session.LISTING)) == session.LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(session.LISTING, "3")
    session.prepare(spark)
    assert spark.conf.get(session.LISTING) == "3"
    spark.conf.unset(session.LISTING)
    session.prepare(spark)


@pytest.mark.parametrize("gone", [[], ["n/9", "n/91", "n/92", "n/93"], None])
def test_all_folders_are_listed_at_once(spark, tmp_path, monkeypatch, gone):
    monkeypatch.setattr(Fs, "FOLDERS_PER_LISTING", 2)
    here = [f"n/{n}" for n in range(1, 8)] + ["n/a b"]
    for name in here:
        write(f"{tmp_path}/{name}/x.csv", "12")
    loads, load = [], DataFrameReader.load
    monkeypatch.setattr(DataFrameReader, "load", lambda self, *a, **k: loads.append(a) or load(self, *a, **k))
    asked = ["n/none", "n/no"] if gone is None else here + gone
    wanted = spark.createDataFrame([(n,) for n in asked], "folder string")
    rows = Fs.list_files(spark, str(tmp_path), wanted).collect()
    assert len({r.file_path for r in rows}) == len(rows) == (0 if gone is None else len(here)) and {r.length for r in rows} <= {2}
    assert len(loads) <= 2


def test_names_of_a_folder(spark, tmp_path):
    for name in ("a b, c", "x=%2F", "é"):
        os.makedirs(tmp_path / name)
    assert folders.names(spark, str(tmp_path)) == {"a b, c", "x=%2F", "é"}
    assert folders.names(spark, f"{tmp_path}/é") == folders.names(spark, f"{tmp_path}/none") == set()


def stage(spark, root, commit, text, names, day="2026-01-01"):
    staged = commits.begin(spark, root, commit)
    for n in names:
        write(f"{staged}/k/source_dataset_id={n}/ingestion_date={day}/part", text)
    return staged, silver.staged_partitions(spark, root, staged, ["k"], day, "ingestion_date")


def test_a_commit_asks_for_no_new_folder(spark, tmp_path, monkeypatch):
    root, asked, moved = str(tmp_path), [], []
    exists, move = folders.exists, folders.move
    monkeypatch.setattr(folders, "exists", lambda s, p: asked.append(p) or exists(s, p))
    monkeypatch.setattr(folders, "move", lambda s, a, b: moved.append(b) or move(s, a, b))
    _, moves = stage(spark, root, "c1", "old", range(20))
    commits.publish(spark, root, "c1", moves, [])
    assert asked == [] and len(moved) == 20
    # A second day and a second version: the day's partition alone is replaced, a dataset that is gone is removed.
    _, moves = stage(spark, root, "c2", "next", [1], "2026-01-02")
    commits.publish(spark, root, "c2", moves, [])
    _, moves = stage(spark, root, "c3", "new", [1, 2, 30])
    commits.publish(spark, root, "c3", moves, ["k/source_dataset_id=3/ingestion_date=2026-01-01", "k/source_dataset_id=77"])
    assert asked == []
    one = lambda n, day="01": f"k/source_dataset_id={n}/ingestion_date=2026-01-{day}"
    expected = {one(n): "old" for n in range(20) if n != 3}
    assert texts(root) == {**expected, one(1): "new", one(2): "new", one(30): "new", one(1, "02"): "next"}
    for kind in (commits.STAGING, commits.NOTES, commits.RETIRED):
        assert folders.children(spark, f"{root}/{kind}") == []


def test_a_swap_that_was_cut_in_half_is_finished(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _, moves = stage(spark, root, "c1", "old", [1, 2, 3])
    commits.publish(spark, root, "c1", moves, [])
    _, moves = stage(spark, root, "c2", "new", [1, 2, 4])
    retire = folders.retire

    def cut(s, target, aside, source):
        retire(s, target, aside, None)  # the old rows are aside, the new ones are not yet in their place
        raise OSError("cut off")

    with monkeypatch.context() as m:
        m.setattr(folders, "retire", cut)
        with pytest.raises(OSError):
            commits.publish(spark, root, "c2", moves, ["k/source_dataset_id=3/ingestion_date=2026-01-01"])
    commits.recover(spark, root)
    assert texts(root) == {f"k/source_dataset_id={n}/ingestion_date=2026-01-01": "new" for n in (1, 2, 4)}


DAY, NEXT = "2026-01-01", "2026-01-02"


def stage_rows(spark, root, commit, ids, day):
    staged = commits.begin(spark, root, commit)
    rows = spark.createDataFrame([(n, commit) for n in ids], "source_dataset_id string, power_w string")
    silver.stage_silver(rows.repartition(2, "source_dataset_id"), staged, "k", day, "ingestion_date")
    return silver.staged_moves(spark, root, staged, ["k"], day, "ingestion_date")


def held(spark, root):
    rows = spark.read.parquet(f"{root}/k").select("source_dataset_id", "ingestion_date", "power_w")
    return {tuple(map(str, r)) for r in rows.collect()}


def test_a_dataset_is_staged_as_one_folder(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    moves = stage_rows(spark, root, "c1", ["1", "2", "a b/c"], DAY)
    below = [d for d, inner, _ in os.walk(commits.staging(root, "c1")) if "=" in d]
    assert len(below) == len(moves) == 3 and not [d for d in below if "ingestion_date" in d]
    assert all(target == f"{source}/ingestion_date={DAY}" for source, target in moves)
    commits.publish(spark, root, "c1", moves, [])
    first = {(n, DAY, "c1") for n in ("1", "2", "a b/c")}
    assert held(spark, root) == first
    # Another day stays beside the first one, the same day is replaced, and a dropped one goes.
    commits.publish(spark, root, "c2", stage_rows(spark, root, "c2", ["1"], NEXT), [])
    dropped = [f"k/source_dataset_id=2/ingestion_date={DAY}"]
    commits.publish(spark, root, "c3", stage_rows(spark, root, "c3", ["1", "3"], DAY), dropped)
    now = {("1", NEXT, "c2"), ("1", DAY, "c3"), ("3", DAY, "c3"), ("a b/c", DAY, "c1")}
    assert held(spark, root) == now
    # Cut off before each move of a commit that is noted: the next run finishes it.
    moves = stage_rows(spark, root, "c4", ["1", "3", "4"], DAY)
    with monkeypatch.context() as m:
        m.setattr(folders, "move", lambda *a: os.makedirs(os.path.dirname(a[2])) or 1 / 0)
        m.setattr(folders, "retire", lambda s, target, aside, source, retire=folders.retire: retire(s, target, aside, None) and 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commits.publish(spark, root, "c4", moves, [])
    commits.recover(spark, root)
    assert held(spark, root) == {("1", NEXT, "c2"), *((n, DAY, "c4") for n in ("1", "3", "4")), ("a b/c", DAY, "c1")}


def test_local_folders_are_moved_without_a_call_of_the_file_system(spark, tmp_path, monkeypatch):
    for name in ("a/x", "b/x"):
        write(f"{tmp_path}/{name}/part", name)
    os.makedirs(f"{tmp_path}/aside")
    folders.local(spark, str(tmp_path))

    class Silent:
        def __getattr__(self, name):
            raise AssertionError(f"asked to {name}")

    monkeypatch.setattr(folders, "at", lambda *a: (Silent(), None))
    folders.move(spark, f"{tmp_path}/a/x", f"{tmp_path}/new/deep/x")
    assert folders.retire(spark, f"{tmp_path}/new/deep/x", f"{tmp_path}/aside/0", f"{tmp_path}/b/x")
    assert not folders.retire(spark, f"{tmp_path}/none", f"{tmp_path}/aside/1", None)
    assert texts(tmp_path) == {"new/deep/x": "b/x", "aside/0": "a/x"}


def test_a_move_that_cannot_be_made_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        folders.move(spark, f"{tmp_path}/none", f"{tmp_path}/there")


def test_unlisted_paths_are_fetched_in_few_jobs(spark, tmp_path):
    for n in range(6):
        write(f"{tmp_path}/root/n/_{n}.csv", "x" * n)
    wanted = spark.createDataFrame([(f"n/_{n}.csv",) for n in range(8)] * 2, "relative_path string")
    context, before = spark.sparkContext, {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        context.setJobGroup("unlisted", "")
        found = Fs.locate(spark, f"{tmp_path}/root", wanted, f"{tmp_path}/scratch")
        jobs = len(context.statusTracker().getJobIdsForGroup("unlisted"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.relative_path, r.length) for r in found.collect()} == {(f"n/_{n}.csv", n) for n in range(6)}
    assert jobs <= 30
