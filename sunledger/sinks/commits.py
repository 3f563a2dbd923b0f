"""Staged replacement of silver partitions: written aside, noted, swapped, and old data removed last.

Below a silver root lie, next to the folder of each mapping:

* ``_staging/<commit>/``: what a commit has written, in the layout of the root;
* ``_commits/<commit>/``: the note of a commit, one row for each move and removal. Once its
  marker is there the commit holds and is finished by whoever comes next;
* ``_retired/<commit>/``: what the commit has replaced, until all its moves are done.

A job that fails before the note leaves the old partitions as they were; one that
fails after it is completed by :func:`recover`. One job at a time writes a root.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sunledger.sinks import folders

STAGING, NOTES, RETIRED = "_staging", "_commits", "_retired"
NOTE = "source string, target string"


def staging(root: str, commit: str) -> str:
    """Where a commit writes; an earlier attempt's rest is replaced by the writers."""
    return f"{root.rstrip('/')}/{STAGING}/{commit}"


def begin(spark: SparkSession, root: str, commit: str) -> str:
    """An empty staging folder for ``commit``."""
    folders.delete(spark, staging(root, commit))
    return staging(root, commit)


def publish(spark: SparkSession, root: str, commit: str, moves: list[str | tuple[str, str]], removed: list[str]) -> None:
    """Put the staged folders ``moves`` in the place of older ones and drop ``removed``, all relative to the root.

    A move whose place differs from that below the staging folder is a pair of both.
    """
    note = [(move, move) if isinstance(move, str) else move for move in moves] + [("", folder) for folder in removed]
    spark.createDataFrame(note, NOTE).coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/{NOTES}/{commit}")
    finish(spark, root, commit, fresh=True)


def finish(spark: SparkSession, root: str, commit: str, fresh: bool = False) -> None:
    """Carry out a noted commit; what an earlier attempt has done is not done again.

    One listing a mapping tells which folders are new; only the others are asked
    for one by one. ``fresh``: this is the first attempt, so all that was staged is there.
    """
    root = root.rstrip("/")
    retired, staged, note = (f"{root}/{kind}/{commit}" for kind in (RETIRED, STAGING, NOTES))

    def swap(item) -> None:
        n, row = item
        source, target = f"{staged}/{row.source}", f"{root}/{row.target}"
        if row.source and not there(staged, row.source):
            return
        if known(root, row.target) and folders.retire(spark, target, f"{retired}/{n}", source if row.source else None):
            return
        if row.source:
            folders.move(spark, source, target)

    def known(base: str, folder: str) -> bool:
        top, name = folder.split("/")[:2]
        return name in held[base, top]

    def there(base: str, folder: str) -> bool:
        deep = folder.count("/") > 1 and not fresh
        return known(base, folder) and (not deep or folders.exists(spark, f"{base}/{folder}"))

    rows = list(enumerate(spark.read.schema(NOTE).json(note).collect()))
    tops = {folder.split("/")[0] for _, r in rows for folder in (r.source, r.target) if folder}
    held = {(base, top): folders.names(spark, f"{base}/{top}") for base in (root, staged) for top in tops}
    folders.make(spark, retired)
    folders.at_once(swap, [x for x in rows if x[1].source])
    folders.at_once(swap, [x for x in rows if not x[1].source])
    for done in (retired, staged, note):
        folders.delete(spark, done)


def recover(spark: SparkSession, root: str) -> None:
    """Finish the commits that hold and drop the notes that were never completed."""
    for commit in sorted(folders.children(spark, f"{root.rstrip('/')}/{NOTES}")):
        note = f"{root.rstrip('/')}/{NOTES}/{commit}"
        if folders.exists(spark, f"{note}/_SUCCESS"):
            finish(spark, root, commit)
        else:
            folders.delete(spark, note)
