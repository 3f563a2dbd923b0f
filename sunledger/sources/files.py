"""File listings as DataFrames, and the mapping from storage URIs to listed files."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sunledger.functions.uris import percent_decode
from sunledger.session import materialise
from sunledger.sinks import folders as Fo


def decoded_path(file_path: Column) -> Column:
    """Path part of a file URI, percent-decoded."""
    return percent_decode(file_path)


# Folders that one pattern names.
FOLDERS_PER_LISTING = 200


def list_files(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """``file_path`` and ``length`` of every file below ``root``; contents are not read.

    ``folders`` (one ``folder`` per row, relative to the root) narrows the listing
    to those folders, which spares a batch of events a listing of the whole lake.
    Folders that do not exist are skipped.
    """
    reader, wheres = spark.read.format("binaryFile").option("recursiveFileLookup", True), [root]
    if folders is not None:
        names = sorted(r.folder for r in folders.select("folder").distinct().collect())
        chunks = [names[i : i + FOLDERS_PER_LISTING] for i in range(0, len(names), FOLDERS_PER_LISTING)]
        wheres = [f"{as_glob(root)}/{{{','.join(map(as_glob, chunk))}}}" for chunk in chunks]
    found = _loaded(reader, wheres)
    if found is None:
        # One pattern without a match fails the whole listing; the others are listed together.
        present = Fo.at_once(lambda where: Fo.matches(spark, where), wheres)
        found = _loaded(reader, [w for w, there in zip(wheres, present, strict=True) if there])
    if found is None:
        return spark.createDataFrame([], "file_path string, length bigint")
    listed = found.select(F.col("_metadata.file_path").alias("file_path"), "length")
    # One listed folder may lie inside another.
    return listed if folders is None else listed.dropDuplicates(["file_path"])


def _loaded(reader: DataFrameReader, wheres: list[str]) -> DataFrame | None:
    """All patterns in one listing; none when one of them names nothing."""
    try:
        return reader.load(wheres) if wheres else None
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


LOCATED = "relative_path string, number bigint, length bigint"
# Paths that are asked for at a time.
ASKED = 10_000


def locate(spark: SparkSession, root: str, wanted: DataFrame, scratch: str) -> DataFrame:
    """``relative_path``, ``file_path`` and ``length`` of files that a listing leaves out although they exist.

    ``wanted`` has one ``relative_path`` per file that is not listed. Spark's
    listings pass over empty files and over names that begin with an underscore
    or a dot. The file system is asked for each path, some calls at a time; a
    file of such a name, which Spark's readers would pass over too, is copied as
    a stream to ``scratch`` under a name they accept.
    """
    conf = spark._jsc.hadoopConfiguration()
    copy = Fo.java_class(spark.sparkContext, "org.apache.hadoop.fs.FileUtil").copy

    def ask(item: tuple[int, str]) -> tuple[str, str, int] | None:
        number, relative = item
        here = Fo.local(spark, f"{root}/{relative}")
        if here is not None:
            if not os.path.isfile(here):
                return None
            size = os.path.getsize(here)
            if size:
                shutil.copyfile(here, f"{Fo.local(spark, scratch)}/{number}.csv")
            return relative, number, size
        system, where = Fo.at(spark, f"{root}/{relative}")
        if not system.exists(where):
            return None
        status = system.getFileStatus(where)
        if status.isDirectory():
            return None
        if status.getLen():
            copied, to = Fo.at(spark, f"{scratch}/{number}.csv")
            copy(system, status.getPath(), copied, to, False, True, conf)
        return relative, number, status.getLen()

    Fo.make(spark, scratch)
    found = spark.createDataFrame([], LOCATED)
    held: list[tuple[int, str]] = []
    # Written first: an iterator runs a job for each partition, and a written table has few.
    asked = materialise(wanted.select("relative_path").distinct(), f"{scratch}-asked")
    for number, row in enumerate(asked.toLocalIterator()):
        held.append((number, row.relative_path))
        if len(held) == ASKED:
            found, held = found.unionByName(_asked(spark, ask, held)), []
    found = found.unionByName(_asked(spark, ask, held)) if held else found
    copies = list_files(spark, scratch).select("file_path", F.regexp_extract("file_path", "([0-9]+)[.]csv$", 1).cast("bigint").alias("number"))
    unread = F.coalesce("file_path", F.concat(F.lit("empty:"), F.col("relative_path"))).alias("file_path")
    return found.join(copies, "number", "left").select("relative_path", unread, "length")


def _asked(spark: SparkSession, ask, items: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame([x for x in Fo.at_once(ask, items) if x], LOCATED)


def relative_path(file_path: Column, root: str) -> Column:
    """``container/blob`` of a listed file: its decoded path after the bronze root."""
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    return F.regexp_extract(decoded_path(file_path), "^.*?" + _quoted(base) + "/(.*)$", 1)


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def as_glob(path: str) -> str:
    """Escape the characters a path pattern would interpret."""
    return "".join("\\" + ch if ch in "\\*?[]{}," else ch for ch in path)
