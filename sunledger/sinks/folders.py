"""Folders of any file system Spark can reach: delete, move, and the names inside."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import SparkSession

from sunledger.session import BARE_LOCAL, LOCAL_SYSTEM

# File-system calls that run at the same time.
CALLS = 16


def at_once(function: Callable, items: Iterable, threads: int = CALLS) -> list:
    """``function`` of every item, a bounded number at a time; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(function, x) for x in items]]


@lru_cache(maxsize=64)
def java_class(context: SparkContext, name: str):
    """A class of the JVM, looked up once: each part of its name is a call."""
    found = context._jvm
    for part in name.split("."):
        found = getattr(found, part)
    return found


def _path(spark: SparkSession, path: str):
    return java_class(spark.sparkContext, "org.apache.hadoop.fs.Path")(path)


@lru_cache(maxsize=64)
def _system(context: SparkContext, authority: str):
    """The file system of all paths that begin with ``authority``, a scheme and host or nothing."""
    root = java_class(context, "org.apache.hadoop.fs.Path")(f"{authority}/")
    conf = java_class(context, "org.apache.hadoop.conf.Configuration")(context._jsc.hadoopConfiguration())
    if not conf.get(LOCAL_SYSTEM):
        for key, value in BARE_LOCAL.items():
            conf.set(key, value)
    return root.getFileSystem(conf)


def at(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    authority = re.match("([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?", path)[0]
    return _system(spark.sparkContext, authority), _path(spark, path)


@lru_cache(maxsize=64)
def _is_local(context: SparkContext, authority: str) -> bool:
    named = authority.partition(":")[0] in ("", "file")
    return named and _system(context, authority).getClass().getName() == BARE_LOCAL[LOCAL_SYSTEM]


def local(spark: SparkSession, path: str) -> str | None:
    """The path for this machine's own file calls; none if another file system holds it.

    Where its native library is absent, Hadoop starts a process for every new
    file and folder, so very many are made without it.
    """
    authority = re.match("([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?", path)[0]
    return path[len(authority) :] if _is_local(spark.sparkContext, authority) else None


def _renamed(source: str | None, target: str | None) -> bool:
    """Whether a rename by this machine's own call has succeeded; the file system is asked for any other."""
    if source is None or target is None:
        return False
    try:
        os.rename(source, target)
    except OSError:
        return False
    return True


def exists(spark: SparkSession, path: str) -> bool:
    here = local(spark, path)
    if here is not None:
        return os.path.exists(here)
    system, where = at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file; one that is not there is fine."""
    system, where = at(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within one file system; the target's parents are made."""
    here, there = local(spark, source), local(spark, target)
    if there is not None:
        os.makedirs(os.path.dirname(there), exist_ok=True)
    if _renamed(here, there):
        return
    system, where = at(spark, source)
    to = _path(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


def make(spark: SparkSession, path: str) -> None:
    """A folder and its parents; one that is there is fine."""
    system, where = at(spark, path)
    system.mkdirs(where)


def retire(spark: SparkSession, target: str, aside: str, source: str | None) -> bool:
    """Move ``target`` to ``aside``, whose parent exists, and ``source`` to where it was; false if there is no target."""
    here = local(spark, target)
    system, where = at(spark, target)
    if not (system.exists(where) if here is None else os.path.exists(here)):
        return False
    if not _renamed(here, local(spark, aside)) and not system.rename(where, _path(spark, aside)):
        raise OSError(f"cannot move {target} to {aside}")
    if source is not None and not _renamed(local(spark, source), here) and not system.rename(_path(spark, source), where):
        raise OSError(f"cannot move {source} to {target}")
    return True


def names(spark: SparkSession, path: str) -> set[str]:
    """Names of all that lies directly below ``path``, brought over in one text however many there are."""
    system, where = at(spark, path)
    if not system.exists(where):
        return set()
    context = spark.sparkContext
    paths = java_class(context, "org.apache.hadoop.fs.FileUtil").stat2Paths(system.listStatus(where))
    # Java's lists are made of arrays of objects, not of paths.
    objects = context._gateway.new_array(java_class(context, "java.lang.Object"), len(paths))
    java_class(context, "java.lang.System").arraycopy(paths, 0, objects, 0, len(paths))
    listed = java_class(context, "java.util.Arrays").asList(objects)
    text = java_class(context, "org.apache.hadoop.util.StringUtils").join("\0", listed)
    return {p.rsplit("/", 1)[-1] for p in text.split("\0") if p}


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern names anything that exists."""
    system, where = at(spark, pattern)
    found = system.globStatus(where)
    return found is not None and len(found) > 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none when it does not exist."""
    system, where = at(spark, path)
    if not system.exists(where):
        return []
    return [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """The folder name that Spark's writers give a partition value."""
    utils = java_class(spark.sparkContext, "org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils")
    return f"{column}={utils.escapePathName(value)}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with exactly this name and content; it replaces an older one."""
    here = local(spark, path)
    if here is not None:
        folder, name = os.path.split(here)
        os.makedirs(folder, exist_ok=True)
        with open(here, "wb") as out:
            out.write(text.encode())
        if os.path.exists(f"{folder}/.{name}.crc"):  # the checksum of an older one
            os.remove(f"{folder}/.{name}.crc")
        return
    system, where = at(spark, path)
    out = system.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
