"""Shared parts: written tables, Arrow text as numpy arrays, word and window hashes, bounded groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.session import materialise, work_dir

# Fixed: the separators of words, in the sense of [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multipliers of the two polynomial hashes; odd numbers have inverses modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps re-read it instead of computing it again."""
    return materialise(df, work_dir(df.sparkSession, purpose))


def map_rows(docs: DataFrame, function) -> DataFrame:
    """``mapInArrow`` that keeps the columns, whatever their names; ``function`` sees ``text`` under its name."""
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    return plain.mapInArrow(function, plain.schema).toDF(*docs.columns)


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold`` (null ids: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each row; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of text; one row is never divided."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (and one more)."""
    inside = ~IS_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``base`` and of its inverse, modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        known = tuple(
            np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, b, np.uint64))])
            for b in (base, pow(base, -1, 1 << 64))
        )
        if size <= 1 << 21:
            _powers[base] = known
    return known[0][:n], known[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[start:end] for many spans: differences of prefix sums, shifted to power zero."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


# One pseudorandom 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(WORD_BASE))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(BYTE_VALUES[data], starts, ends, BYTE_BASE)


def window_starts(first_word: np.ndarray, length: int) -> np.ndarray:
    """Every word index at which ``length`` words of one row begin."""
    n = int(first_word[-1])
    if n < length:
        return np.zeros(0, np.int64)
    room = np.repeat(first_word[1:], np.diff(first_word)) - np.arange(n)
    return np.flatnonzero(room >= length)


def blocked(df: DataFrame, keys: list[str], row: str, limit: int, per_shard: int, rows: int) -> DataFrame:
    """Deals groups of rows with equal ``keys`` into shards of bounded size.

    A group of more than ``limit`` rows is cut into chunks and every pair of
    chunks becomes a task of its own: columns ``lo`` and ``hi`` name the pair,
    ``chunk`` the row's own chunk. Rows of one pair meet in one ``shard``; a
    shard holds about ``per_shard`` rows of many groups. ``rows`` is the number
    of rows of ``df``.
    """
    large = (
        df.groupBy(keys)
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > limit)
        .select(*keys, F.ceil(F.col("members") / limit).cast("int").alias("chunks"))
    )
    chunks = F.coalesce("chunks", F.lit(1))
    shards = max(1, -(-rows // per_shard))
    return (
        df.join(large, keys, "left")
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(7), row), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("lo", F.least("chunk", "other"))
        .withColumn("hi", F.greatest("chunk", "other"))
        .drop("chunks", "other")
        .withColumn("shard", F.pmod(F.xxhash64(*keys, "lo", "hi"), F.lit(shards)))
    )


def group_slices(columns: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """An order that brings equal rows of ``columns`` together, and the bounds of each run in it."""
    order = np.lexsort(columns[::-1])
    if not len(order):
        return order, []
    new = np.zeros(len(order), bool)
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    bounds = np.concatenate([[0], np.flatnonzero(new), [len(order)]])
    return order, list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))


class Forest:
    """Union-find over the members of one task."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, a, b) -> bool:
        """Whether this link connects two parts that were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
