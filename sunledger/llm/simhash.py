"""SimHash near-duplicates found with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import IS_SEPARATOR, LOWER, Forest, blocked, cut, group_slices, pieces, utf8, words
from sunledger.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
# Fingerprints of one routing key that meet in one task; larger groups are cut into pairs of chunks.
TREE_SIZE = 4096
SHARD_ROWS = 8192


def _fingerprints(data: np.ndarray, at: np.ndarray, shingle: int) -> np.ndarray:
    data = LOWER[data]
    starts, ends, first = words(data, at)
    sep = IS_SEPARATOR[data]
    keep = ~sep
    keep[:-1] |= sep[:-1] & ~sep[1:]  # one separator before each word
    place = np.cumsum(keep) - 1
    text = np.where(sep, np.uint8(0x20), data)[keep].tobytes()
    counts = np.diff(first)
    n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
    offset = np.concatenate([[0], np.cumsum(n)])
    lead = np.repeat(first[:-1], n) + (np.arange(offset[-1]) - np.repeat(offset[:-1], n))
    last = np.minimum(lead + shingle, np.repeat(first[1:], n)) - 1
    begin, end = place[starts[lead]], place[ends[last] - 1] + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[b:e], 42) for b, e in zip(begin.tolist(), end.tolist())), np.uint64, len(begin)
    )
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(n)
    if len(filled):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, offset[:-1][filled], axis=0, dtype=np.int64)
        packed = np.packbits(ones * 2 > n[filled][:, None], axis=1, bitorder="little")
        out[filled] = packed.view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of each whole text as a signed long; null and blank texts have zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = _fingerprints(*utf8(piece.column("text")), shingle)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


class BKTree:
    """Children hang on edges named by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, last = 0, len(self.value)
        self.value.append(value)
        self.edges.append({})
        while at < last:
            d = (value ^ self.value[at]).bit_count()
            at = self.edges[at].setdefault(d, last)

    def within(self, value: int, radius: int) -> list[int]:
        """All members at a distance of at most ``radius``: only edges within the radius of the distance are followed."""
        found, open_nodes = [], [0] if self.value else []
        while open_nodes:
            at = open_nodes.pop()
            d = (value ^ self.value[at]).bit_count()
            if d <= radius:
                found.append(self.value[at])
            for edge, child in self.edges[at].items():
                if d - radius <= edge <= d + radius:
                    open_nodes.append(child)
        return found


def routing_masks(rows: int, radius: int) -> list[int]:
    """Bit masks such that two fingerprints within ``radius`` agree under at least one of them.

    The 64 bits are cut into blocks; with ``radius`` differing bits at least
    ``blocks - radius`` blocks are equal. The number of blocks follows the
    number of fingerprints so that a key is shared by few of them.
    """
    blocks = radius + 1
    while 64 * (blocks - radius) // blocks < np.log2(max(rows, 1) / 64 + 1) and comb(blocks + 1, radius) <= 1000:
        blocks += 1
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds[:-1], bounds[1:])]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(unique: DataFrame, rows: int, radius: int = MAX_BITS) -> DataFrame:
    """(src, dst): links that connect all fingerprints within ``radius`` bits (every other link follows from them)."""
    masks = routing_masks(rows, radius)
    routed = unique.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("route"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                      for i, m in enumerate(masks)])
        ).alias("r"),
    ).select("fp", "r.route", "r.key")
    dealt = blocked(routed, ["route", "key"], "fp", TREE_SIZE, SHARD_ROWS, rows * len(masks))

    def run(table: pa.Table) -> pa.Table:
        route, key, lo, hi, chunk, fp = (
            table.column(c).to_numpy() for c in ("route", "key", "lo", "hi", "chunk", "fp")
        )
        order, groups = group_slices([route, key, lo, hi])
        fp, chunk, lo, hi = fp.view(np.uint64)[order], chunk[order], lo[order], hi[order]
        joined, out = Forest(), []
        for a, b in groups:
            if b - a < 2:
                continue
            tree, alike = BKTree(), lo[a] == hi[a]
            members = fp[a:b]
            if not alike:
                for x in members[chunk[a:b] == lo[a]].tolist():
                    tree.add(x)
                members = members[chunk[a:b] == hi[a]]
            for x in members.tolist():
                for y in tree.within(x, radius):
                    if joined.join(x, y):
                        out.append((x, y))
                if alike:
                    tree.add(x)
        ends = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"src": pa.array(ends[:, 0]), "dst": pa.array(ends[:, 1])})

    return dealt.groupBy("shard").applyInArrow(run, "src bigint, dst bigint")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Equal fingerprints are one node; nodes are routed to shards by the blocks of
    bits that near fingerprints must share, each shard builds its BK-trees and
    searches them, and distributed components join the links. The shard trees
    meet their queries in the shuffle, not in a driver broadcast: that would
    carry every fingerprint through the driver. component_id is the smallest
    doc_id reachable. Null, empty and blank texts share fingerprint zero;
    repeated rows stay repeated; a row without an id keeps its group's id (null
    if no member has one). An empty table gives no rows.
    """
    marked = cut(fingerprints(docs, shingle), "fingerprints")
    unique = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "unique")
    parts = connected_components(links(unique, unique.count(), radius))
    part = F.coalesce("component", "fp").alias("part")
    nodes = unique.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", part)
    least = nodes.groupBy("part").agg(F.min("first").alias("component_id"))
    nodes = nodes.join(least, "part").select("fp", "component_id")
    return marked.join(nodes, "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, of the document with the smallest id of each group; one row for each id.

    Rows without an id stay, as no group can name them. Of different rows with
    one id that which has the smallest hash over all columns is taken, so reruns
    agree.
    """
    groups = cut(simhash_groups(docs, shingle, radius), "groups")
    key = F.col("doc_id").cast("bigint")
    stays = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("__stays"))
    if not groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        marked = docs.filter("doc_id is not null").withColumn("__mark", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        least = marked.groupBy(F.col("doc_id").alias("__id")).agg(F.min("__mark").alias("__least"))
        named = marked.join(least, (F.col("doc_id") == F.col("__id")) & (F.col("__mark") == F.col("__least")))
        named = named.dropDuplicates(["doc_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
        docs, stays = named.unionByName(docs.filter("doc_id is null")), stays.distinct()
    kept = docs.filter("doc_id is not null").join(stays, key == F.col("__stays"), "left_semi")
    if groups.filter("doc_id is null").isEmpty():
        return kept
    return kept.unionByName(docs.filter("doc_id is null"))
