"""Fuzzy line dedup by MinHash: signatures and set comparisons in numpy and sets, everything else DataFrame operations.

Shingles at every position cost a native plan more CPU than its budget (see the
README), so the two steps that touch every sign run over Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import Forest, blocked, cut, group_slices, mix, pieces
from sunledger.llm.components import connected_components

# A shingle is the SHINGLE signs from any position of a line, blanks included; a shorter line is one shingle.
SHINGLE = 5
MIN_JACCARD = 0.8
# Lines at MIN_JACCARD meet in a band with this probability, of 0.85 with 0.9996.
RECALL = 0.995
# Lines of one band that one task compares; larger bands are cut into pairs of chunks.
CHUNK_LINES, SHARD_LINES = 512, 1024
# Shingles are counted in SLOTS first, the signs of BLOCK_SIGNS at a time.
SLOTS, BLOCK_SIGNS = 1 << 20, 1 << 18
# Lines whose bands are put together before they are shuffled.
COMBINED = 16_384
# Keys that may be sent to every task; beyond that the same join shuffles.
BROADCAST_KEYS = 1_000_000


GAP = re.compile(r"[ \t\r\x0b\x0c]+")


def normal_lines(text: str) -> list[str]:
    """The lines of a text as they are compared: lower-case, trimmed, gaps single blanks; blank ones stay as empty."""
    if any(gap in text for gap in ("  ", "\t", "\r", "\x0b", "\x0c")):
        text = GAP.sub(" ", text)
    return [line.strip(" ") for line in text.lower().split("\n")]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): equal rows are one document, different texts of one id are apart."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, k1, k2) of every line that is not blank; rows without an id are left out."""
    kinds = "doc_id bigint, text_key bigint, line_no int, k1 bigint, k2 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for piece in pieces(batches):
            row, number, one, two = [], [], [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                for k, line in enumerate(normal_lines(text)):
                    if line:
                        raw = line.encode()
                        row.append(i)
                        number.append(k)
                        one.append(digest(raw, 42))
                        two.append(digest(raw, 7))
            at = pa.array(row, pa.int32())
            keys = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(at), piece.column("text_key").take(at), pa.array(number, pa.int32()), *keys],
                ["doc_id", "text_key", "line_no", "k1", "k2"],
            )

    return _rows(docs).mapInArrow(run, kinds)


def banding(lines: int, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): rows grow with the logarithm of the number of lines, so that chance meetings of a line do not."""
    rows = 5 + max(0, ceil(log(max(lines, 1) / 200_000) / log(20)))
    return ceil(log(1 - recall) / log(1 - MIN_JACCARD**rows)), rows


# Multipliers of the polynomial over a shingle's signs.
_SIGNS = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value of every shingle of the lines, and where each line's first one is."""
    filler = chr(0x10FFFF) * (SHINGLE - 1)
    codes = np.frombuffer((filler.join(lines) + filler).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(x) for x in lines])
    many = np.maximum(size - (SHINGLE - 1), 1)
    at = np.concatenate([[0], np.cumsum(size + SHINGLE - 1)])
    starts = np.concatenate([[0], np.cumsum(many)])
    place = np.arange(starts[-1]) + np.repeat(at[:-1] - starts[:-1], many)
    total = codes[place] * _SIGNS[0]
    for k in range(1, SHINGLE):
        total += codes[place + k] * _SIGNS[k]
    return mix(total), starts[:-1]


def shingle_values(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The upper 32 bits of :func:`shingle_hashes`."""
    total, starts = shingle_hashes(lines)
    return (total >> np.uint64(32)).astype(np.uint32), starts


def band_keys(lines: list[str], bands: int, rows: int) -> np.ndarray:
    """(lines, bands): the hash of each band's minima."""
    values, starts = shingle_values(lines)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
    factor = (seeds | np.uint64(1)).astype(np.uint32)
    keys = np.empty((len(lines), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(lines), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = mix(key + np.minimum.reduceat(values * factor[k], starts))
        keys[:, b] = key
    return keys


MEETINGS = "band bigint, lo bigint, member bigint"


def _signed(bands: int, rows: int):
    """(band, lo, member) of the different lines of a task: per band its smallest line (as lo and member) and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        seen: set[int] = set()
        names, keys = [], []

        def combined() -> pa.RecordBatch:
            name = np.repeat(np.concatenate(names), bands)
            band = np.concatenate(keys).ravel().view(np.int64)
            order = np.lexsort((name, band))
            band, name = band[order], name[order]
            new = np.concatenate([[True], band[1:] != band[:-1]])
            lo = name[np.flatnonzero(new)][np.cumsum(new) - 1]
            return pa.RecordBatch.from_arrays([pa.array(band), pa.array(lo), pa.array(name)], ["band", "lo", "member"])

        for piece in pieces(batches, limit=1 << 19):
            new: dict[int, str] = {}
            for text in piece.column("text").to_pylist():
                for line in normal_lines(text):
                    if line and (name := digest(line.encode(), 42)) not in seen:
                        seen.add(name)
                        new[name] = line
            if new:
                names.append(np.array(list(new), np.uint64).view(np.int64))
                keys.append(band_keys(list(new.values()), bands, rows))
            if len(seen) >= COMBINED:
                yield combined()
                seen, names, keys = set(), [], []
        if names:
            yield combined()

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links each band's lines to one of them; rows come sorted by band, lines that already have a partner pass through."""
    last: tuple[int, int] | None = None
    for batch in batches:
        band, lo, member = (batch.column(c).to_numpy() for c in ("band", "lo", "member"))
        own = lo == member
        head, first = band[own], lo[own]
        root = first.copy()
        if len(head):
            new = np.concatenate([[True], head[1:] != head[:-1]])
            at = np.flatnonzero(new)
            if last and last[0] == head[0]:
                root[0] = last[1]
            root = root[at][np.cumsum(new) - 1]
            last = int(head[-1]), int(root[-1])
        apart = root != first
        columns = zip((band[~own], lo[~own], member[~own]), (head[apart], root[apart], first[apart]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["band", "lo", "member"])


def meetings(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, lo, member): the lines of each band of two or more, as links between one line and the others.

    Each task links its own lines first and passes one of them on, so that a
    band with a third of all lines is a row for each task, not for each line.
    """
    signed = _rows(docs).select("text").mapInArrow(_signed(bands, rows), MEETINGS)
    route = F.when(F.col("lo") == F.col("member"), F.col("band")).otherwise(F.col("member"))
    dealt = signed.withColumn("route", route).repartition("route").sortWithinPartitions("band", "lo").drop("route")
    return dealt.mapInArrow(_stars, MEETINGS)


def _small(keys: DataFrame) -> DataFrame:
    """``keys`` with a broadcast hint if their counted number allows it."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k1, line) of the lines with the keys of ``wanted``, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for piece in pieces(batches):
            found: dict[int, str] = {}
            for text in piece.column("text").to_pylist():
                for line in normal_lines(text):
                    if line:
                        found[_long(digest(line.encode(), 42))] = line
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(found.values(), pa.string())], ["k1", "line"])

    each = _rows(docs).select("text").mapInArrow(run, "k1 bigint, line string")
    return each.join(_small(wanted), "k1").groupBy("k1").agg(F.min("line").alias("line"))


def shingles(line: str) -> frozenset[str]:
    return frozenset(line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1)))


def _alike(x: frozenset[str], y: frozenset[str]) -> bool:
    if min(len(x), len(y)) < MIN_JACCARD * max(len(x), len(y)):
        return False
    shared = len(x & y)
    return shared / (len(x) + len(y) - shared) >= MIN_JACCARD


LINKS = "src bigint, dst bigint"


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(src, dst) of the pairs (a, b) whose lines are alike; pairs with one a come together, so its set is made once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, frozenset()
        for batch in batches:
            a, x, y = (batch.column(c).to_pylist() for c in ("a", "x", "y"))
            keep = []
            for name, left, right in zip(a, x, y):
                if name != last:
                    last, own = name, shingles(left)
                keep.append(_alike(own, shingles(right)))
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], ["src", "dst"])

    left = texts.select(F.col("k1").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("k1").alias("b"), F.col("line").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, LINKS)


def slots_of(lines: list[str]) -> list[np.ndarray]:
    """For each line a slot of SLOTS for every different shingle: as many as the line has, so two lines share no more shingles than slots."""
    out, start = [], 0
    total = np.cumsum([len(x) for x in lines])
    while start < len(lines):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + BLOCK_SIGNS, "right")))
        values, at = shingle_hashes(lines[start:stop])
        out += [(np.unique(x) & np.uint64(SLOTS - 1)).astype(np.int32) for x in np.split(values, at[1:])]
        start = stop
    return out


def _near(i: int, others: np.ndarray, slots: list[np.ndarray], size: np.ndarray, mark: np.ndarray) -> list[int]:
    """Those of ``others`` that may be like line ``i`` by the slots they share with it."""
    mark[slots[i]] = 1
    out, step = [], max(1, BLOCK_SIGNS // int(size[others].max()))
    for k in range(0, len(others), step):
        some = others[k : k + step]
        ends = np.cumsum(size[some])
        hit = mark[np.concatenate([slots[j] for j in some])]
        shared = np.add.reduceat(hit, np.concatenate([[0], ends[:-1]]), dtype=np.int32)
        out += some[shared * (1 + MIN_JACCARD) >= MIN_JACCARD * (size[i] + size[some]) - 1e-6].tolist()
    mark[slots[i]] = 0
    return out


def _across(table: pa.Table) -> pa.Table:
    """Links between lines of different components in the bands of one shard.

    Each line meets the longer ones whose sizes allow the wanted index and that
    are still apart from it; shared slots bound the shared shingles from above,
    and the sets of the few that remain are compared.
    """
    band, lo, hi, chunk, k1, part = (table.column(c).to_numpy() for c in ("band", "lo", "hi", "chunk", "k1", "part"))
    line = table.column("line")
    order, groups = group_slices([band, lo, hi])
    joined, out, mark = Forest(), [], np.zeros(SLOTS, np.uint8)
    names, first, place = np.unique(k1, return_index=True, return_inverse=True)
    known = slots_of([line[r].as_py() for r in first.tolist()])
    sizes = np.array([len(x) for x in known])
    for a, b in groups:
        rows = order[a:b]
        rows = rows[np.argsort(sizes[place[rows]], kind="stable")]
        own, size = place[rows], sizes[place[rows]]
        alone, chunks = lo[rows[0]] == hi[rows[0]], chunk[rows]
        old, comp = np.unique(part[rows], return_inverse=True)
        comp = np.unique([joined.find(x) for x in old.tolist()], return_inverse=True)[1][comp]
        slots = [known[x] for x in own]
        last = np.searchsorted(size, size / MIN_JACCARD + 1e-6, "right")
        for i in range(len(rows) - 1):
            apart = comp[i + 1 : last[i]] != comp[i]
            if not alone:
                apart &= chunks[i + 1 : last[i]] != chunks[i]
            others = np.flatnonzero(apart) + i + 1
            if not len(others):
                continue
            mine = None
            for j in _near(i, others, slots, size, mark):
                if comp[j] != comp[i]:
                    mine = mine or shingles(line[rows[i]].as_py())
                    if _alike(mine, shingles(line[rows[j]].as_py())):
                        joined.join(int(part[rows[j]]), int(part[rows[i]]))
                        comp[comp == comp[j]] = comp[i]
                        out.append((names[own[j]], names[own[i]]))
    ends = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"src": pa.array(ends[:, 0]), "dst": pa.array(ends[:, 1])})


def similar_lines(docs: DataFrame, lines: int) -> DataFrame:
    """(node, component) over k1 of the lines that are linked to another line; ``lines`` is about their number.

    The lines of a band are compared with one of them first: pairs in proportion
    to the members. Components of these links come next, and then only lines of
    one band that are still apart are compared, pairs of chunks of a large band
    in tasks of their own. So no link is lost, and a band of thousands of like
    lines does not list its pairs.
    """
    met = cut(meetings(docs, *banding(lines)), "meetings")
    pairs = met.select(F.least("lo", "member").alias("a"), F.greatest("lo", "member").alias("b")).distinct()
    pairs = cut(pairs, "pairs")
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("k1")).distinct(), "wanted")
    texts = cut(_texts(docs, wanted), "texts")
    links = cut(_checked(pairs, texts), "links")
    parts = cut(connected_components(links), "parts")

    members = met.select("band", F.explode(F.array("lo", "member")).alias("k1")).distinct()
    part = F.coalesce("component", "k1").alias("part")
    named = members.join(parts.withColumnRenamed("node", "k1"), "k1", "left").select("band", "k1", part)
    # Two lines alone in a band have met; bands of the same lines are compared once.
    ends = (F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("n"))
    same = (F.bit_xor("k1").alias("x"), F.bit_xor(F.xxhash64("k1")).alias("y"))
    open_ = named.groupBy("band").agg(*ends, *same).filter("p < q and n > 2")
    open_ = open_.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    rest = cut(named.join(open_, "band"), "apart")
    dealt = blocked(rest, ["band"], "k1", CHUNK_LINES, SHARD_LINES, rest.count()).join(texts, "k1")
    more = dealt.groupBy("shard").applyInArrow(_across, LINKS)
    return connected_components(parts.select(F.col("node").alias("src"), F.col("component").alias("dst")).union(more))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, removed): the numbers of the lines that go from each document that loses any."""
    found = cut(lines_of(docs), "lines")
    parts = cut(similar_lines(docs, found.count()), "components")
    named = found.join(parts.withColumnRenamed("node", "k1"), "k1", "left")
    # A line without a like one is named by both its hashes.
    part, other = F.coalesce("component", "k1").alias("part"), F.when(F.col("component").isNull(), F.col("k2")).otherwise(F.lit(0))
    named = named.select("doc_id", "text_key", "line_no", part, other.alias("other"))
    place = F.struct("doc_id", "text_key", "line_no")
    first = named.groupBy("part", "other").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written, so that the rows of a part are spread again for the join.
    first = cut(first, "first")
    gone = named.join(first.drop("n"), ["part", "other"]).filter(place != F.col("first"))
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, and n_lines and n_removed.

    Lines are trimmed, lower-cased and their gaps made single blanks for comparison, and linked if the Jaccard
    index of their character shingles is 0.8 or more. Of each component the
    first line of the smallest doc_id stays, all others go from every document;
    blank lines stay. Null and empty texts and rows without an id are returned
    as they are, n_removed 0. Rows with equal id and text are one document and
    keep the same lines; different texts of one id follow by hash. Other
    columns keep their values; columns named n_lines or n_removed are replaced.
    An empty table gives no rows.
    """
    gone = removed_lines(docs).select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), F.col("removed").alias("__gone"))
    rows = docs.drop("n_lines", "n_removed")
    same = (rows["doc_id"].cast("bigint") == gone["__doc"]) & (F.xxhash64(rows["text"].cast("string")) == gone["__key"])
    joined = rows.join(gone, same, "left")
    parts = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    )
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in rows.columns]
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size(parts)), F.lit(0)).cast("bigint").alias("n_lines")
    return joined.select(*columns, n, F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint").alias("n_removed"))
