"""Substring dedup: winnowed anchors as seeds, extension both ways, maximal repeats over a length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import (
    WORD_BASE, cut, group_slices, pieces, span_hashes, utf8, window_starts, word_hashes, words,
)

WINDOW_WORDS = 50
# Words of a seed. Every window holds the least of its seeds, so equal windows share that anchor.
SEED_WORDS = 16
# A second, independent base: a window is named by 128 bits.
SECOND_BASE = 0xA0761D6478BD642F


class _Text:
    """Words of the rows of one piece, with their hashes."""

    def __init__(self, piece: pa.RecordBatch) -> None:
        self.data, at = utf8(piece.column("text"))
        self.starts, self.ends, self.first = words(self.data, at)
        self.hashes = word_hashes(self.data, self.starts, self.ends)

    def anchors(self, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows' first words, the anchor (word index) of each, and the hashes of all seeds."""
        begin = window_starts(self.first, window)
        if not len(begin):
            return begin, begin, np.zeros(0, np.uint64)
        at = np.arange(len(self.hashes) - seed + 1)
        seeds = span_hashes(self.hashes, at, at + seed, WORD_BASE)
        reach = window - seed + 1
        # The last of the least seeds of each window; seeds over a row's end lie in no chosen window.
        least = np.lib.stride_tricks.sliding_window_view(seeds, reach)[:, ::-1]
        anchor = np.empty(len(begin), np.int64)
        for part in range(0, len(begin), 1 << 15):
            b = begin[part : part + (1 << 15)]
            anchor[part : part + len(b)] = b + reach - 1 - least[b].argmin(axis=1)
        return begin, anchor, seeds

    def spans(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (span_hashes(self.hashes, start, stop, b).view(np.int64) for b in (WORD_BASE, SECOND_BASE))

    def kept(self, row: int, keep: np.ndarray) -> str:
        """The digest of the kept words of a row, joined by one space; ``keep`` covers the row's words."""
        chosen = np.flatnonzero(keep) + self.first[row]
        raw = self.data[self.starts[self.first[row]] : self.ends[self.first[row + 1] - 1]] if len(chosen) else b""
        if not len(chosen):
            return hashlib.sha256(b"").hexdigest()
        base = self.starts[self.first[row]]
        # One byte of gap stays before each kept word but the first.
        mark = np.zeros(len(raw) + 1, np.int32)
        np.add.at(mark, np.maximum(self.starts[chosen] - base - 1, 0), 1)
        np.add.at(mark, self.ends[chosen] - base, -1)
        inside = np.cumsum(mark[:-1]) > 0
        inside[: self.starts[chosen[0]] - base] = False
        out = raw[inside].copy()
        out[np.isin(out, (0x09, 0x0A, 0x0B, 0x0C, 0x0D))] = 0x20
        return hashlib.sha256(out.tobytes()).hexdigest()


def _profile(window: int, seed: int):
    """Per document its word count, the digest of all words, and its distinct anchors with their positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text = _Text(piece)
            _, anchor, seeds = text.anchors(window, seed)
            anchor = np.unique(anchor)
            cuts = np.searchsorted(anchor, text.first).astype(np.int32)
            local = anchor - np.repeat(text.first[:-1], np.diff(cuts))
            counts = np.diff(text.first)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(counts),
                    pa.array([text.kept(i, np.ones(n, bool)) for i, n in enumerate(counts)], pa.string()),
                    pa.ListArray.from_arrays(cuts, pa.array(seeds[anchor].view(np.int64) if len(anchor) else anchor)),
                    pa.ListArray.from_arrays(cuts, pa.array(local)),
                ],
                ["doc_id", "n_words", "kept_sha256", "anchors", "places"],
            )

    return run


def _lists(column: pa.Array, fields: int) -> list[np.ndarray]:
    """One (n, fields) array per row of a column that packs tuples into flat lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b].reshape(-1, fields) for a, b in zip(at[:-1], at[1:])]


def _once(row: np.ndarray, one: np.ndarray, two: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Equal spans of one row as one entry with the list of their ranges; also where each entry's first span was."""
    order, groups = group_slices([row, one, two])
    lead = order[[a for a, _ in groups]]
    at = np.array([2 * a for a, _ in groups] + [2 * len(order)], np.int32)
    flat = np.stack([lo[order], hi[order]], axis=1).ravel().astype(np.int32)
    return row[lead], one[lead], two[lead], pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), lead


def _contexts(window: int, seed: int):
    """Per shared anchor of a document: the first words of its windows and the hash of all the words they reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text = _Text(piece)
            begin, anchor, seeds = text.anchors(window, seed)
            if not len(begin):
                continue
            new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            lo, hi, at = begin[new], begin[np.concatenate([new[1:], [len(begin)]]) - 1], anchor[new]
            row = np.searchsorted(text.first, at, "right") - 1
            shared = np.zeros(len(text.hashes), bool)
            for i, places in enumerate(_lists(piece.column("places"), 1)):
                shared[places[:, 0] + text.first[i]] = True
            lo, hi, at, row = (x[shared[at]] for x in (lo, hi, at, row))
            one, two = text.spans(lo, hi + window)
            two = two ^ ((at - lo) << 32 | (hi - at + window))
            row, one, two, ranges, lead = _once(row, one, two, lo - text.first[row], hi - text.first[row])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(row)), pa.array(seeds[at[lead]].view(np.int64))]
                + [pa.array(one), pa.array(two), ranges],
                ["doc_id", "anchor", "one", "two", "ranges"],
            )

    return run


def _windows(window: int):
    """Every window of the listed ranges, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text = _Text(piece)
            start, row = [], []
            for i, ranges in enumerate(_lists(piece.column("ranges"), 2)):
                at = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in ranges.tolist()]))
                start.append(at + text.first[i])
                row.append(np.full(len(at), i))
            start, row = np.concatenate(start), np.concatenate(row)
            one, two = text.spans(start, start + window)
            place = start - text.first[row]
            row, one, two, ranges, _ = _once(row, one, two, place, place)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(row)), pa.array(one), pa.array(two), ranges],
                ["doc_id", "one", "two", "ranges"],
            )

    return run


def _removed(window: int):
    """What is left of each document without the words under the listed windows; ``repeats`` are the maximal ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text = _Text(piece)
            out = []
            for i, ranges in enumerate(_lists(piece.column("ranges"), 2)):
                n = int(text.first[i + 1] - text.first[i])
                mark = np.zeros(n + 1, np.int64)
                np.add.at(mark, ranges[:, 0], 1)
                np.add.at(mark, ranges[:, 1] + window, -1)
                keep = np.cumsum(mark[:-1]) == 0
                edge = np.flatnonzero(np.diff(np.concatenate([[1], keep.astype(np.int8), [1]])))
                out.append((int(n - keep.sum()), text.kept(i, keep), edge.tolist()))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id")]
                + [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.list_(pa.int64())))],
                ["doc_id", "n_removed", "left_sha256", "repeats"],
            )

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, repeats) for every row of ``docs``.

    A word goes if a window of ``window`` words over it also starts in a
    document with a smaller doc_id. ``repeats`` lists start and end word of the
    maximal removed passages in turn.

    Seed: every window has an anchor, the least of its ``seed``-word hashes;
    documents meet on anchors that two of them hold. Extend: a shared anchor
    grows both ways over all windows that chose it. Equal extensions match as a
    whole, against the smallest document that has them; of extensions that
    differ, the smallest document's copy is compared window by window. No pair
    of documents is listed, so an anchor in every document costs a row each.
    Windows are named by 128-bit hashes.

    Null, empty and blank texts have no words; texts of fewer words than a
    window lose nothing; rows without an id or that repeat one (its smallest
    text is taken) count as one document, rows without an id are dropped. An
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("doc_id is not null")
    kinds = "doc_id bigint, n_words bigint, kept_sha256 string, anchors array<bigint>, places array<bigint>"
    profile = cut(rows.mapInArrow(_profile(window, seed), kinds), "profile")
    if not profile.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = cut(rows.groupBy("doc_id").agg(F.min("text").alias("text")), "single")
        profile = cut(rows.mapInArrow(_profile(window, seed), kinds), "profile")
    ends = (F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    seeds = profile.select("doc_id", F.explode(F.arrays_zip("anchors", "places")).alias("a"))
    seeds = seeds.select("doc_id", F.col("a.anchors").alias("anchor"), F.col("a.places").alias("place"))
    shared = cut(seeds.groupBy("anchor").agg(*ends).filter("least < most").select("anchor"), "anchors")
    places = seeds.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    texts = cut(rows.join(places, "doc_id"), "texts")

    kinds = "doc_id bigint, anchor bigint, one bigint, two bigint, ranges array<int>"
    reach = cut(texts.mapInArrow(_contexts(window, seed), kinds), "reach")
    least = reach.groupBy("one", "two").agg(F.min("doc_id").alias("least"))
    graded = reach.join(least, ["one", "two"]).select(
        "doc_id", "anchor", "ranges", (F.col("doc_id") > F.col("least")).alias("equal")
    )
    graded = cut(graded, "graded")

    apart = graded.filter("not equal")
    open_ = apart.groupBy("anchor").agg(*ends).filter("least < most").select("anchor")
    ranges = F.flatten(F.collect_list("ranges")).alias("ranges")
    todo = apart.join(open_, "anchor").groupBy("doc_id").agg(ranges)
    text = texts.select("doc_id", "text")
    single = text.join(todo, "doc_id").mapInArrow(_windows(window), "doc_id bigint, one bigint, two bigint, ranges array<int>")
    single = cut(single, "windows")
    least = single.groupBy("one", "two").agg(*ends).filter("least < most").select("one", "two", "least")
    single = single.join(least, ["one", "two"]).filter("doc_id > least").select("doc_id", "ranges")

    covered = graded.filter("equal").select("doc_id", "ranges").union(single).groupBy("doc_id").agg(ranges)
    removed = text.join(covered, "doc_id").mapInArrow(
        _removed(window), "doc_id bigint, n_removed bigint, left_sha256 string, repeats array<bigint>"
    )
    return profile.join(removed, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"),
        F.coalesce("repeats", F.array().cast("array<bigint>")).alias("repeats"),
    )
