"""Periodic runs of words, found by block convolution with a number-theoretic transform."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import IS_SEPARATOR, mix, pieces, utf8, word_hashes, words

# A run repeats its period at least EXPONENT times and has at least MIN_WORDS words.
EXPONENT, MIN_WORDS = 4, 6
# Fixed: a prime 15 * 2**27 + 1 and a generator of its group; products of two residues fit 64 bits.
PRIME, GENERATOR = 2013265921, 31
# Words that are transformed together.
AT_ONCE = 1 << 18

_P = np.uint64(PRIME)
_roots: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    known = _roots.get((half, inverse))
    if known is None:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        known = np.ones(1, np.uint64)
        while len(known) < half:
            known = np.concatenate([known, known * np.uint64(pow(root, len(known), PRIME)) % _P])
        if half <= 1 << 16:
            _roots[half, inverse] = known
    return known


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of each row (a power of two long) modulo PRIME, in bit-reversed order."""
    many, size = rows.shape
    half = size // 2
    while half:
        x = rows.reshape(many, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1]
        rows = np.stack([(low + high) % _P, (low + _P - high) * _twiddles(half, False) % _P], axis=2)
        half //= 2
    return rows.reshape(many, size)


def back(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    many, size = rows.shape
    half = 1
    while half < size:
        x = rows.reshape(many, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1] * _twiddles(half, True) % _P
        rows = np.stack([(low + high) % _P, (low + _P - high) % _P], axis=2)
        half *= 2
    return rows.reshape(many, size) * np.uint64(pow(size, -1, PRIME)) % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences modulo PRIME of each block (size B) and its window (2 B - 1) at the shifts 0 to B - 1."""
    many, size = blocks.shape
    turned = np.zeros((many, 2 * size), np.uint64)
    turned[:, -np.arange(size)] = blocks
    padded = np.zeros((many, 2 * size), np.uint64)
    padded[:, : 2 * size - 1] = windows
    product = back(transform(turned) * transform(padded) % _P)[:, :size]
    squares = np.zeros((many, 2 * size), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    over = (squares[:, size:] - squares[:, :size]) % _P
    own = (blocks * blocks % _P).sum(axis=1, dtype=np.uint64) % _P
    return (own[:, None] + over + np.uint64(2) * (_P - product)) % _P


def _ids(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words of one row only; and how far on the word comes next."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, ids = np.unique(hashes ^ mix(row.astype(np.uint64) + np.uint64(1)), return_inverse=True)
    ids = ids.reshape(-1).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    gap = np.full(len(ids), len(ids) + 1)
    same = ids[order][1:] == ids[order][:-1]
    gap[order[:-1][same]] = np.diff(order)[same]
    return ids, gap


def _occurrences(ids: np.ndarray, gap: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, distance) of the aligned blocks of ``size`` words that occur again ``size`` to 2 ``size`` - 1 words on.

    A block with a word that does not come again within that reach has no such
    occurrence and is not transformed.
    """
    blocks = len(ids) // size
    near = (gap[: blocks * size] < 2 * size).reshape(blocks, size).all(axis=1)
    start = np.flatnonzero(near) * size
    padded = np.concatenate([ids, np.full(3 * size, len(ids))]).astype(np.uint64)
    found = []
    step = max(1, AT_ONCE // (2 * size))
    for a in range(0, len(start), step):
        at = start[a : a + step]
        block = padded[at[:, None] + np.arange(size)]
        window = padded[at[:, None] + np.arange(size, 3 * size - 1)]
        hit, shift = np.nonzero(mismatches(block, window) == 0)
        found.append((at[hit], shift + size))
    if not found:
        return start, start
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _same(x: np.ndarray, at: int, d: int, forward: bool) -> int:
    """How many words from ``at`` on (or before it) equal those ``d`` words later."""
    room = len(x) - d - at if forward else at
    done, chunk = 0, 16
    while done < room:
        take = min(chunk, room - done)
        a = at + done if forward else at - done - take
        differ = np.flatnonzero(x[a : a + take] != x[a + d : a + d + take])
        if len(differ):
            return done + (int(differ[0]) if forward else take - 1 - int(differ[-1]))
        done, chunk = done + take, chunk * 4
    return done


def find_runs(hashes: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, least: int = MIN_WORDS) -> np.ndarray:
    """(start, stop, period) of all runs of the rows whose words have these hashes, by start and period.

    A run of period q, 2**k <= q < 2**(k+1), holds an aligned block of 2**k words
    that comes again q and 2 q words on, so the distances of one scale seed all its runs.
    """
    assert exponent >= 4
    if not len(hashes):
        return np.zeros((0, 3), np.int64)
    ids, gap = _ids(hashes, first)
    n, longest = len(ids), int(np.diff(first).max())
    runs: dict[tuple[int, int], int] = {}
    inside, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    size = 1
    while exponent * size <= longest:
        at, d = _occurrences(ids, gap, size)
        fits = at + 2 * d + size <= n
        at, d = at[fits], d[fits]
        again = (ids[at + 2 * d] == ids[at]) & (ids[at + 2 * d + size - 1] == ids[at + size - 1])
        # Inside a known run a multiple of its period says nothing new.
        known = (inside[at] > 0) & (d % np.maximum(inside[at], 1) == 0) & (at + size + d <= ends[at])
        at, d = at[again & ~known], d[again & ~known]
        order = np.lexsort([at, d])
        last, over = 0, 0
        for i, q in zip(at[order].tolist(), d[order].tolist()):
            if q == last and i < over:
                continue
            ahead = _same(ids, i, q, True)
            last, over = q, i + ahead
            if ahead < size:
                continue
            start, stop = i - _same(ids, i, q, False), i + ahead + q
            # Distances ascend, so a stretch is first met with its smallest period.
            if stop - start >= max(least, exponent * q) and (start, stop) not in runs:
                runs[start, stop] = q
                free = inside[start:stop] == 0
                inside[start:stop][free] = q
                ends[start:stop][free] = stop
        size *= 2
    found = np.array([(a, b, q) for (a, b), q in runs.items()], np.int64).reshape(-1, 3)
    return found[np.lexsort([found[:, 2], found[:, 0]])]


def _joined(data: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Per row its kept words, joined by one space."""
    mark = np.zeros(len(data) + 1, np.int32)
    mark[starts[keep]] += 1
    np.subtract.at(mark, ends[keep], 1)
    inside = np.cumsum(mark[:-1]) > 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    before = kept[:-1] - np.repeat(kept[first[:-1]], np.diff(first))
    inside[starts[keep & (before > 0)] - 1] = True
    size = np.concatenate([[0], np.cumsum(inside)])[at].astype(np.int32)
    out = np.where(IS_SEPARATOR[data], np.uint8(0x20), data)[inside]
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(size.tobytes()), pa.py_buffer(out.tobytes())])


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _find(exponent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            data, at = utf8(piece.column("text"))
            starts, ends, first = words(data, at)
            found = find_runs(word_hashes(data, starts, ends), first, exponent, least)
            row = np.searchsorted(first, found[:, 0], "right") - 1
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, found[:, 0] + found[:, 2], 1)
            np.add.at(change, found[:, 1], -1)
            keep = np.cumsum(change[:-1]) == 0
            values = (found[:, 0] - first[row], found[:, 1] - found[:, 0], found[:, 2])
            spans = pa.StructArray.from_arrays([pa.array(v) for v in values], ["start", "length", "period"])
            offsets = np.searchsorted(row, np.arange(len(first))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), spans),
                    _joined(data, at, starts, ends, first, keep),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` lists (start, length, period) of every stretch of words that
    repeats its smallest period at least ``exponent`` (4 or more) times, has at
    least ``least`` words and cannot grow, by start and period; ``collapsed`` is
    the text with the first period of each run alone, words joined by one space.

    At each scale 2**k the text is cut into blocks of 2**k words. A transform
    modulo a prime gives the sums of squared differences between a block and the
    words that follow it at all distances of the scale; zero sums are candidate
    periods, which the words themselves confirm while the stretch is extended
    both ways. Rows are independent: each whole text is one unit of work and the
    cost is n log(n)**2 of its words.

    Null, empty and blank texts have no runs and an empty collapsed text;
    repeated rows and null ids stay; other columns are ignored; an empty table
    gives no rows. Words are compared by 64-bit hashes.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find(exponent, least), f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")


def highest_exponent(runs: str) -> Column:
    """The run with the greatest length / period; ties go to the smallest start, then period. Null without runs."""
    nothing = F.lit(None).cast(RUN)
    return F.reduce(
        runs,
        nothing,
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): about a tenth of the texts repeat a stretch of their words to the end.

    With h the CRC-32 of the id as text, g = h div 10 and n words: if 10 divides
    h, each word i from a = g mod n on is replaced by word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8). Such texts come back with single spaces;
    rows with a null id and all other texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("h div 10")

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        a = F.pmod(F.col("g"), n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(F.col("g"), F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        numbers = F.sequence(F.lit(0), n - 1)
        return F.when(n > 0, F.array_join(F.transform(numbers, lambda i: F.get(ws, place(i))), " ")).otherwise(F.lit(""))

    found = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    # The words are the variable of a lambda, so that they are made once for each text.
    changed = F.transform(F.array(found), repeated)[0]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", h).withColumn("g", g)
    return rows.select("doc_id", F.when(F.pmod("h", F.lit(10)) == 0, changed).otherwise(F.col("text")).alias("text"))
