"""Benchmark decontamination by templates with typed placeholders and slot consistency."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import (
    IS_SEPARATOR, WORD_BASE, map_rows, pieces, span_hashes, utf8, window_starts, word_hashes, words,
)

WINDOW_WORDS = 5
MIN_SIMILARITY = 0.8
# Words of benchmark text that one pass over the documents carries to the tasks.
BLOCK_WORDS = 1_000_000
# Fixed: names and signs of units that stand for one placeholder.
UNITS = """
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres
kilometer kilometers mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l litre
litres liter liters gallon gallons s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month
months year years percent dollar dollars euro euros cent cents usd eur gbp degree degrees watt watts volt volts kb mb gb
""".split()

# Literal words that a window needs to be looked up; windows of placeholders alone are everywhere in tables of numbers.
LITERAL_WORDS = 2
# Fixed: words that are no names though they open sentences. The list alone decides, never other items or documents.
COMMON = """
a about after all also an and another any are as at be because before both but by can could did do does during each
either every few find first for from had has have he her here his how however i if in into is it its last later let many
more most much my next no not now of on once one only or other our over she should since so some still such than that the
their then there these they this those though to under until up was we were what when where which while who whose why
will with would yes yesterday you your
""".split()

# Punctuation takes no part in a template; everything beyond ASCII counts as a letter.
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_ENDS = np.zeros(256, bool)
_ENDS[[0x0A, ord("."), ord("!"), ord("?"), ord(":")]] = True
NUMBER, NAME, UNIT = (np.uint64(v) for v in (0x6E756D626572, 0x6E616D65, 0x756E6974))


def _hash_of(text: str) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


class Template:
    """The template words of the rows of one piece: hashes with placeholders, and the hash behind each.

    Names are capitals inside a sentence in ``kind`` and ``word``; in the view of ``named`` they are
    capitals anywhere, but for common words.
    """

    def __init__(self, column: pa.Array) -> None:
        data, at = utf8(column)
        keep = _IN_WORD[data] | IS_SEPARATOR[data]
        place = np.concatenate([[0], np.cumsum(keep)])
        raw, at = data[keep], place[at]
        self.starts, self.ends, self.first = words(raw, at)
        # Lower-casing may change a letter's bytes, but not the number of words.
        small, there = utf8(pc.utf8_lower(column))
        held = _IN_WORD[small] | IS_SEPARATOR[small]
        small, there = small[held], np.concatenate([[0], np.cumsum(held)])[there]
        self.value = word_hashes(small, *words(small, there)[:2])
        ends = np.concatenate([[0], np.cumsum(_ENDS[data])])[np.flatnonzero(keep)[self.starts]] if len(raw) else self.starts
        opening = np.ones(len(self.starts), bool)
        opening[1:] = ends[1:] != ends[:-1]
        opening[self.first[:-1][self.first[:-1] < len(opening)]] = True
        digits = np.concatenate([[0], np.cumsum(_IS_DIGIT[raw])])
        number = digits[self.ends] > digits[self.starts]
        lead = raw[self.starts]
        follow = raw[np.minimum(self.starts + 1, max(len(raw) - 1, 0))] if len(raw) else lead
        # An upper-case letter of ASCII, or of Latin-1 in two bytes; the first word of a sentence is no name.
        upper = _IS_UPPER[lead] | ((lead == 0xC3) & (follow >= 0x80) & (follow <= 0x9E))
        self.upper, self.number = upper & ~number, number
        self.kind, self.word = self._slots(self.upper & ~opening)

    def _slots(self, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = np.isin(self.value, _UNIT_HASHES) & ~name & ~self.number
        kind = np.select([self.number, name, unit], [1, 2, 3], 0)
        return kind, np.choose(kind, [self.value, NUMBER, NAME, UNIT])

    def views(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(kind, word) of each reading: names inside sentences, names anywhere, and the plain words without slots."""
        named = self._slots(self.upper & ~np.isin(self.value, _NO_NAMES))
        return [(self.kind, self.word), named, (np.zeros(len(self.value), np.int64), self.value)]


def _literal(kind: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Which windows have enough words that are no placeholders."""
    plain = np.concatenate([[0], np.cumsum(kind == 0)])
    return plain[start + window] - plain[start] >= min(LITERAL_WORDS, window)


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))
_NO_NAMES = np.sort(np.array([_hash_of(u) for u in [*COMMON, *UNITS]], np.uint64))


def slots_agree(pairs: list[tuple[int, int, int]], least: float) -> bool:
    """Whether one renaming explains the slots: pairs of (kind, value in the item, value in the document).

    Each item value must stand for one document value throughout and the other
    way round; ``least`` is the share of slots that the commonest renaming of
    each value explains.
    """
    if not pairs:
        return True
    votes = Counter(pairs)
    there: dict = {}
    back: dict = {}
    for (kind, a, b), n in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        if (kind, a) not in there and (kind, b) not in back:
            there[kind, a], back[kind, b] = (b, n), a
    return sum(n for _, n in there.values()) >= least * len(pairs)


class _Reading:
    """One reading of the items of a block: their windows by hash, and those too bare to look up."""

    def __init__(self, kind: np.ndarray, word: np.ndarray, first: np.ndarray, window: int) -> None:
        self.kind, self.word, self.first = kind, word, first
        start = window_starts(first, window)
        row = np.searchsorted(first, start, "right") - 1
        literal = _literal(kind, start, window)
        hashes = span_hashes(word, start, start + window, WORD_BASE)
        # A window that an item repeats counts once, at its first place.
        at, item, value = start[literal], row[literal], hashes[literal]
        order = np.lexsort((at, value, item))
        new = np.ones(len(order), bool)
        new[1:] = (item[order][1:] != item[order][:-1]) | (value[order][1:] != value[order][:-1])
        keep = order[new]
        keep = keep[np.argsort(value[keep], kind="stable")]
        self.hashes, self.starts, self.rows = value[keep], at[keep], item[keep]
        items = len(first) - 1
        self.bare = [start[~literal & (row == i)] for i in range(items)] if (~literal).any() else [start[:0]] * items
        self.sizes = np.bincount(self.rows, minlength=items) + np.array([len(b) for b in self.bare], np.int64)
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, kind: np.ndarray, word: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
        """(row, item, word of the text, word of the item) of every window that a text shares with an item, in order."""
        begin = window_starts(first, window)
        begin = begin[_literal(kind, begin, window)]
        found = span_hashes(word, begin, begin + window, WORD_BASE)
        maybe = self.known[(found & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at, found = begin[maybe], found[maybe]
        lo, hi = np.searchsorted(self.hashes, found, "left"), np.searchsorted(self.hashes, found, "right")
        many = hi - lo
        hit = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        doc, item, q = np.searchsorted(first, at, "right") - 1, self.rows[hit], self.starts[hit]
        order = np.lexsort((at, item, doc))
        return doc[order], item[order], at[order], q[order]


def _found(items: list[tuple[int, str]], window: int, least: float):
    """A function that lists (row, item number, similarity) of the items of one block in the texts of a column."""
    bench = Template(pa.array([t for _, t in items], pa.string()))
    readings = [_Reading(kind, word, bench.first, window) for kind, word in bench.views()]

    def search(column: pa.Array) -> list[tuple[int, int, float]]:
        text, out = Template(column), []
        for reading, (kind, word) in zip(readings, text.views()):
            doc, item, at, q = reading.hits(kind, word, text.first, window)
            if not len(at):
                continue
            new = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
            edges = np.flatnonzero(np.concatenate([[True], new, [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                i, d = int(item[a]), int(doc[a])
                if b - a + len(reading.bare[i]) < least * reading.sizes[i]:
                    continue
                best = _best(at[a:b], q[a:b], reading, i, window, bench.value, text, word, d, least)
                if best >= least:
                    out.append((d, i, best))
        return out

    return search


def _matches(items: list[tuple[int, str]], window: int, least: float):
    """Finds the items of one block in documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _found(items, window, least)
        for piece in pieces(batches):
            out = search(piece.column("text"))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array([d for d, _, _ in out]))]
                    + [pa.array([items[i][0] for _, i, _ in out], pa.int64()), pa.array([s for _, _, s in out], pa.float64())],
                    ["doc_id", "item_id", "similarity"],
                )

    return run


def _without(items: list[tuple[int, str]], window: int, least: float):
    """Passes on the rows whose text holds no item of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _found(items, window, least)
        for piece in pieces(batches):
            keep = np.ones(piece.num_rows, bool)
            keep[[d for d, _, _ in search(piece.column("text"))]] = False
            yield piece.filter(pa.array(keep))

    return run


def _best(
    at: np.ndarray, q: np.ndarray, reading: _Reading, item: int, window: int,
    bench: np.ndarray, text: Template, word: np.ndarray, doc: int, least: float,
) -> float:
    """The largest share of an item's windows that lie within a stretch of its length (and a quarter more), slots agreeing.

    Windows too bare to look up count where they stand on the stretch's diagonal.
    """
    size, bare, kinds = int(reading.sizes[item]), reading.bare[item], reading.kind
    lo, hi = int(text.first[doc]), int(text.first[doc + 1])
    reach, best, b = size + size // 4, 0.0, 0
    seen: Counter = Counter()
    for a in range(len(at)):
        while b < len(at) and at[b] < at[a] + reach:
            seen[int(q[b])] += 1
            b += 1
        if len(seen) + len(bare) >= least * size and len(seen) + len(bare) > best * size:
            # One place of the document for each window of the item: the one nearest to the stretch's diagonal.
            shift = int(np.median(at[a:b] - q[a:b]))
            near = sorted(range(a, b), key=lambda k: abs(int(at[k] - q[k]) - shift))
            place: dict[int, int] = {}
            for k in near:
                place.setdefault(int(q[k]), int(at[k]))
            fits = bare[(bare + shift >= lo) & (bare + shift + window <= hi)]
            for start in fits.tolist():
                if (reading.word[start : start + window] == word[start + shift : start + shift + window]).all():
                    place[start] = start + shift
            share = len(place) / size
            pairs = {
                (int(kinds[i + d]), int(bench[i + d]), int(text.value[p + d]), i + d)
                for i, p in place.items()
                for d in range(window)
                if kinds[i + d]
            }
            if share >= least and share > best and slots_agree([x[:3] for x in pairs], least):
                best = share
                if best == 1.0:
                    return best
        first = int(q[a])
        seen[first] -= 1
        if not seen[first]:
            del seen[first]
    return best


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block`` words."""
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").filter("text is not null").orderBy("item_id", "text")
    held: list[tuple[int, str]] = []
    total = 0
    for r in items.toLocalIterator():
        held.append((r.item_id, r.text))
        total += r.text.count(" ") + 1
        if total >= block:
            yield held
            held, total = [], 0
    if held:
        yield held


def without_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, least: float = MIN_SIMILARITY, block: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; see ``contaminated``.

    Each row is judged by its own text, so rows with a null or repeated id are
    treated like all others. Null, empty and blank texts stay.
    """
    for items in _blocks(benchmark, block):
        docs = map_rows(docs, _without(items, window, least))
    return docs


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, least: float = MIN_SIMILARITY, block: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, item_id, similarity): the benchmark items that a document holds, verbatim or with other slot values.

    Texts become templates: words without punctuation, lower-cased, with
    placeholders for numbers, names and units. Names are read in two ways, as capitals inside a sentence
    and as capitals anywhere but for common words; the plain words are a third reading, so that a
    copy is found whatever its case and punctuation, and the best reading counts.
    Windows of ``window`` template words meet by hash; an item is found where at
    least ``least`` of its windows lie in one stretch of the document and one
    renaming of slot values explains at least that share of the slots.

    The benchmark is the stated query set: it is read in blocks of ``block``
    words, each block goes to the tasks in one pass over all documents, so what
    is sent is bounded whatever its size; an item is found or not whatever else
    is in its block. Windows of fewer than LITERAL_WORDS words besides placeholders are not looked up
    but compared where the others place the item. Null, empty and blank texts and items
    of fewer words than a window match nothing; rows that repeat a document are
    judged each, rows that repeat an item id give its best similarity once.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    kinds = "doc_id bigint, item_id bigint, similarity double"
    found = spark.createDataFrame([], kinds)
    for items in _blocks(benchmark, block):
        found = found.union(rows.mapInArrow(_matches(items, window, least), kinds))
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))
