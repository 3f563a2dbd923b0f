"""Toxicity: noisy-channel deobfuscation under a character language model, then a score of the restored text."""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import BYTE_BASE, BYTE_VALUES, LOWER, cut, held_out, pieces, span_hashes, utf8, words

# Bounds of the training sample: labelled documents of each class, those with the smallest id hashes.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
# A word or stem is evidence if it explains so many toxic documents, and is toxic in this share of its documents
# (of all labelled ones: the sample's classes are weighed back).
MIN_DOCUMENTS, MIN_PRECISION, COVER = 3, 0.3, 12
STEMS = (4, 5, 6, 7, 8)
# A feature that occurs again in a document is evidence of its own, up to so many times.
TIMES = 3
STEPS, RATE, RIDGE = 400, 0.1, 0.2
RUN_LETTERS, RUN_WORDS = 3, 3
# Fixed: what a sign may stand for, besides itself; the empty text means that it was put in.
SIGNS = {
    "0": ("o",), "1": ("i", "l"), "2": ("z",), "3": ("e",), "4": ("a",), "5": ("s",), "6": ("g", "b"), "7": ("t",),
    "8": ("b",), "9": ("g",), "@": ("a",), "$": ("s",), "!": ("i",), "|": ("i", "l"), "+": ("t",), "(": ("c",),
    "*": ("", "a", "e", "i", "o", "u"), ".": ("", " "), "-": ("", " "), "_": ("", " "), "/": ("", " "), "'": ("", " "),
}
# The gap between words of one sign each: nothing, or a word's end.
GAP = " "
# Log costs of the channel: a sign for a letter, a sign put in, a letter written once more, a sign or such a gap as a word's end.
LEET, PUT_IN, REPEATED, BREAK, GAP_BREAK = -1.0, -1.0, -0.5, -1.5, -0.5
# Log costs of a sign at a word's edge that is no part of it: where it is plain punctuation, and elsewhere.
PUNCTUATION, DROPPED = -0.5, -4.0
BEFORE, AFTER = "(", "!"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ALNUM = _LETTER.copy()
_ALNUM[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS]] = True
# Signs, digits left out, that may stand for a letter: the others say nothing at a word's edge.
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c, out in SIGNS.items() if not c.isdigit() and set(out) - {"", " "}]] = True
# Symbols of the language model: 0 a word's edge, 1-26 letters, 27 any other byte.
_SYMBOL = np.full(256, 27)
_SYMBOL[97:123] = np.arange(1, 27)
SYMBOLS = 28


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, from the plain words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for piece in pieces(batches):
            data, at = utf8(piece.column("text"))
            edge = np.zeros(len(data) + 1, bool)
            edge[at] = True
            symbol = np.where(_LETTER[data], _SYMBOL[LOWER[data]], 0)
            # Two edges stand between words, so that every word starts afresh.
            symbol = np.repeat(symbol, np.where(symbol == 0, 2, 1) + edge[:-1])
            if len(symbol) > 2:
                total += np.bincount((symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:], minlength=SYMBOLS**3)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "code bigint, n bigint")
    total = np.full(SYMBOLS**3, 0.1)
    for r in counts.groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most SYMBOLS**3 rows
        total[r.code] += r.n
    table = total.reshape(SYMBOLS * SYMBOLS, SYMBOLS)
    return np.log(table / table.sum(axis=1, keepdims=True))


def restore(token: str, model: list[list[float]], known: dict[str, str]) -> str:
    """The likeliest plain text of a token: Viterbi over the lattice of what each sign may stand for.

    A state is the last two symbols, so paths that agree on them share their
    future; the channel costs and the language model add up along a path.
    Signs before the first and after the last letter or digit may also be no
    part of the word; in a token of signs only they all are.
    """
    if token in known:
        return known[token]
    paths: dict[tuple, tuple[float, str]] = {(0, 0): (0.0, "")}
    token_lower = token.lower()
    solid = [i for i, c in enumerate(token_lower) if c.isalnum() or c > "\x7f"]
    head, tail = (solid[0], solid[-1]) if solid else (0, len(token_lower))
    for place, c in enumerate(token_lower):
        itself = "" if c == GAP or (c in SIGNS and not c.isdigit()) else c
        options = [("", 0.0), (" ", GAP_BREAK)] if c == GAP else [(itself, 0.0)] if itself else []
        for out in SIGNS.get(c, ()):
            options.append((out, PUT_IN if out == "" else BREAK if out == " " else LEET))
        if (place < head or place > tail) and c != GAP:
            if c not in SIGNS:
                options = [("", 0.0)]
            elif "" not in SIGNS[c]:
                options.append(("", PUNCTUATION if c in (BEFORE if place < head else AFTER) else DROPPED))
        if not options:
            options = [(" ", BREAK)]
        after: dict[tuple, tuple[float, str]] = {}
        for (a, b), (score, text) in paths.items():
            for out, cost in options:
                if out == "":
                    step = [((a, b), score + cost, text)]
                elif out == " ":
                    step = [((0, 0), score + cost + model[a * SYMBOLS + b][0], text + " ")]
                else:
                    k = ord(out) - 96 if "a" <= out <= "z" else 27
                    step = [((b, k), score + cost + model[a * SYMBOLS + b][k], text + out)]
                    if text and text[-1] == out:
                        step.append(((a, b), score + cost + REPEATED, text))
                for state, value, made in step:
                    if state not in after or after[state][0] < value:
                        after[state] = (value, made)
        paths = after
    best = max(paths.items(), key=lambda p: (p[1][0] + model[p[0][0] * SYMBOLS + p[0][1]][0], p[1][1]))
    if len(known) < 200_000:  # a memory of what was decoded, no limit of what is
        known[token] = best[1][1]
    return best[1][1]


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the signs around them that stand for no letter."""
    if not len(starts):
        return starts, ends
    place, kept = np.arange(len(data)), _ALNUM[data] | _LEET[data]
    after = np.minimum.accumulate(np.where(kept, place, len(data))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(kept, place, -1))
    begin, end = after[starts], before[ends - 1] + 1
    return begin, np.maximum(end, begin)


def tokens(data: np.ndarray, at: np.ndarray, model: list[list[float]], known: dict[str, str]):
    """Plain words as spans of the lower-cased bytes and restored ones as texts: (bytes, starts, ends, row) twice."""
    lower = LOWER[data]
    starts, ends, first = words(lower, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    begin, end = _trimmed(lower, starts, ends)
    held = begin < np.minimum(end, ends)
    begin, end, row = begin[held], end[held], row[held]
    if not len(begin):
        empty = np.zeros(0, np.int64)
        return (lower, empty, empty, empty), (np.zeros(0, np.uint8), empty, empty, empty)

    def inside(flag: np.ndarray, b: np.ndarray, e: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[np.maximum(e, b)] - total[b]

    same = np.zeros(len(lower), bool)
    same[2:] = _LETTER[lower[2:]] & (lower[2:] == lower[1:-1]) & (lower[1:-1] == lower[:-2])
    noisy = (inside(_SIGN[lower], begin, end) > 0) & (inside(_LETTER[lower], begin, end) > 0)
    noisy |= (inside(_LEET[lower], begin, end) > 0) & (end - begin > 1)
    noisy |= inside(same, np.minimum(begin + 2, end), end) > 0
    # Letters with gaps between them: runs of words of one sign each, however many bytes it has.
    single = inside((lower & 0xC0) != 0x80, begin, end) == 1
    change = np.flatnonzero(np.concatenate([[True], (single[1:] != single[:-1]) | (row[1:] != row[:-1]), [True]]))
    raw = lower.tobytes()
    made: list[tuple[int, str]] = []
    spaced = np.zeros(len(begin), bool)
    for a, b in zip(change[:-1].tolist(), change[1:].tolist()):
        if single[a] and b - a >= RUN_WORDS:
            spaced[a:b] = True
            made.append((int(row[a]), GAP.join(raw[x:y].decode("utf-8", "ignore") for x, y in zip(begin[a:b], end[a:b]))))
    at_noisy = np.flatnonzero(noisy & ~spaced)
    made += [
        (r, raw[b:e].decode("utf-8", "ignore"))
        for r, b, e in zip(row[at_noisy].tolist(), begin[at_noisy].tolist(), end[at_noisy].tolist())
    ]
    plain = ~noisy & ~spaced
    out, out_row = [], []
    for r, token in made:
        for word in restore(token, model, known).split():
            out.append(word.encode())
            out_row.append(r)
    size = np.cumsum([len(w) for w in out], dtype=np.int64) if out else np.zeros(0, np.int64)
    text = np.frombuffer(b"".join(out), np.uint8)
    lead = np.concatenate([[0], size[:-1]]).astype(np.int64) if out else size
    return (lower, begin[plain], end[plain], row[plain]), (text, lead, size, np.array(out_row, np.int64))


def evidence(data: np.ndarray, at: np.ndarray, model: list[list[float]], known: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every restored word and stem, as hashes; repeats included."""
    rows, found = [], []
    for text, starts, ends, row in tokens(data, at, model, known):
        values = BYTE_VALUES[text]
        rows.append(row)
        found.append(span_hashes(values, starts, ends, BYTE_BASE))
        for n in STEMS:
            long = ends - starts > n
            rows.append(row[long])
            found.append(span_hashes(values, starts[long], starts[long] + n, BYTE_BASE) ^ np.uint64(n))
    return np.concatenate(rows), np.concatenate(found)


def repeated(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a row once, and once more under another name for the second and third time it occurs."""
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    if not len(row):
        return row, feature
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])]))
    nth = np.arange(len(row)) - np.repeat(new, np.diff(np.concatenate([new, [len(row)]])))
    first = nth < TIMES
    return row[first], feature[first] ^ (nth[first].astype(np.uint64) << np.uint64(56))


@dataclass
class Lexicon:
    """Features with their weights in a logistic score."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _logistic(row: np.ndarray, column: np.ndarray, columns: int, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse 0/1 features; ``share`` weighs the rows."""
    w = np.zeros(columns + 1)
    w[-1] = np.log((y @ share + 1) / ((1 - y) @ share + 1))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[column], len(y)) + w[-1]
        d = (1 / (1 + np.exp(-z)) - y) * share
        g = np.concatenate([np.bincount(column, d[row], columns) + RIDGE * w[:-1], [d.sum()]])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def _covering(toxic: dict[int, set[int]], clean: dict[int, int]) -> list[int]:
    """Features chosen one by one: always the one that explains most toxic documents with fewer than COVER chosen ones.

    Words that occur only beside others in copies of a few documents find these explained.
    """
    heap = [(-len(docs) + clean.get(f, 0), f) for f, docs in toxic.items()]
    heapq.heapify(heap)
    explained: Counter = Counter()
    chosen = []
    while heap:
        _, f = heapq.heappop(heap)
        gain = sum(explained[d] < COVER for d in toxic[f])
        if gain < MIN_DOCUMENTS:
            continue
        rank = -gain + clean.get(f, 0)
        if heap and rank > heap[0][0]:
            heapq.heappush(heap, (rank, f))
            continue
        if gain >= MIN_PRECISION * (gain + clean.get(f, 0)):
            chosen.append(f)
            explained.update(toxic[f])
    return chosen


def fit(docs: DataFrame, labels: DataFrame, model: list[list[float]], label: str = "toxic") -> Lexicon:
    """A lexicon from a bounded sample of labelled documents; equal texts count once."""
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    turn = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = marked.filter("y = 1").orderBy(*turn).limit(SAMPLE_TOXIC)
    picked = picked.unionAll(marked.filter("y = 0").orderBy(*turn).limit(SAMPLE_CLEAN))
    text = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sample = text.join(F.broadcast(picked), "doc_id").groupBy(F.xxhash64("text").alias("k")).agg(
        F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.max("y").alias("y")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for piece in pieces(batches):
            row, feature = evidence(*utf8(piece.column("text")), model, known)
            row, feature = repeated(row, feature)
            feature = feature.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(c).take(pa.array(row)) for c in ("doc_id", "y")] + [pa.array(feature)],
                ["doc_id", "y", "feature"],
            )

    held = cut(sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id bigint, y int, feature bigint"), "evidence")
    rows = held.select("doc_id", "y").distinct().orderBy("doc_id").toArrow()
    ids, y = rows.column("doc_id").to_numpy(), rows.column("y").to_numpy().astype(float)
    there = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    # The sample's classes weigh as much as all labelled documents of theirs.
    toxic_weight, clean_weight = there.get(1, 0) / max(y.sum(), 1), there.get(0, 0) / max((1 - y).sum(), 1)
    share = np.where(y == 1, toxic_weight, clean_weight)
    share /= max(share.mean(), 1e-9) if len(share) else 1
    clean_weight /= toxic_weight or 1
    counts = held.groupBy("feature").agg(F.sum("y").alias("a"), (F.sum(1 - F.col("y")) * F.lit(float(clean_weight))).alias("b"))
    counts = counts.filter(F.col("a") >= MIN_DOCUMENTS).filter(F.col("a") >= MIN_PRECISION * (F.col("a") + F.col("b")))
    toxic, clean = defaultdict(set), {}
    found = held.filter("y = 1").join(counts, "feature").select("feature", "doc_id", "b").toArrow()
    for feature, doc, b in zip(*(found.column(c).to_pylist() for c in ("feature", "doc_id", "b"))):
        toxic[feature].add(doc)
        clean[feature] = b
    chosen = sorted(_covering(toxic, clean))
    use = held.sparkSession.createDataFrame([(i, f) for i, f in enumerate(chosen)], "place int, feature bigint")
    entries = held.join(F.broadcast(use), "feature").select("doc_id", "place").toArrow()
    row = np.searchsorted(ids, entries.column("doc_id").to_numpy())
    column = entries.column("place").to_numpy().astype(np.int64)
    weights, bias = _logistic(row, column, len(chosen), y, share)
    return Lexicon(np.array(chosen, np.int64).view(np.uint64), weights, bias)


def score(docs: DataFrame, model: list[list[float]], lexicon: Lexicon) -> DataFrame:
    """(doc_id, score) of every whole text: the logistic score of its evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, str] = {}
        order = np.argsort(lexicon.features)
        known, weights = lexicon.features[order], lexicon.weights[order]
        low = np.uint64((1 << 16) - 1)
        maybe = np.zeros(1 << 16, bool)
        maybe[(known & low).astype(np.int64)] = True
        for piece in pieces(batches):
            row, feature = evidence(*utf8(piece.column("text")), model, memory)
            odds = np.full(piece.num_rows, lexicon.bias)
            likely = np.flatnonzero(maybe[(feature & low).astype(np.int64)])
            if len(likely) and len(known):
                row, feature = repeated(row[likely], feature[likely])
                at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
                hit = known[at] == feature
                np.add.at(odds, row[hit], weights[at[hit]])
            chance = 1 / (1 + np.exp(-odds))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(chance)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): learns labels outside the fold only, scores all documents from text alone.

    Tokens with signs inside, letters written three times or more and letters
    with gaps between them are decoded; other words are their own reading. Null
    and empty texts have no evidence and get the base score; rows that repeat a
    document are each scored; labels without a document are ignored.
    """
    model = language_model(docs).tolist()
    learned = labels.filter(~held_out("doc_id", folds, fold)).filter("doc_id is not null")
    scored = score(docs, model, fit(docs, learned, model))
    return scored.select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
