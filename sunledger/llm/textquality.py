"""Quality classifier: a generalised additive model with pairwise interactions, boosted cyclically."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import IS_SEPARATOR, LOWER, held_out, pieces, utf8, word_hashes, words

# Bound of the training sample: labelled documents, those with the smallest id hashes.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.1, 1.0

FEATURES = (
    "words", "word_bytes", "letters", "digits", "capitals", "beyond_ascii", "stops", "symbols", "lines", "line_words",
    "distinct_words", "repeated_next", "commonest_word", "capital_words", "digit_words", "symbol_words", "bare_symbols",
    "repeated_lines", "long_words",
)


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_DIGIT = _class("0123456789")
_CAPITAL = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_STOP = _class(".,;:?!")
_SYMBOL = _class("#$%&*|<>=+^~@\\{}[]_!/")


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; shares of an empty text are 0."""
    starts, ends, first = words(data, at)
    sizes, n = np.diff(at), np.diff(first)
    per_byte, per_word = np.maximum(sizes, 1), np.maximum(n, 1)
    row = np.repeat(np.arange(len(n)), n)

    def bytes_in(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[at[1:]] - total[at[:-1]]

    def words_with(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.concatenate([[0], np.cumsum(flag)])
        inside = total[ends] - total[starts]
        return inside, np.bincount(row, inside > 0, len(n))

    letters = bytes_in(_LETTER[data])
    hashes = word_hashes(LOWER[data], starts, ends)
    order = np.lexsort((hashes, row))
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    new = np.flatnonzero(np.concatenate([[True], ~same])) if len(row) else np.zeros(0, int)
    runs = np.diff(np.concatenate([new, [len(row)]]))
    run_row = row[order][new] if len(row) else row
    commonest = np.zeros(len(n))
    np.maximum.at(commonest, run_row, runs)
    adjacent = np.bincount(row[1:], (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1]), len(n)) if len(row) else n * 0.0

    # Lines: between line feeds, blank ones left out.
    broken = np.where(data == 0x0A, np.uint8(0x20), np.where(IS_SEPARATOR[data], np.uint8(0x5F), data))
    l_starts, l_ends, l_first = words(broken, at)
    lines = np.diff(l_first)
    l_row = np.repeat(np.arange(len(n)), lines)
    l_hash = word_hashes(data, l_starts, l_ends)
    l_order = np.lexsort((l_hash, l_row))
    l_same = (l_hash[l_order][1:] == l_hash[l_order][:-1]) & (l_row[l_order][1:] == l_row[l_order][:-1])
    repeated_lines = np.bincount(l_row[l_order][1:], l_same, len(n)) if len(l_row) else n * 0.0

    length = ends - starts
    _, with_digit = words_with(_DIGIT[data])
    symbols, with_symbol = words_with(_SYMBOL[data])
    capitals, _ = words_with(_CAPITAL[data])
    return np.stack(
        [
            np.log1p(n),
            np.bincount(row, length, len(n)) / per_word,
            letters / per_byte,
            bytes_in(_DIGIT[data]) / per_byte,
            bytes_in(_CAPITAL[data]) / np.maximum(letters, 1),
            bytes_in(data >= 128) / per_byte,
            bytes_in(_STOP[data]) / per_word,
            bytes_in(_SYMBOL[data]) / per_byte,
            np.log1p(lines),
            n / np.maximum(lines, 1),
            np.bincount(run_row, minlength=len(n)) / per_word,
            adjacent / per_word,
            commonest / per_word,
            np.bincount(row, (capitals > 1) & (capitals * 2 > length), len(n)) / per_word,
            with_digit / per_word,
            with_symbol / per_word,
            np.bincount(row, symbols == length, len(n)) / per_word,
            repeated_lines / np.maximum(lines, 1),
            np.bincount(row, length > 20, len(n)) / per_word,
        ],
        axis=1,
    )


@dataclass
class Additive:
    """Lookup tables: the score of a row is the sum of one entry of each table."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (j, k), table in self.pairs.items():
            out += table[coarse[j], coarse[k]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(gain.argmax())
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Step values over a row of bins: a tree of ``depth`` levels of cuts."""
    _, at = _split(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree over a grid: one cut on one axis, then one cut of each half on the other."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(a)):
            gain, value = -g.sum() ** 2 / (h.sum() + RIDGE), np.empty_like(a)
            for part in (slice(0, at), slice(at, None)):
                gs, hs = a[part].sum(0), b[part].sum(0)
                step = _tree(gs, hs, 1)
                value[part] = step
                gain += float((2 * step * gs - step**2 * hs).sum() - RIDGE * sum(s**2 for s in set(step.tolist())))
            if gain > best[0]:
                best = gain, value.T if turned else value
    return best


def boost(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fits tables by rounds over all features in turn, then over the pairs with the largest gain on what is left."""

    def quantiles(n: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(x[:, j], np.arange(1, n) / n)) for j in range(x.shape[1])]

    rate = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(rate / (1 - rate))), quantiles(BINS), [], quantiles(PAIR_BINS))
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    f = np.full(len(y), model.bias)
    for _ in range(ROUNDS):
        for j, (b, table) in enumerate(zip(bins, model.tables)):
            p = 1 / (1 + np.exp(-f))
            step = RATE * _tree(np.bincount(b, y - p, len(table)), np.bincount(b, p * (1 - p), len(table)), 2)
            table += step
            f += step[b]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(j: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        cell = coarse[j] * sizes[k] + coarse[k]
        shape = (sizes[j], sizes[k])
        total = sizes[j] * sizes[k]
        return cell, np.bincount(cell, y - p, total).reshape(shape), np.bincount(cell, p * (1 - p), total).reshape(shape)

    gains = [(_pair_tree(*grid(j, k)[1:])[0], j, k) for j in range(x.shape[1]) for k in range(j)]
    model.pairs = {(j, k): np.zeros((sizes[j], sizes[k])) for gain, j, k in sorted(gains, reverse=True)[:PAIRS] if gain > 0}
    for _ in range(PAIR_ROUNDS):
        for (j, k), table in model.pairs.items():
            cell, g, h = grid(j, k)
            step = RATE * _pair_tree(g, h)[1]
            table += step
            f += step.ravel()[cell]
    return model


def _featured(docs: DataFrame, extra: str = "") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x = features(*utf8(piece.column("text")))
            rest = [c for c in piece.schema.names if c != "text"]
            listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), listed], [*rest, "x"])

    return docs.mapInArrow(run, f"doc_id bigint, {extra} x array<double>")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Additive | None:
    """A model from at most ``rows`` labelled documents; a document labelled twice counts once (its larger label)."""
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sample = _featured(text.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y"), "y int,")
    found = sample.orderBy("doc_id", "y").toPandas()
    return boost(np.stack(found["x"].to_list()), found["y"].to_numpy(float)) if len(found) else None


def score(docs: DataFrame, model: Additive | None) -> DataFrame:
    """(doc_id, score) of every whole text; null and empty texts have the features of an empty text, no model gives 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x = features(*utf8(piece.column("text")))
            found = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted): learns labels outside the fold only, scores all documents from text alone.

    Rows that repeat a document are each scored; labels without a document are
    ignored; empty tables give no rows.
    """
    model = fit(docs, labels.filter(~held_out("doc_id", folds, fold)).filter("doc_id is not null"))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
