"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import held_out, map_rows, pieces, utf8

HIDDEN = 8
# Bytes that the network reads in one run; a text is a sequence of such stretches, all of them read.
STRETCH = 128
# Bounds of the training sample: documents of each language, fewer if all together would be more than
# SAMPLE_ALL but LEAST_DOCS at least, and stretches of a document. Every language is learned.
SAMPLE_DOCS, LEAST_DOCS, SAMPLE_ALL, SAMPLE_STRETCHES = 200, 20, 12_800, 10
EPOCHS, BATCH, RATE = 3, 128, 0.012
UNDETERMINED = "und"
# A text is in a language if its best one has more than an equal share by this part of the rest.
MARGIN = 1 / 15


@dataclass
class Network:
    """Two gated recurrent layers, one for each direction, and a label for every byte.

    ``inputs`` [2, 256, 3H] adds up what a byte contributes to the update
    gate, the reset gate and the candidate; ``state`` [2, H, 3H] what the state
    contributes. Gates are hard sigmoids and candidates hard tangents.
    """

    labels: list[str]
    inputs: np.ndarray
    state: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def forward(self, x: np.ndarray, side: int, keep: list | None = None) -> np.ndarray:
        """States [T, B, H] over the bytes ``x`` [T, B], read from the first one; ``keep`` collects what training needs."""
        n, h = x.shape[1], self.state.shape[1]
        gates_in = np.ascontiguousarray(self.inputs[side][:, : 2 * h])
        cand_in = np.ascontiguousarray(self.inputs[side][:, 2 * h :])
        gates_w = np.ascontiguousarray(self.state[side][:, : 2 * h])
        cand_w = np.ascontiguousarray(self.state[side][:, 2 * h :])
        now = np.zeros((n, h), np.float32)
        states = np.empty((len(x), n, h), np.float32)
        g, gw = np.empty((n, 2 * h), np.float32), np.empty((n, 2 * h), np.float32)
        c, cw, reset = (np.empty((n, h), np.float32) for _ in range(3))
        for t, bytes_ in enumerate(x):
            np.take(gates_in, bytes_, axis=0, out=g, mode="clip")
            np.dot(now, gates_w, out=gw)
            g += gw
            np.maximum(g, 0, out=g)
            np.minimum(g, 1, out=g)
            np.multiply(g[:, h:], now, out=reset)
            np.take(cand_in, bytes_, axis=0, out=c, mode="clip")
            np.dot(reset, cand_w, out=cw)
            c += cw
            np.maximum(c, -1, out=c)
            np.minimum(c, 1, out=c)
            if keep is not None:
                keep.append((now.copy(), g.copy(), c.copy(), reset.copy()))
            now -= c
            now *= g[:, :h]
            now += c
            states[t] = now
        return states

    def positions(self, x: np.ndarray, keep: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States of both directions and label probabilities for every byte of ``x`` [T, B]."""
        there = self.forward(x, 0, keep and keep[0])
        back = self.forward(x[::-1], 1, keep and keep[1])[::-1]
        h = there.shape[2]
        scores = there @ self.out[:h]
        scores += back @ self.out[h:]
        scores += self.bias
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return np.concatenate([there, back], axis=2) if keep else there, scores


def _backward(net: Network, side: int, x: np.ndarray, keep: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction's ``inputs`` and ``state`` by backpropagation through time."""
    h = net.state.shape[1]
    w = net.state[side]
    d_in, d_w = np.zeros_like(net.inputs[side]), np.zeros_like(w)
    d_now = np.zeros((x.shape[1], h), np.float32)
    for t in range(len(x) - 1, -1, -1):
        before, g, c, reset = keep[t]
        d_now = d_now + d_states[t]
        z, r = g[:, :h], g[:, h:]
        d_c = d_now * (1 - z) * (np.abs(c) < 1)
        d_z = d_now * (before - c) * ((z > 0) & (z < 1))
        d_reset = d_c @ w[:, 2 * h :].T
        d_r = d_reset * before * ((r > 0) & (r < 1))
        d_gates = np.concatenate([d_z, d_r], axis=1)
        d_w[:, : 2 * h] += before.T @ d_gates
        d_w[:, 2 * h :] += reset.T @ d_c
        np.add.at(d_in, x[t], np.concatenate([d_gates, d_c], axis=1))
        d_now = d_now * z + d_reset * r + d_gates @ w[:, : 2 * h].T
    return d_in, d_w


def train(stretches: np.ndarray, target: np.ndarray, labels: list[str], seed: int = 1) -> Network:
    """Fits a network to byte stretches [N, T] with one label each, every position counting alike."""
    rng = np.random.default_rng(seed)
    n_labels = len(labels)
    inputs = rng.normal(0, 0.3, (2, 256, 3 * HIDDEN)).astype(np.float32)
    inputs[:, :, : 2 * HIDDEN] += 0.5  # gates start half open
    net = Network(
        labels,
        inputs,
        rng.normal(0, 0.3, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (2 * HIDDEN, n_labels)).astype(np.float32),
        np.zeros(n_labels, np.float32),
    )
    names = ("inputs", "state", "out", "bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    steps, total = 0, EPOCHS * -(-len(stretches) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(stretches))
        for part in range(0, len(order), BATCH):
            at = order[part : part + BATCH]
            x = np.ascontiguousarray(stretches[at].T).astype(np.intp)
            keep: tuple = ([], [])
            states, p = net.positions(x, keep)
            d = p
            d[:, np.arange(len(at)), target[at]] -= 1
            d /= d.shape[0] * d.shape[1]
            d_states = d @ net.out.T
            grads = {
                "out": np.tensordot(states, d, axes=([0, 1], [0, 1])),
                "bias": d.sum(axis=(0, 1)),
            }
            there = _backward(net, 0, x, keep[0], d_states[:, :, :HIDDEN])
            back = _backward(net, 1, x[::-1], keep[1], d_states[::-1, :, HIDDEN:])
            grads["inputs"], grads["state"] = (np.stack(pair) for pair in zip(there, back))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            steps += 1
            rate = RATE * (1 - 0.9 * steps / total)
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def stretch(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into rows of STRETCH bytes (the last one filled with zeros), with text number and length."""
    sizes = np.diff(at)
    count = -(-sizes // STRETCH)
    row = np.repeat(np.arange(len(sizes)), count)
    start = at[row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRETCH
    length = np.minimum(STRETCH, at[row + 1] - start)
    padded = np.concatenate([data, np.zeros(STRETCH, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, STRETCH)[start].copy() if len(row) else np.zeros((0, STRETCH), np.uint8)
    x[np.arange(STRETCH) >= length[:, None]] = 0
    return x, row, length


def pooled(net: Network, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Label probabilities of each text [N, labels]: the mean over its bytes (zeros for an empty text)."""
    x, row, length = stretch(data, at)
    out = np.zeros((len(at) - 1, len(net.labels)))
    for part in range(0, len(x), 4096):
        block = np.ascontiguousarray(x[part : part + 4096].T).astype(np.intp)
        _, p = net.positions(block)
        size = length[part : part + 4096]
        if size.min() < STRETCH:
            p *= (np.arange(STRETCH)[:, None] < size)[:, :, None]
        np.add.at(out, row[part : part + 4096], p.sum(axis=0))
    return out / np.maximum(np.diff(at), 1)[:, None]


def fit(docs: DataFrame, seed: int = 1) -> Network | None:
    """A network from a bounded sample: of every language SAMPLE_DOCS documents or fewer
    (those with the smallest id hashes) and SAMPLE_STRETCHES evenly spaced stretches of each. None without labels."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.trim("text") != ""))
    labels = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not labels:
        return None
    many = max(LEAST_DOCS, min(SAMPLE_DOCS, SAMPLE_ALL // len(labels)))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "doc_id"))
    marked = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("turn"))
    picked = marked.withColumn("k", turn).filter(F.col("k") <= many).select("doc_id", "lang").distinct()
    ids = [r.doc_id for r in picked.collect()]
    rows = known.filter(F.col("doc_id").isin(ids))
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_STRETCHES - 1)),
        lambda k: F.substring(
            "text",
            (F.floor(k * F.greatest(F.length("text") - STRETCH, F.lit(0)) / F.lit(SAMPLE_STRETCHES)) + 1).cast("int"),
            F.lit(STRETCH),
        ),
    )
    sample = rows.select("doc_id", "lang", F.array_distinct(spread).alias("texts")).orderBy("doc_id", "lang").collect()
    raw, target = [], []
    for r in sample:
        for t in r.texts:
            piece = t.encode()[:STRETCH]
            raw.append(np.frombuffer(piece.ljust(STRETCH, b"\0"), np.uint8))
            target.append(labels.index(r.lang))
    return train(np.array(raw), np.array(target), labels, seed)


def _labelled(net: Network | None, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Label and score of each text."""
    letters = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
    if net is None:
        return pa.array([UNDETERMINED] * len(letters), pa.string()), np.zeros(len(letters))
    p = pooled(net, *utf8(text))
    names = [net.labels[b] if k else UNDETERMINED for b, k in zip(p.argmax(axis=1).tolist(), letters.tolist())]
    return pa.array(names, pa.string()), np.where(letters, np.clip(p.max(axis=1), 0, 1), 0.0)


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text).

    The network labels every byte of the whole text; the mean probabilities
    decide and give the score. Null texts and texts without a letter are
    ``und`` with score 0, as is everything without a trained network. Very long
    texts are read in stretches like all others; repeated rows stay repeated.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            names, score = _labelled(net, piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), names, pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def least_score(labels: int, margin: float = MARGIN) -> float:
    """The score from which a text counts as being in a language: above chance, whatever the number of labels."""
    return 1 / labels + margin * (1 - 1 / labels) - 1e-6


def in_some_language(docs: DataFrame, net: Network | None, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not ``und``, and a score of ``least_score`` or more."""
    least = least_score(len(net.labels), margin) if net else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            names, score = _labelled(net, piece.column("text"))
            yield piece.filter(pc.and_(pc.not_equal(names, UNDETERMINED), pa.array(score >= least)))

    return map_rows(docs, run)


def languages(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns from documents outside the fold, predicts all from text alone."""
    held = held_out("doc_id", folds, fold)
    net = fit(docs.select("doc_id", "text", "lang").filter(~held))
    return identify(docs, net).select("doc_id", held.alias("held_out"), "lang_pred", "score")
