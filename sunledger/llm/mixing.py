"""Mixing sources to target weights: token blocks, multinomial shards, pseudorandom index permutations."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import cut, mix, pieces, utf8, words

BLOCK_WORDS = 512
SHARD_SLOTS = 4096
# The driver draws for so many groups of shards at most; tasks draw the shards of a group.
SHARD_GROUPS = 1024
MAX_REPEATS = 3
WEIGHTS = (5, 2, 1)
# Documents of one source that are numbered in one task.
RUN_DOCS = 4096


def target_sizes(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of the total by weight; what exceeds ``most`` times a source's size goes to the others by weight.

    A source at its limit leaves the sharing, and the rest is shared anew
    until no target is above its limit.
    """
    limits = [Fraction(most) * s for s in sizes]
    wanted = [Fraction(w) for w in weights]
    target, open_ = [Fraction(0)] * len(sizes), set(range(len(sizes)))
    left = Fraction(sum(sizes))
    while open_:
        total = sum(wanted[i] for i in open_)
        share = {i: left * wanted[i] / total if total else Fraction(0) for i in open_}
        over = [i for i in open_ if share[i] > limits[i]]
        for i in over or open_:
            target[i] = min(share[i], limits[i])
        if not over:
            break
        left -= sum(limits[i] for i in over)
        open_ -= set(over)
    return [float(t) for t in target]


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1, evaluated at ``index``: a Feistel network on the next power of four,
    repeated while the value lies outside. ``n`` and ``key`` may differ from place to place."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    x, open_ = index.astype(np.uint64), np.ones(len(index), bool)
    while open_.any():
        a, b, m, h, k = x[open_] >> half[open_], x[open_] & low[open_], low[open_], half[open_], key[open_]
        for turn in range(4):
            a, b = b, a ^ (mix(b + (k + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)) & m)
        x[open_] = (a << h) | b
        open_ = x >= n.astype(np.uint64)
    return x.astype(np.int64)


def shard_counts(slots: list[int], per_shard: int, seed: int) -> np.ndarray:
    """For each shard the number of slots of each source: multinomial draws, given that the totals are met.

    A shard's draw given what is left is multivariate hypergeometric; that is
    the law of independent multinomial shards conditioned on the quotas.
    """
    left, out = np.array(slots, np.int64), []
    rng = np.random.default_rng(seed)
    while left.sum() > per_shard:
        out.append(_hypergeometric(rng, left, per_shard))
        left = left - out[-1]
    out.append(left)
    return np.array(out)


def _hypergeometric(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    drawn, rest, want = np.zeros_like(left), int(left.sum()), n
    for i, k in enumerate(left.tolist()):
        rest -= k
        if want == 0:
            break
        if k + rest < 10**9:
            drawn[i] = rng.hypergeometric(k, rest, want) if rest else want
        else:  # beyond the generator's range a shard is a vanishing part of what is left
            drawn[i] = min(k, max(want - rest, rng.binomial(want, k / (k + rest))))
        want -= int(drawn[i])
    return drawn


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of every text, null and blank ones 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            first = words(*utf8(piece.column("text")))[2]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("source"), pa.array(np.diff(first))], ["doc_id", "source", "size"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), "text")
    return rows.mapInArrow(run, "doc_id bigint, source string, size bigint")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS, most: int = MAX_REPEATS, seed: int = 5
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): how many words the mix takes of every document.

    The words of a source, its documents one after the other, are packed into
    blocks of ``block`` words (the last one may be shorter). Output shards draw
    multinomial numbers of slots for each source given the sources' quotas; a
    source's slots go in order through its blocks, each turn under another
    pseudorandom permutation of the block numbers, and meet the blocks by
    number. The last slots of a source are cut so that its taken words equal
    its rounded target; so a document gets ``most`` times its size at most.
    Sources in code-point order, null last, have the weights in turn. Null,
    empty and blank texts have size 0 and take 0; rows that repeat an id are
    documents of their own; an empty table gives no rows. Reruns on equal rows
    agree.
    """
    sized = cut(document_sizes(docs), "sizes")
    per = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    per = sorted(per, key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    spark = docs.sparkSession
    if not per:
        return sized.select("*", F.lit(0).cast("bigint").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("bigint").alias("taken"))
    sizes = [r["size"] for r in per]
    targets = target_sizes(sizes, [weights[i % len(weights)] for i in range(len(per))], most)
    quota = [min(round(t), most * s) for t, s in zip(targets, sizes)]
    blocks = [-(-s // block) for s in sizes]
    # Whole turns through a source take every block; what is left is met by the first blocks of one more turn.
    turns = [q // s if s else 0 for q, s in zip(quota, sizes)]
    rest = [q - t * s for q, t, s in zip(quota, turns, sizes)]
    slots = [t * b + min(b, -(-r // block) + 1) * (r > 0) for t, b, r in zip(turns, blocks, rest)]
    plan = spark.createDataFrame(
        [(i, r.source, s, float(t), b, q) for i, (r, s, t, b, q) in enumerate(zip(per, sizes, targets, blocks, quota))],
        "number int, source string, source_size bigint, target double, blocks bigint, quota bigint",
    )

    # Each document's place among the words of its source: sums of runs, then inside a run.
    runs = max(1, -(-max(r.docs for r in per) // RUN_DOCS))
    placed = sized.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)))
    sums = placed.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "run", F.coalesce(F.sum("run_size").over(before), F.lit(0)).alias("run_start"))
    inside = Window.partitionBy("source", "run").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = placed.source.eqNullSafe(sums.source) & (placed.run == sums.run)
    placed = placed.join(sums, same).select(
        "doc_id", placed.source, "size", (F.col("start") + F.col("run_start")).alias("start")
    )
    placed = placed.join(plan, placed.source.eqNullSafe(plan.source)).select(
        "doc_id", placed.source, "size", "source_size", "target", "number", "start", F.col("quota")
    )

    taken = block_use(spark, slots, blocks, sizes, quota, block, seed)
    whole = F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))
    parts = placed.filter("size > 0").select("doc_id", "number", "start", "size", whole.alias("block"))
    # A block's words are used ``full`` times, its first ``head`` words once more.
    lo, hi = F.greatest("start", F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    more = F.greatest(F.lit(0), F.least(hi, F.col("block") * block + F.col("head")) - lo)
    used = (
        parts.join(taken, ["number", "block"])
        .select("number", "start", ((hi - lo) * F.col("full") + more).alias("n"))
        .groupBy("number", "start")
        .agg(F.sum("n").alias("taken"))
    )
    result = placed.filter("size > 0").join(used, ["number", "start"], "left").unionByName(
        placed.filter("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    )
    return result.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def block_use(spark, slots: list[int], blocks: list[int], sizes: list[int], quota: list[int], block: int, seed: int) -> DataFrame:
    """(number, block, full, head): how often the slots of all shards use a block, and how far the cut slot goes."""
    shards = max(1, -(-sum(slots) // SHARD_SLOTS))
    per_group = -(-shards // min(shards, SHARD_GROUPS)) * SHARD_SLOTS
    counts = shard_counts(slots, per_group, seed)
    starts = np.cumsum(counts, axis=0) - counts
    drawn = spark.createDataFrame(
        [(k, first.tolist(), n.tolist()) for k, (first, n) in enumerate(zip(starts, counts))],
        "part int, first array<bigint>, n array<bigint>",
    ).repartition(F.col("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, many in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "n"))):
                for k, shard in enumerate(shard_counts(many, SHARD_SLOTS, seed + 1 + part)):
                    for number, n in enumerate(shard.tolist()):
                        if not n:
                            continue
                        slot = np.arange(first[number], first[number] + n)
                        first[number] += n
                        turn = slot // blocks[number]
                        key = mix((turn * len(blocks) + number + 1).astype(np.uint64) + np.uint64(seed))
                        at = permute(slot % blocks[number], np.full(n, blocks[number]), key)
                        made = (np.full(n, part * (per_group // SHARD_SLOTS) + k), np.full(n, number), slot, turn, at)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["shard", "number", "slot", "turn", "block"])

    made = drawn.mapInArrow(run, "shard bigint, number bigint, slot bigint, turn bigint, block bigint")
    facts = spark.createDataFrame(
        [(i, s, b, q, q // s if s else 0) for i, (s, b, q) in enumerate(zip(sizes, blocks, quota))],
        "number bigint, size bigint, blocks bigint, quota bigint, turns bigint",
    )
    made = made.join(facts, "number")
    # In the last turn at most one block is the short one; slots before it hold ``block`` words each.
    length = F.least(F.lit(block), F.col("size") - F.col("block") * block)
    short = F.col("size") % block
    missing = F.when(short > 0, block - short).otherwise(0)
    last = made.filter("turn = turns").filter(F.col("block") == F.col("blocks") - 1).select("number", F.col("slot").alias("short_slot"))
    made = made.join(last, "number", "left")
    ahead = (F.col("slot") - F.col("turns") * F.col("blocks")) * block - F.when(F.col("slot") > F.col("short_slot"), missing).otherwise(0)
    rest = F.col("quota") - F.col("turns") * F.col("size") - ahead
    head = F.when(F.col("turn") < F.col("turns"), length).otherwise(F.greatest(F.lit(0), F.least(length, rest)))
    cut_off = (F.col("turn") == F.col("turns")) & (head < length)
    return made.groupBy("number", "block").agg(
        F.sum(F.when(cut_off, 0).otherwise(1)).alias("full"), F.sum(F.when(cut_off, head).otherwise(0)).alias("head")
    )
