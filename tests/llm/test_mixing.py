"""The mix against its rules: targets, caps, permutations, shards."""

import numpy as np
import pytest

from sunledger.llm import mixing as M
from tests.llm.fixtures import documents


@pytest.mark.parametrize(
    "sizes, weights, expected",
    [
        ([100, 100, 100], [5, 2, 1], [187.5, 75.0, 37.5]),
        ([10, 100, 100], [5, 2, 1], [30.0, 120.0, 60.0]),
        ([10, 10, 400], [5, 2, 1], [30.0, 30.0, 360.0]),
        ([0, 8], [5, 2], [0.0, 8.0]),
        ([5], [5], [5.0]),
    ],
)
def test_targets(sizes, weights, expected):
    assert M.target_sizes(sizes, weights) == pytest.approx(expected)


def test_permutations_are_permutations():
    for n in (1, 2, 3, 17, 64, 1000):
        key = np.full(n, 99, np.uint64)
        at = M.permute(np.arange(n), np.full(n, n), key)
        assert sorted(at.tolist()) == list(range(n))
    assert (M.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, np.uint64)) != at).any()


def test_shards_meet_the_quotas():
    counts = M.shard_counts([500, 200, 0, 37], 50, 3)
    assert counts.sum(0).tolist() == [500, 200, 0, 37] and set(counts.sum(1)[:-1].tolist()) == {50}
    share = counts[:, 0] / counts.sum(1)
    assert share.std() > 0.02  # drawn, not dealt


@pytest.mark.parametrize("block", [4, 16, 512])
def test_mix(spark, block, monkeypatch):
    monkeypatch.setattr(M, "RUN_DOCS", 8)
    monkeypatch.setattr(M, "SHARD_SLOTS", 16)
    rows = [(i, " ".join(["w"] * (i * 7 % 31)), None, "ab"[i % 2] if i % 5 else None, 1) for i in range(120)]
    rows += [(500, "one  two\n\tthree", None, "z", 1), (501, None, None, "z", 1), (502, "", None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, size string, source string, number int")
    mixed = M.mix_sources(docs, block=block).collect()
    again = {r.doc_id: r.taken for r in M.mix_sources(docs.repartition(5), block=block).collect()}
    assert {r.doc_id: r.taken for r in mixed} == again and len(mixed) == len(rows)
    sizes = {r[0]: len((r[1] or "").split()) for r in rows}
    assert {r.doc_id: r["size"] for r in mixed} == sizes
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    totals = [sum(sizes[r[0]] for r in rows if r[3] == s) for s in names]
    targets = M.target_sizes(totals, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for name, total, target in zip(names, totals, targets):
        own = [r for r in mixed if r.source == name]
        assert {r.source_size for r in own} == {total} and {round(r.target, 6) for r in own} == {round(target, 6)}
        assert sum(r.taken for r in own) == min(round(target), 3 * total)
    assert all(0 <= r.taken <= 3 * r["size"] for r in mixed)


def test_odd_tables(spark):
    assert M.mix_sources(documents(spark, [])).count() == 0
    blank = M.mix_sources(documents(spark, [(1, None), (2, " ")])).collect()
    assert {(r.doc_id, r["size"], r.taken) for r in blank} == {(1, 0, 0), (2, 0, 0)}
    twice = M.mix_sources(documents(spark, [(3, "a b c"), (3, "a b c"), (None, "d")])).collect()
    assert len(twice) == 3
