"""Embedding groups against all cosines."""

import random

import numpy as np

from sunledger.llm import vectors as V
from tests.llm.test_simhash import components


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def made(seed=2, n=300, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 4, dim))
    rows = [centres[i % len(centres)] + rng.standard_normal(dim) * rng.choice([0.05, 0.3, 0.6]) for i in range(n)]
    return [(i, [float(x) for x in np.float32(r)], 0) for i, r in enumerate(rows)]


def expected(rows):
    sound = {i: np.array(v, float) for i, v, _ in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = []
    for a in sound:
        for b in sound:
            if a < b and len(sound[a]) == len(sound[b]):
                x, y = sound[a], sound[b]
                if x @ y >= 0.9 * np.linalg.norm(x) * np.linalg.norm(y):
                    links.append((a, b))
    n = {i: sum(i in p for p in links) for i, _, _ in rows}
    parts = components([i for i, _, _ in rows], links)
    return {i: (n[i], parts[i], parts[i] == i) for i in n}


def got(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in frame.collect()}


ODD = [
    (1000, None, 1), (1001, [], 1), (1002, [0.0, 0.0], 1), (1003, [float("nan"), 1.0], 1), (1004, [float("inf"), 1.0], 1),
    (1005, [None, 1.0], 1), (1006, [1.0, 1.0], 1), (1007, [2.0, 2.0], 1), (1008, [1.0, 1.0], 1), (1009, [1.0, 1.0, 1.0], 1),
]


def test_against_all_cosines(spark):
    rows = made() + ODD
    random.Random(1).shuffle(rows)
    want = expected(rows)
    found = got(V.embedding_groups(table(spark, rows)))
    assert found == want and sum(v[0] for v in want.values()) > 100


def test_large_buckets_are_cut_into_pairs_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(V, "BUCKET_ROWS", 8)
    rows = made(5, 120)
    assert got(V.embedding_groups(table(spark, rows))) == expected(rows)


def test_odd_tables(spark):
    assert V.embedding_groups(table(spark, [])).count() == 0
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [1.0, 0.01], 0)]
    frame = table(spark, rows).selectExpr("*", "1 as component_id", "2 as first", "3 as n_links")
    assert got(V.embedding_groups(frame)) == {1: (1, 1, True), 2: (1, 1, False)}


def test_recall_at_the_threshold_grows_with_the_tables():
    for rows in (10, 10**5, 10**8):
        bits, tables = V.hash_shape(rows)
        same = (1 - np.arccos(0.9) / np.pi) ** bits
        assert (1 - same) ** tables <= V.MISS


def test_tiny_and_huge_components(spark):
    rows = [(1, [1e-200, 1e-200]), (2, [2e-300, 2e-300]), (3, [1e-200, -1e-200]), (4, [1e300, 1e300]), (5, [1e300, -1e300]), (6, [5e-324, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert {i: v[:2] for i, v in got(V.embedding_groups(frame)).items()} == {1: (2, 1), 2: (2, 1), 4: (2, 1), 3: (1, 3), 5: (1, 3), 6: (0, 6)}
