"""Periodic runs against a plain search over all starts and periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sunledger.llm import periods as P
from sunledger.llm import queries
from tests.llm.fixtures import corpus, documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(x, exponent=4, least=6):
    """All runs: every stretch that agrees with itself q words on, for ascending q, that no smaller period explains."""
    n, found = len(x), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def changed(doc_id, ws):
    n = len(ws)
    if doc_id is None or not n:
        return ws
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    ws = changed(doc_id, WORD.findall(text or ""))
    runs = plain_runs(ws)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha(listed), sha(kept))


def rows():
    rng = random.Random(6)
    made = [(i, t) for i, t in corpus(n=60) if not t or len(t) < 4000]
    for i in range(60):
        unit = words(rng, rng.randint(1, 40), "ab")
        body = (unit * rng.randint(2, 9))[: rng.randint(1, 300)]
        gap = rng.choice([" ", "  ", "\n", " \t"])
        made.append((1000 + i, gap.join(words(rng, rng.randint(0, 30)) + body + words(rng, rng.randint(0, 30)))))
    few = [(2000 + i, " ".join(rng.choice("xy") for _ in range(rng.randint(0, 300)))) for i in range(20)]
    odd = [(3000, "é é é é é é　é"), (3001, "a " * 700), (3002, " b b b b b"), (None, "c c c c c c c"), (3001, "a " * 700), (3003, "\n")]
    return made + few + odd


def test_query_against_all_starts_and_periods(spark, tmp_path):
    made = rows()
    documents(spark, made).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in made), key=str)
    assert sum(r[1] > 1 for r in got) > 10 and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in made) > 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4), st.integers(1, 9), st.integers(0, 50))
def test_runs_of_several_rows(texts, times, cut):
    texts = [(t * times)[cut:] for t in texts]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    values = np.array([ord(c) for t in texts for c in t], np.uint64)
    got = [tuple(r) for r in P.find_runs(values, first).tolist()]
    want = [(f + s, f + s + n, q) for f, t in zip(first.tolist(), texts) for s, n, q in plain_runs(t)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_transform_against_sums():
    rng = np.random.default_rng(1)
    for size in (1, 2, 4, 32, 256):
        blocks = rng.integers(0, P.PRIME, (5, size)).astype(np.uint64)
        windows = rng.integers(0, P.PRIME, (5, 2 * size - 1)).astype(np.uint64)
        windows[2, size // 2 : size // 2 + size] = blocks[2]
        got = P.mismatches(blocks, windows)
        for m in range(5):
            for s in range(size):
                pairs = zip(blocks[m].tolist(), windows[m, s : s + size].tolist())
                assert got[m, s] == sum((a - b) ** 2 for a, b in pairs) % P.PRIME
        assert got[2, size // 2] == 0


def test_long_texts_with_long_periods():
    rng = np.random.default_rng(2)
    unit = rng.integers(0, 1000, 30_011).astype(np.uint64)
    text = np.concatenate([rng.integers(2000, 3000, 777).astype(np.uint64), np.tile(unit, 5), np.full(200_000, 7, np.uint64)])
    got = P.find_runs(text, np.array([0, len(text)])).tolist()
    assert [777, 777 + 5 * 30_011, 30_011] in got and [777 + 5 * 30_011, len(text), 1] in got
    assert not len(P.find_runs(rng.integers(0, 1 << 60, 300_000).astype(np.uint64), np.array([0, 300_000])))


def test_clashing_columns_and_empty_tables(spark):
    frame = documents(spark, [(10, "a b " * 5)]).selectExpr("*", "1 as runs", "2 as h", "3 as g", "4 as collapsed")
    row = P.periodic_runs(frame).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (10, [(0, 10, 2)], "a b")
    assert P.with_repeated_tails(frame).columns == ["doc_id", "text"]
    assert P.periodic_runs(documents(spark, [])).count() == 0
