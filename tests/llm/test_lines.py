"""Fuzzy lines against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from sunledger.llm import lines as L
from tests.llm.fixtures import documents, words
from tests.llm.test_simhash import components


def expected(rows):
    """(doc_id, text): numbers of the lines that go, by all pairs of different lines."""
    occurrences, first = [], {}
    key = lambda r: (r[0], xxhash_of(r[1]))
    for i, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=key):
        for k, line in enumerate(L.normal_lines(text)):
            if line:
                occurrences.append((i, text, k, line))
                first.setdefault(line, (i, xxhash_of(text), k))
    sets = {x: plain_shingles(x) for x in first}
    links = [
        (a, b) for a in first for b in first
        if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    part = components(first, links)
    keep = {}
    for line, at in first.items():
        keep[part[line]] = min(keep.get(part[line], at), at)
    gone = {}
    for i, text, k, line in occurrences:
        if keep[part[line]] != (i, xxhash_of(text), k):
            gone.setdefault((i, xxhash_of(text)), set()).add(k)
    return gone


def plain_shingles(line):
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def xxhash_of(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def removed(frame):
    return {(r.doc_id, r.text_key): set(r.removed) for r in L.removed_lines(frame).collect()}


def made(seed=4, n=60):
    rng = random.Random(seed)
    known = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(25)]
    rows = []
    for i in range(n):
        body = []
        for _ in range(rng.randint(0, 9)):
            line = rng.choice(known) if rng.random() < 0.5 else " ".join(words(rng, rng.randint(0, 40)))
            parts = line.split()
            if len(parts) > 30 and rng.random() < 0.6:
                parts[rng.randrange(len(parts))] = "changed"
            body.append(rng.choice(["", " "]) + " ".join(parts))
        rows.append((i, "\n".join(body)))
    return rows + [(90, None), (91, ""), (92, "\n\n"), (93, "x" * 9000), (94, "X" * 9000), (95, "x" * 9001)]


def test_against_all_pairs(spark):
    rows = made()
    want = expected(rows)
    # Lines near the threshold meet with the probability of the bands.
    assert removed(documents(spark, rows)) == want and sum(map(len, want.values())) > 60


def test_a_band_of_many_like_lines(spark):
    rng = random.Random(8)
    base = words(rng, 60)
    rows = []
    for i in range(60):
        line = list(base)
        for _ in range(rng.randint(1, 3)):
            line[rng.randrange(60)] = f"edit{rng.randrange(1000)}"
        rows.append((i, " ".join(line)))
    got, want = removed(documents(spark, rows)), expected(rows)
    assert set(got) <= set(want) and len(set(want) - set(got)) <= 1 and len(want) > 30


def test_bands_of_unlike_lines(spark, monkeypatch):
    """All lines in one band, in chunks smaller than the band: the comparison across components alone finds the links."""
    monkeypatch.setattr(L, "banding", lambda n: (1, 1))
    monkeypatch.setattr(L, "band_keys", lambda lines, bands, rows: np.ones((len(lines), 1), np.uint64))
    monkeypatch.setattr(L, "CHUNK_LINES", 7)
    rows = made(seed=5, n=40)
    met = spark.createDataFrame([(1, L._long(lo), L._long(m)) for lo, m in star(rows)], L.MEETINGS)
    monkeypatch.setattr(L, "meetings", lambda docs, bands, per: met)
    assert removed(documents(spark, rows)) == expected(rows)


@pytest.mark.parametrize("slots, block", [(1 << 20, 1 << 18), (1 << 20, 50), (16, 1 << 18)])
def test_comparison_across_components(monkeypatch, slots, block):
    """All pairs of a band in one table or in pairs of chunks, whatever the slots hold and however lines are dealt in blocks."""
    monkeypatch.setattr(L, "SLOTS", slots)
    monkeypatch.setattr(L, "BLOCK_SIGNS", block)
    rng = random.Random(11)
    lines = {"abc", "abcd", "abcde", "a" * 300, "a" * 400, "é" * 9, "日本語" * 12, "日本語" * 12 + "x", "\U0001f600" * 3}
    for _ in range(25):
        base = words(rng, rng.randint(2, 25), "abc")
        for _ in range(4):
            lines.add(" ".join(base[: len(base) - rng.randint(0, 2)] + words(rng, rng.randint(0, 1), "de")))
    lines = sorted(lines)
    names = list(range(len(lines)))
    parts = [0 if i in (3, 4) else i for i in names]
    sets = [L.shingles(x) for x in lines]
    like = [(i, j) for i in names for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= L.MIN_JACCARD]
    assert len(like) > 40

    def components(links):
        forest = L.Forest()
        for a, b in [(3, 4), *links]:
            forest.join(a, b)
        return [forest.find(i) for i in names]

    def table(rows, lo, hi):
        each = {"band": [5] * len(rows), "lo": [lo] * len(rows), "hi": [hi] * len(rows), "chunk": [i % 2 for i in rows]}
        return pa.table({**each, "k1": rows, "part": [parts[i] for i in rows], "line": [lines[i] for i in rows]})

    def found(*tables):
        return [(r["src"], r["dst"]) for t in tables for r in L._across(t).to_pylist()]

    assert components(found(table(names, 0, 0))) == components(like)
    halves = [[i for i in names if i % 2 == k] for k in (0, 1)]
    assert components(found(table(halves[0], 0, 0), table(halves[1], 1, 1), table(names, 0, 1))) == components(like)
    assert found(table(names[:1], 0, 0)) == []


def star(rows):
    names = sorted({xxhash.xxh64_intdigest(x.encode(), 42) for _, t in rows if t for x in L.normal_lines(t) if x})
    return [(names[0], n) for n in names[1:]]


def test_meetings_of_batches():
    """Each band's lines are linked to one of them, over any cut into batches and tasks."""
    rng = random.Random(3)
    lines = [" ".join(words(rng, rng.randint(1, 12), "ab")) for _ in range(80)]
    texts = pa.RecordBatch.from_pydict({"text": ["\n".join(lines[i : i + 9]) for i in range(0, 80, 5)]})
    tasks = [texts.slice(0, 5), texts.slice(5, 7), texts.slice(12)]
    signed = pa.Table.from_batches([b for t in tasks for b in L._signed(14, 5)(iter([t]))])
    own = pc.equal(signed["lo"], signed["member"])
    heads = signed.filter(own).sort_by([("band", "ascending"), ("lo", "ascending")])
    rest = signed.filter(pc.invert(own))
    out = pa.Table.from_batches(list(L._stars(iter(heads.to_batches(max_chunksize=7) + rest.to_batches()))))
    keys, linked = {}, {}
    different = sorted(set(lines))
    for line, row in zip(different, L.band_keys(different, 14, 5).view(np.int64).tolist()):
        for band in row:
            keys.setdefault(band, set()).add(L._long(xxhash.xxh64_intdigest(line.encode(), 42)))
    forest = {}
    for r in out.to_pylist():
        forest.setdefault(r["band"], []).append((r["lo"], r["member"]))
    for band, members in keys.items():
        linked = components(members, forest.get(band, []))
        assert len(set(linked[m] for m in members)) == 1
    assert set(forest) == {b for b, m in keys.items() if len(m) > 1}


def test_texts_and_odd_rows(spark):
    rows = [(2, "First line here\nsecond\n\nsecond"), (1, "SECOND \nthird"), (None, "second"), (3, None), (4, ""), (4, "third")]
    frame = documents(spark, rows).selectExpr("*", "7 as n_removed", "'x' as line", "8 as part", "9 as text_key", "1 as k1")
    out = L.dedup_lines(frame)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)
    assert got == sorted(
        [(2, "First line here\n", 4, 2), (1, "SECOND \nthird", 2, 0), (None, "second", 1, 0), (3, None, 0, 0), (4, "", 1, 0), (4, "", 1, 1)],
        key=str,
    )
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "line", "part", "text_key", "k1", "n_lines", "n_removed"]
    assert L.dedup_lines(documents(spark, [])).count() == 0


def test_equal_rows_are_one_document(spark):
    rows = [(1, "alpha beta\ngamma delta"), (1, "alpha beta\ngamma delta"), (1, "gamma delta\nother words"), (2, "alpha beta")]
    got = sorted((r.doc_id, r.text) for r in L.dedup_lines(documents(spark, rows)).collect())
    keep = min(rows[0][1], rows[2][1], key=xxhash_of)
    want = ["alpha beta\ngamma delta"] * 2 + ["other words"] if keep == rows[0][1] else ["alpha beta"] * 2 + ["gamma delta\nother words"]
    assert got == sorted([(1, t) for t in want] + [(2, "")])
