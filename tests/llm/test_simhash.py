"""SimHash groups against a plain computation over all pairs."""

import re

import pytest
import xxhash

from sunledger.llm import simhash as S
from sunledger.llm.components import connected_components
from tests.llm.fixtures import corpus, documents


def fingerprint(text, shingle=4):
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_against_all_pairs(spark):
    rows = corpus()
    marks = {i: fingerprint(t) for i, t in rows}
    links = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 4]
    expected = components(marks, links)
    got = S.simhash_groups(documents(spark, rows)).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == marks
    assert {r.doc_id: r.component_id for r in got} == expected and len(set(expected.values())) < len(rows)


def test_spark_has_the_same_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_tree_finds_what_is_within_the_radius():
    values = [0, 1, 3, 7, 15, 31, 63, 2**63, 2**63 + 1, 12345, 12345 ^ 2**40]
    tree = S.BKTree()
    for v in values:
        tree.add(v)
    for q in (0, 5, 2**63, 12344):
        assert sorted(tree.within(q, 4)) == sorted(v for v in values if (v ^ q).bit_count() <= 4)


@pytest.mark.parametrize("rows", [1, 10**6, 10**9])
def test_some_mask_keeps_near_fingerprints_together(rows):
    masks = S.routing_masks(rows, 4)
    for flips in ([0, 1, 2, 3], [0, 20, 40, 63], [12, 13, 25, 51], [7]):
        changed = sum(1 << f for f in flips)
        assert any(changed & m == 0 for m in masks)


def test_large_groups_are_cut_into_pairs_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "TREE_SIZE", 5)
    rows = [(v << 4 ^ v >> 3,) for v in range(60)]
    unique = spark.createDataFrame(rows, "fp bigint").distinct()
    found = connected_components(S.links(unique, 60, 4)).collect()
    values = sorted({r[0] for r in rows})
    expected = components(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4])
    got = {r.node: r.component for r in found}
    assert {v: got.get(v, v) for v in values} == expected


def test_odd_tables(spark):
    assert S.simhash_groups(documents(spark, []).withColumnRenamed("lang", "fp")).count() == 0
    rows = [(None, "a b c d e"), (None, "q r s t u v"), (5, "a b c d e"), (5, "a b c d e"), (9, None), (8, "")]
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_groups(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 5), (None, None), (5, 5), (5, 5), (8, 8), (9, 8)], key=str)
    kept = S.one_of_each_group(documents(spark, rows).selectExpr("*", "1 as component_id", "2 as fp"))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [5, 8, None, None]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "component_id", "fp"]


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1040)] + [(7, 7), (1001, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path + star, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1000, 1040)}}
