"""Bottom-k sketches against plain sets of shingles."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from sunledger.llm import queries
from sunledger.llm import sketches as S
from tests.llm.fixtures import corpus, documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]{1,32}")


def hashes(text):
    ws = WORD.findall(text or "")
    out = set()
    for at in range(max(len(ws) - 4, 1) if ws else 0):
        h = 42
        for w in ws[at : at + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return out


def sketch(text):
    return sorted(hashes(text))[:128]


def likeness(a, b):
    u = sorted(set(a) | set(b))[:128]
    return sum(h in a and h in b for h in u) / len(u) if u else 1.0


def spelled(s):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in s)


def expected(rows):
    """The rows in the order of ids (null last), each with the next different one."""
    key = lambda r: (r[0] is None, r[0] or 0, (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(r[1].encode(), 42)))
    rows = sorted(((i, t or "") for i, t in rows), key=key)
    different = [r for k, r in enumerate(rows) if not k or rows[k - 1] != r]
    after = {r: different[(k + 1) % len(different)] for k, r in enumerate(different)}
    out = []
    for r in rows:
        i, t = r
        follows = after[r][1]
        take = len(t) // 4
        edited = t[: len(t) - take] + follows[:take]
        a, b, c = sketch(t), sketch(edited), sketch(follows)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(t), sha, spelled(a), spelled(b), round(likeness(a, b), 9), round(likeness(a, c), 9)))
    return sorted(out, key=str)


def got(spark, rows, folder):
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    out = queries.op13_document_fingerprints(spark, str(folder))
    assert out.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in out.collect()), key=str)


def test_query_against_sets(spark, tmp_path):
    rng = random.Random(4)
    emoji = ["\U0001f642 é 日本語 テキスト " * 9, "日本語テキスト" * 60, "x" * 301]
    rows = corpus() + [(300 + i, t) for i, t in enumerate(emoji)] + [(7, "another seventh text " * 5), (7, "seven"), (7, "seven"), (None, "no id"), (None, None)]
    rng.shuffle(rows)
    assert got(spark, rows, tmp_path) == expected(rows)


def test_one_row_and_no_row(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    assert got(spark, [(5, "a b c d e f g h")], tmp_path / "a") == expected([(5, "a b c d e f g h")])
    assert got(spark, [], tmp_path / "b") == []
    clash = documents(spark, [(1, "a b")]).selectExpr("*", "1 as id", "2 as key", "3 as next", "4 as sketch", "5 as n", "6 as part")
    assert S.fingerprints_under_edits(clash).count() == 1


def test_estimates(spark):
    rng = random.Random(1)
    base = words(rng, 6000)
    cases = [(" ".join(base[:n]), " ".join(base[a:b])) for n, a, b in ((4000, 0, 4000), (4000, 1000, 6000), (900, 0, 4000), (3000, 3000, 6000), (60, 0, 80), (0, 0, 900))]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a string, b string")
    frame = frame.select("i", S.sketch("a").alias("a"), S.sketch("b").alias("b"))
    found = frame.select("i", S.resemblance("a", "b"), S.containment("a", "b"), S.distinct_shingles("a"), S.distinct_shingles("b")).orderBy("i")
    for (i, r, c, n, m), (a, b) in zip(found.collect(), cases):
        a, b = hashes(a), hashes(b)
        true = len(a & b) / len(a | b)
        assert abs(r - true) <= 0.15 and abs(c - (len(a & b) / len(a) if a else 1)) <= 0.3, i
        for estimate, exact in ((n, len(a)), (m, len(b))):
            assert estimate == exact if exact < 128 else abs(estimate / exact - 1) < 0.35
    assert [round(r[1], 3) for r in found.collect()][0] == 1.0


def test_merged_parts(spark):
    rows = [(i, t) for i, t in corpus(n=40)]
    parts = S.document_sketches(documents(spark, rows)).withColumn("part", F.pmod("doc_id", F.lit(3)))
    for r in S.merged_sketches(parts, ["part"]).collect():
        every = set().union(*(hashes(t) for i, t in rows if i % 3 == r.part))
        assert r.sketch == sorted(every)[:128]
    two = parts.filter("part < 2").groupBy("part").agg(F.max("sketch").alias("s")).groupBy().agg(F.min("s").alias("a"), F.max("s").alias("b"))
    row = two.select("a", "b", S.merged("a", "b").alias("m")).first()
    assert row.m == sorted(set(row.a) | set(row.b))[:128]


def test_no_python_in_the_plan(spark):
    plan = S.fingerprints_under_edits(documents(spark, corpus(n=5)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
