"""The pipeline's stages on small tables, each against what its operator decides."""

import os

import pytest

import corpus_pipeline as P
from sunledger.llm import mixing
from sunledger.llm.queries import REGISTERED
from tests.llm.fixtures import corpus, documents

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_apply_decisions(spark, tmp_path):
    item = "what is the number of red stones that the old miller hides under his bridge each year"
    rows = [(i, t) for i, t in corpus(n=30)] + [(300, "so " + item + " now"), (301, "123 456"), (302, "one"), (None, "no id here")]
    sf = str(tmp_path)
    documents(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {i for i, _ in rows}
    columns = docs.columns
    for name, stage in P.STAGES[:4]:
        out = P.cut(stage(spark, docs, sf), name)
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert out.columns == columns and kept <= ids
        if name == "language_id":
            assert 301 not in kept and 300 in kept
        if name == "benchmark_decontamination":
            assert ids - kept == {300}
        docs, ids = out, kept
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    mixed = P.STAGES[4][1](spark, docs, sf).collect()
    assert {r.doc_id for r in mixed} == ids and all(r.taken <= mixing.MAX_REPEATS * r["size"] for r in mixed)


def test_names_and_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTERED) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_run(spark):
    mixed = P.run(spark, SF_DIR)
    assert mixed.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and mixed.count() > 0


def test_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark, []).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert P.run(spark, sf).count() == 0


def test_clashing_and_missing_columns(spark, tmp_path):
    sf, item = str(tmp_path), "what is the number of red stones that the old miller hides under his bridge each year"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = [(i, t) for i, t in corpus(n=12)] + [(None, "so " + item), (None, "no id at all"), (7, "other text of seven"), (7, "more of seven")]
    odd = documents(spark, rows).drop("n_chars").selectExpr("*", "doc_id + 1 as n_lines", "-1 as n_removed", "'a' as `rest`", "2 as `odd.name`")
    for name, stage in P.STAGES[:4]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and out.filter("n_removed <> -1 or n_lines <> doc_id + 1 or `odd.name` <> 2").isEmpty(), name
        again = stage(spark, odd, sf)
        assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    kept = P.benchmark_stage(spark, odd, sf).filter("doc_id is null").collect()
    assert [r.text for r in kept] == ["no id at all"]
