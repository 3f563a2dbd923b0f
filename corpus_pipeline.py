"""The training-data pipeline: its stages and the query that runs them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import decontam, language, lines, mixing, simhash
from sunledger.llm.common import cut, held_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The contract of the SimHash stage.
SIMHASH_WORDS, SIMHASH_BITS = 4, 4


# Each stage judges rows by their text, so it treats all columns but doc_id and text as they are, whatever their
# names and nulls; null, empty and blank texts, repeated rows and empty tables have the results its docstring states.


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: those without a letter, and those that the network finds in none.

    Null, empty and blank texts have no letter and go; repeated rows stay or go
    together; rows with a null id are judged like all others but not learned
    from by fold. Without any label, and so for an empty table, nothing stays.
    """
    net = language.fit(docs.select("doc_id", "text", "lang").filter(~held_out("doc_id", 4, 2)))
    return language.in_some_language(docs, net)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; so does a document that has nothing left.

    ``n_chars``, where there is such a column, follows the text. Null, empty and
    blank texts and rows with a null id stay as they are; equal rows keep the
    same lines; columns of any other name keep their values. An empty table
    gives no rows.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("rest"))
    kept = lines.dedup_lines(packed).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint"))
    values = {c: F.col("rest").getField(c) for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in rest:
        values["n_chars"] = F.coalesce(chars, F.col("rest").getField("n_chars"))
    return kept.select(*[values[c].alias(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id.

    Null, empty and blank texts are one group. Rows that repeat an id become
    one row; rows with a null id stay. An empty table gives no rows.
    """
    return simhash.one_of_each_group(docs, SIMHASH_WORDS, SIMHASH_BITS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other values, go.

    Every row is judged by its own text, rows with null or repeated ids too;
    null, empty and blank texts stay. With an empty benchmark all rows stay, an
    empty table gives no rows.
    """
    return decontam.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes.

    Null sources are one source; null, empty and blank texts have size 0 and
    take 0; repeated rows and rows with a null id are documents of their own.
    Columns other than doc_id, source and text are left out. An empty table
    gives no rows.
    """
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("source_mixing", mixing_stage),
]

# The stages hold a trained network and pseudorandom draws, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
