"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import alignment, decontam, language, lines, mixing, periods, simhash, sketches, substrings, textquality, toxicity, vectors, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textquality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines", "n_removed")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.embedding_groups(table(spark, sf_dir, "embeddings"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return groups.select("doc_id", text, "component_id")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(periods.with_repeated_tails(table(spark, sf_dir, "documents")))
    best = F.col("best")
    found = found.withColumn("best", periods.highest_exponent("runs"))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.fingerprints_under_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.spelled("sketch").alias("fingerprint"),
        sketches.spelled("edited_sketch").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_warc": op9_warc,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_document_fingerprints": op13_document_fingerprints,
}
