"""Bottom-k sketches of word shingles as document fingerprints, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.llm.common import cut

SHINGLE_WORDS = 5
# A word of more signs counts as several, so that unspaced text has shingles too.
WORD_SIGNS = 32
# Hashes of a sketch: the standard error of a resemblance r is sqrt(r (1 - r) / SIZE), 0.044 at most.
SIZE = 128


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shingle_hashes(text: str | Column, words: int = SHINGLE_WORDS) -> Column:
    """The hash of every shingle of a text, repeats included; fewer words are one shingle, no word is none."""
    found = F.regexp_extract_all(_column(text), F.lit(rf"([^\x20\x09-\x0D]{{1,{WORD_SIGNS}}})"), 1)

    def hashed(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (words - 1), F.lit(1)))
        every = F.transform(starts, lambda at: F.xxhash64(F.slice(ws, at, words)))
        return F.when(F.size(ws) > 0, every).otherwise(F.array().cast("array<bigint>"))

    # The words are the variable of a lambda, so that they are made once for each text.
    return F.transform(F.array(found), hashed)[0]


def bottom(hashes: Column, size: int = SIZE) -> Column:
    """The ``size`` smallest different values, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def sketch(text: str | Column, words: int = SHINGLE_WORDS, size: int = SIZE) -> Column:
    """The sketch of a text: its smallest shingle hashes. A null text is an empty one."""
    return bottom(shingle_hashes(F.coalesce(_column(text), F.lit("")), words), size)


def merged(a: str | Column, b: str | Column, size: int = SIZE) -> Column:
    """The sketch of two parts together: what a sketch of all their shingles would be."""
    return bottom(F.concat(_column(a), _column(b)), size)


def distinct_shingles(a: str | Column, size: int = SIZE) -> Column:
    """Estimate of the number of different shingles; exact below ``size``."""
    a = _column(a)
    share = F.element_at(a, size).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise(F.lit(float(size - 1)) / share)


def resemblance(a: str | Column, b: str | Column, size: int = SIZE) -> Column:
    """Estimate of the Jaccard index from 0 to 1: the share of the smallest hashes of both that both hold. Two empty sketches: 1."""
    a, b = _column(a), _column(b)
    both = F.transform(F.array(merged(a, b, size)), lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u))[0]
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both)


def containment(a: str | Column, b: str | Column, size: int = SIZE) -> Column:
    """Estimate of the share of a's shingles that b holds too, from 0 to 1. An empty a is contained in everything."""
    a, b = _column(a), _column(b)
    shared = resemblance(a, b, size) * distinct_shingles(merged(a, b, size), size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(shared / distinct_shingles(a, size), F.lit(1.0)))


def spelled(a: str | Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(_column(a), lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def document_sketches(docs: DataFrame, words: int = SHINGLE_WORDS, size: int = SIZE) -> DataFrame:
    """(doc_id, sketch) for every row of ``docs``.

    Null, empty and blank texts have an empty sketch, equal texts equal ones;
    repeated rows and null ids stay; other columns are ignored; an empty table
    gives no rows. No shuffle.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), sketch("text", words, size).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """(keys, sketch) of all rows with equal ``keys`` together, from a table with a column ``sketch``.

    Hashes meet by (keys, hash) first, so a group with a third of all rows is
    spread; then each task passes on ``size`` hashes of a group at most. Groups
    without any hash have an empty sketch.
    """
    each = sketches.select(*keys, F.explode_outer("sketch").alias("hash")).groupBy(*keys, "hash").agg(F.lit(0).alias("_"))
    order = W.partitionBy(*keys).orderBy(F.col("hash").asc_nulls_last())
    least = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))


ORDER = ["nameless", "id", "key"]


def _named(docs: DataFrame) -> DataFrame:
    """Every row with its place in the order of documents: id (null ids last), then text hash."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select(
        F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("key"), "text"
    )


def successors(places: DataFrame) -> DataFrame:
    """Each different row of ``places`` (columns ORDER and n) with the columns ORDER of the next one, as ``next``; the first follows the last.

    Rows are dealt out by range and each range is ordered by itself; only the
    first row of each range meets the others.
    """
    different = places.distinct().repartitionByRange(*ORDER)
    ranged = cut(different.withColumn("part", F.spark_partition_id()), "ranges")
    inside = F.lead(F.struct(*ORDER)).over(W.partitionBy("part").orderBy(*ORDER))
    firsts = ranged.groupBy("part").agg(F.min(F.struct(*ORDER)).alias("first"))
    # One row for each partition of the shuffle.
    every = W.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(every), F.min("first").over(W.partitionBy(F.lit(0)))).alias("after"))
    found = ranged.withColumn("next", inside).join(F.broadcast(after), "part")
    return found.select(*ORDER, "n", F.coalesce("next", "after").alias("next"))


def edited_texts(docs: DataFrame, share: int = 4) -> DataFrame:
    """(doc_id, text, edited, next_sketch, n_chars) for every row of ``docs``.

    ``edited`` is the text with its last n div ``share`` of n code points
    replaced by as many (or all) first ones of the next document, in the order
    of doc_id; ``next_sketch`` is the next document's sketch. After the last
    document comes the first. Rows with equal id and text are one document
    (and stay repeated rows), different texts of one id follow by hash, null
    ids come last; a null text is an empty one. A text moves once, and the
    part of it that another document takes once more.
    """
    named = _named(docs)
    after = cut(successors(named.select(*ORDER, F.length("text").alias("n"))), "successors")
    wanted = after.select(
        *[F.col(f"next.{c}").alias(c) for c in ORDER],
        F.struct(*ORDER).alias("before"),
        F.floor(F.col("n") / share).cast("int").alias("take"),
    )
    given = named.join(wanted, ORDER)
    given = given.select("before.*", F.expr("substring(text, 1, take)").alias("tail"), sketch("text").alias("next_sketch"))
    given = given.groupBy(*ORDER).agg(F.any_value("tail").alias("tail"), F.any_value("next_sketch").alias("next_sketch"))
    n = F.length("text")
    kept = F.substring(F.col("text"), F.lit(1), (n - F.floor(n / share)).cast("int"))
    return named.join(given, ORDER).select(
        F.when(~F.col("nameless"), F.col("id")).alias("doc_id"),
        "text",
        F.concat(kept, F.col("tail")).alias("edited"),
        "next_sketch",
        n.cast("bigint").alias("n_chars"),
    )


def fingerprints_under_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next) for every row of ``docs``: see ``edited_texts``."""
    rows = edited_texts(docs)
    found = rows.select("doc_id", "n_chars", "edited", "next_sketch", sketch("text").alias("sketch"), sketch("edited").alias("edited_sketch"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
    )
