"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import cut


def _stars(edges: DataFrame) -> DataFrame:
    """One round: each node hands its larger, then its smaller neighbours to its smallest one."""
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("m")).withColumn("m", F.least("m", "src"))
    large = both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    large = large.filter("src <> dst").distinct()
    least = large.groupBy("src").agg(F.min("dst").alias("m"))
    rest = large.join(least, "src").filter("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return rest.union(least).filter("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: bigint); component is the smallest node reachable.

    Rounds of large-star and small-star steps: joins and minima only, so that a
    node with very many neighbours is a skewed join and never one collected
    group. Each round is a written table; rounds end when the links no longer
    change (a logarithmic number of times, two for stars). Loops, repeated
    links and both directions are accepted; links with a null end are ignored.
    """
    ends = [F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")]
    now = cut(edges.filter("src <> dst").select(ends).distinct(), "links")
    mark = None
    while True:
        now = cut(_stars(now), "links")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
