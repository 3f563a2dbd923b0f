"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import Forest, blocked, cut, group_slices
from sunledger.llm.components import connected_components

MIN_COSINE = 0.9
# Share of pairs at exactly the threshold that no table may miss together; closer pairs are missed far less.
MISS = 1e-4
# Vectors of one bucket that meet in one task; larger buckets are cut into pairs of chunks.
BUCKET_ROWS = 2048
SHARD_ROWS = 4096


def hash_shape(rows: int, threshold: float = MIN_COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables): bits follow the logarithm of the rows, tables the wanted recall at the threshold."""
    bits = max(4, math.ceil(math.log2(max(rows, 1) / 800 + 1)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _scaled(rows: list[np.ndarray]) -> np.ndarray:
    """The vectors in double precision, each times the power of two that brings its largest component near one.

    Such a factor is exact and leaves cosines as they are; squares of tiny or
    huge components neither vanish nor overflow.
    """
    x = np.stack(rows).astype(float)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _signs(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Adds ``codes``: the bucket of each vector in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for batch in batches:
            rows = _matrix(batch.column("embedding"))
            codes = np.zeros((len(rows), tables), np.int64)
            sizes = np.array([len(r) for r in rows])
            for dim in np.unique(sizes):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * bits))
                at = np.flatnonzero(sizes == dim)
                for part in np.array_split(at, max(1, len(at) // 1024)):
                    x = _scaled([rows[i] for i in part])
                    codes[part] = ((x @ planes[dim]) > 0).reshape(len(part), tables, bits) @ weights
            listed = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "codes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{schema}, codes array<bigint>")


def _compare(threshold: float):
    """Per shard: for every vector the copies it links to, and links that connect what is linked."""

    def run(shard: pa.Table) -> pa.Table:
        names = ("dim", "route", "code", "lo", "hi", "chunk", "first", "copies")
        dim, route, code, lo, hi, chunk, first, copies = (shard.column(c).to_numpy() for c in names)
        vectors, codes = _matrix(shard.column("embedding")), _matrix(shard.column("codes"))
        order, groups = group_slices([dim, route, code, lo, hi])
        joined, counted, out = Forest(), {}, []
        for a, b in groups:
            if b - a < 2:
                continue
            at = order[a:b]
            x = _scaled([vectors[i] for i in at])
            keys = np.stack([codes[i] for i in at])
            norm = np.sqrt((x * x).sum(1))
            ids, many, table = first[at], copies[at], route[at[0]]
            alike = lo[at[0]] == hi[at[0]]
            left = np.arange(len(at)) if alike else np.flatnonzero(chunk[at] == lo[at[0]])
            right = left if alike else np.flatnonzero(chunk[at] == hi[at[0]])
            for part in np.array_split(left, max(1, -(-len(left) // 256))):
                near = x[part] @ x[right].T >= threshold * norm[part][:, None] * norm[right]
                i, j = np.nonzero(near)
                i, j = part[i], right[j]
                if alike:
                    i, j = i[i < j], j[i < j]
                # A pair counts in the first table where its buckets agree.
                new = ~(keys[i, :table] == keys[j, :table]).any(1)
                for u, v in zip(i[new].tolist(), j[new].tolist()):
                    p, q = int(ids[u]), int(ids[v])
                    counted[p] = counted.get(p, 0) + int(many[v])
                    counted[q] = counted.get(q, 0) + int(many[u])
                    if joined.join(p, q):
                        out.append((p, q))
        src = [p for p, _ in out] + list(counted)
        dst = [q for _, q in out] + [None] * len(counted)
        n = [0] * len(out) + list(counted.values())
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def embedding_groups(vectors: DataFrame, threshold: float = MIN_COSINE, miss: float = MISS, seed: int = 17) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Equal vectors are compared once. Signs of random hyperplanes deal the
    others into buckets of several tables; inside a bucket cosines are computed
    in double precision, and each linked pair counts in the first table that
    shows it, so no list of pairs is shuffled. n_links counts the other rows
    with cosine >= ``threshold``; component_id is the smallest vec_id reachable.
    Null, empty and zero vectors and those with null or non-finite components
    link with nothing, nor do vectors of different lengths. Rows without an id
    are dropped, rows that repeat an id count as one (any one of its vectors:
    the smallest). An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding").filter("vec_id is not null")
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sound = F.expr(
        "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    rows = cut(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    unique = rows.filter("sound").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    unique = cut(unique, "unique")
    n = unique.count()
    bits, tables = hash_shape(n, threshold, miss)
    signed = cut(_signs(unique, bits, tables, seed), "signs")
    routed = signed.select("*", F.size("embedding").alias("dim"), F.posexplode("codes").alias("route", "code"))
    dealt = blocked(routed, ["dim", "route", "code"], "first", BUCKET_ROWS, SHARD_ROWS, n * tables)
    found = cut(dealt.groupBy("shard").applyInArrow(_compare(threshold), "src bigint, dst bigint, n bigint"), "found")
    parts = connected_components(found.filter("dst is not null").select("src", "dst"))
    linked = found.filter("dst is null").groupBy(F.col("src").alias("first")).agg(F.sum("n").alias("n"))
    nodes = (
        unique.join(linked, "first", "left")
        .join(parts.withColumnRenamed("node", "first"), "first", "left")
        .select(
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    # Sound vectors meet their node by a hash of the components, then by the components themselves.
    left = rows.withColumn("key", F.when(F.col("sound"), F.xxhash64("embedding")))
    right = nodes.select(F.xxhash64("embedding").alias("key"), F.col("embedding").alias("other"), "n_links", "component_id")
    return left.join(right, (left.key == right.key) & (left.embedding == right.other), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    )
