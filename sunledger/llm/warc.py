"""WARC archives: a deterministic sharded writer with revisit records, and the reader."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import cut
from sunledger.session import work_dir

FILE_BYTES = 8 << 20
# Payload bytes that one shard (one task) writes.
SHARD_BYTES = 64 << 20
# Keys that the range bounds are taken from, at least and for each shard: the rows with the smallest hashes, so reruns agree.
LEAST_SAMPLE, SHARD_SAMPLE = 10_000, 20
# What a record's headers add to its payload, about.
HEADER_BYTES = 600
MIN_REVISIT_BYTES = 100
# Bytes of an archive that the reader hands to the decompressor at a time.
PIECE_BYTES = 8 << 10
# Fixed: names and values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


# Spellings of the Hadoop file systems that Arrow knows under another name. Those it lacks, such as abfss, are no target.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder: local, ``hdfs``, ``s3`` (or ``s3a``) or ``gs``."""
    scheme, found, rest = path.partition("://")
    if found:
        path = f"{SCHEMES.get(scheme, scheme)}://{rest}"
    return pafs.FileSystem.from_uri(path if found or path.startswith("file:") else f"file://{path}")


def record_id(page_id: int | None, number: int) -> str:
    """A stable record id; ``number`` tells apart rows that repeat a page id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{number}')}>"


def _record(row: dict, number: int) -> bytes:
    """One record with its headers, regenerated from the row; the payload of a revisit is left out."""
    payload = (row["html"] or "").encode()
    revisit = row["refers_to"] is not None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = head if revisit else head + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'], number)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if row["url"]:
        lines.append("WARC-Target-URI: " + "".join(" " if ord(c) < 32 else c for c in row["url"]).strip())
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(row['refers_to'], 0)}",
            f"X-Refers-To-Page-ID: {row['refers_to']}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def payload_keys(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest) of every page, without the payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("bigint"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )


def revisits(keys: DataFrame) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat a payload; equal payloads meet by digest."""
    large = keys.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES).filter("page_id is not null")
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = first.filter("refers_to < last").select("payload_digest", "refers_to")
    again = large.join(first, "payload_digest").filter("page_id <> refers_to")
    return again.select("page_id", "payload_digest", "refers_to").distinct()


def _bounds(rows: DataFrame, shards: int) -> list[int]:
    """Up to ``shards - 1`` page ids that cut the table into ranges of about equal bytes; the sample grows with the shards."""
    sample = rows.filter("page_id is not null").select("page_id", "payload_bytes").orderBy(F.xxhash64("page_id"), "page_id")
    found = sample.limit(max(LEAST_SAMPLE, SHARD_SAMPLE * shards)).toArrow().sort_by("page_id")
    if not found.num_rows or shards == 1:
        return []
    keys, upto = found["page_id"].to_numpy(), np.cumsum(found["payload_bytes"].to_numpy() + HEADER_BYTES)
    return np.unique(keys[np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)]).tolist()


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as gzip WARC files below ``folder`` and returns their manifest.

    Rows are range-partitioned by page_id into shards and sorted inside them;
    a shard rolls to the next file once ``file_bytes`` compressed bytes are
    written. A file is written under a name of the task attempt and then
    renamed, so a lost or repeated task leaves whole files with equal bytes;
    the manifest (file, records, bytes, sha256), itself a written table, names
    the committed files and readers take no others. Null html is an empty
    payload; a null url has no target header; null page ids sort first and stay
    responses; rows that repeat a page id and payload are all kept, as
    responses. An empty table gives an empty manifest.
    """
    keys = cut(payload_keys(pages), "payloads")
    total = keys.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    bounds = np.array(_bounds(keys, shards), np.int64)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, page_id, "right").astype(np.int32))

    # What a page repeats travels to its shard as a row of its own, right before the page; the payload moves once.
    marks = revisits(keys).select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "payload_digest", "refers_to"
    )
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("payload_digest", F.lit(None).cast("string")).withColumn("refers_to", F.lit(None).cast("bigint"))
    dealt = rows.unionByName(marks).withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-(1 << 63))))).repartitionById(shards, "shard")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        attempt = TaskContext.get().taskAttemptId()
        out, shard, number, digest, records, size, last, repeat = None, -1, 0, None, 0, 0, object(), 0
        done: list[tuple] = []
        repeats: dict[str, int] = {}

        def close():
            nonlocal out
            if out is not None:
                out.close()
                name = f"shard-{shard:06d}-{number:05d}.warc.gz"
                fs.move(f"{root}/_temporary-{attempt}", f"{root}/{name}")
                done.append((name, records, size, digest.hexdigest()))
                out = None

        for batch in batches:
            cells = dict(zip(batch.schema.names, batch.columns))
            for k in range(batch.num_rows):
                row = {c: column[k].as_py() for c, column in cells.items()}
                if row["page_id"] != last:
                    last, repeat, repeats = row["page_id"], -1, {}
                if row["refers_to"] is not None:
                    repeats[row["payload_digest"]] = row["refers_to"]
                    continue
                repeat += 1
                row["payload_digest"] = hashlib.sha256((row["html"] or "").encode()).hexdigest()
                row["refers_to"] = repeats.get(row["payload_digest"])
                if row["shard"] != shard:
                    close()
                    shard, number = row["shard"], -1
                if out is None:
                    out = fs.open_output_stream(f"{root}/_temporary-{attempt}", compression=None)
                    number, records, size, digest = number + 1, 0, 0, hashlib.sha256()
                member = gzip.compress(_record(row, repeat), 6, mtime=0)
                out.write(member)
                digest.update(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    close()
        close()
        columns = list(zip(*done)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "records", "bytes", "sha256"]
        )

    fs, root = _file_system(folder)
    fs.create_dir(root)
    order = [F.col("page_id"), F.col("refers_to").desc_nulls_last(), F.col("url"), F.col("html")]
    made = dealt.sortWithinPartitions("shard", *order).mapInArrow(write, "file string, records bigint, bytes bigint, sha256 string")
    made.write.mode("overwrite").parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.parquet(f"{folder}/_manifest")


def _members(data: bytes) -> Iterator[bytes]:
    """The records of an archive: one gzip member each, read in pieces, as what follows a member is copied by zlib."""
    view, at = memoryview(data), 0
    while at < len(view):
        unzip, parts = zlib.decompressobj(wbits=31), []
        while not unzip.eof and at < len(view):
            piece = view[at : at + PIECE_BYTES]
            parts.append(unzip.decompress(piece))
            at += len(piece) - len(unzip.unused_data)
        yield b"".join(parts)


def _parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and digest != hashlib.sha256(payload).hexdigest():
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
    }


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files that the manifest of ``folder`` commits; a damaged record is an error."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("file", "sha256")
    names = manifest.repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for name, digest in zip(batch.column("file").to_pylist(), batch.column("sha256").to_pylist()):
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    data = stream.read()
                if hashlib.sha256(data).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file of the manifest")
                found = [_parse(r) for r in _members(data)]
                kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
                columns = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in found], kinds.get(c, pa.string())) for c in columns], list(columns)
                )

    return names.mapInArrow(run, RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to a new folder of the shared storage and reads the archives back."""
    folder = work_dir(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
