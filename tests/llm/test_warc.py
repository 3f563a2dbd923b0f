"""Archives: round trips, revisits, rolled files, repeatable bytes, damage."""

import gzip
import hashlib
import os
import random
import zlib

import pytest

from sunledger.llm import warc as W

PAGES = "page_id bigint, url string, html string"


def pages(spark, n=60):
    same = "<p>" + "copy " * 40 + "é</p>"
    rows = [(i * 3, f"https://example.org/{i}", same if i % 4 == 0 else f"<b>{'page %d ' % i * 30}</b>") for i in range(1, n)]
    rows += [(1000, None, None), (1001, "https://example.org/x\r\ny", ""), (1002, "u", "short"), (1003, "u", "short"), (-7, "u", same)]
    return rows, spark.createDataFrame(rows, PAGES)


def expected(rows):
    first = {}
    for i, _, html in sorted(rows):
        first.setdefault(html or "", i)
    out = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first[html] != i
        out[i] = (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None)
    return out


def read(spark, folder):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.read_archives(spark, folder).collect()}


def contents(folder):
    return {n: open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder) if n.endswith(".warc.gz")}


def test_round_trip_in_shards_and_rolled_files(spark, tmp_path):
    rows, frame = pages(spark)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    manifest = W.write_archives(frame, one, file_bytes=900, shard_bytes=4000).collect()
    W.write_archives(frame.repartition(7), two, file_bytes=900, shard_bytes=4000)
    assert read(spark, one) == expected(rows) and sum(r.records for r in manifest) == len(rows)
    assert contents(one) == contents(two)
    assert {r.file: (r.bytes, r.sha256) for r in manifest} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in contents(one).items()}
    assert len({r.file.split("-")[1] for r in manifest}) > 1 and any(r.file.endswith("00001.warc.gz") for r in manifest)


def test_records_are_sorted_and_whole(spark, tmp_path):
    _, frame = pages(spark)
    W.write_archives(frame, str(tmp_path / "a"), file_bytes=900, shard_bytes=4000)
    files = contents(str(tmp_path / "a"))
    ids = []
    for name in sorted(files):
        text = gzip.decompress(files[name])
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        ids += [int(line[11:]) for line in text.split(b"\r\n") if line.startswith(b"X-Page-ID: ")]
    assert ids == sorted(ids)


def test_files_without_a_manifest_entry_are_not_read_and_damage_is_seen(spark, tmp_path):
    rows, frame = pages(spark)
    folder = str(tmp_path / "a")
    W.write_archives(frame, folder)
    name = next(iter(contents(folder)))
    for stray in ("shard-000099-00000.warc.gz", "_temporary-4"):
        with open(f"{folder}/{stray}", "wb") as f:
            f.write(gzip.compress(b"half a rec"))
    assert read(spark, folder) == expected(rows)
    data = bytearray(contents(folder)[name])
    data[len(data) // 2] ^= 1
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="not the file of the manifest"):
        read(spark, folder)


def test_odd_tables(spark):
    empty = W.archive_round_trip(spark.createDataFrame([], PAGES))
    assert empty.count() == 0 and empty.columns[0] == "page_id"
    long = "x" * 200
    rows = [(None, "u", long), (5, "u", long), (5, "u", long), (4, "u", long), (5, "v", "y" * 150)]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as refers_to", "'z' as payload_digest", "3 as shard")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in W.archive_round_trip(frame).collect()), key=str)
    assert got == sorted(
        [(None, 200, "response", None), (4, 200, "response", None), (5, 200, "revisit", 4), (5, 200, "revisit", 4), (5, 150, "response", None)],
        key=str,
    )


def test_bounds_follow_bytes_and_grow_with_the_shards(spark, monkeypatch):
    monkeypatch.setattr(W, "LEAST_SAMPLE", 10)
    monkeypatch.setattr(W, "SHARD_SAMPLE", 5)
    rows = [(i, 100_000 if i < 100 else 10) for i in range(2000)]
    keys = spark.createDataFrame(rows, "page_id bigint, payload_bytes bigint")
    bounds = W._bounds(keys, 400)
    assert len(bounds) > 50 and sum(b < 100 for b in bounds) > len(bounds) // 3
    assert W._bounds(keys, 1) == [] and W._bounds(keys.filter("page_id < 0"), 4) == []


def test_file_systems(monkeypatch):
    assert W._file_system("/tmp/x")[1] == W._file_system("file:///tmp/x")[1] == "/tmp/x"
    asked = []
    monkeypatch.setattr(W.pafs, "FileSystem", type("Asked", (), {"from_uri": staticmethod(asked.append)}))
    for path in ("s3a://bucket/a folder", "hdfs://name:8020/x", "/data/x"):
        W._file_system(path)
    assert asked == ["s3://bucket/a folder", "hdfs://name:8020/x", "file:///data/x"]


def test_reading_a_member_touches_a_piece_of_the_archive(monkeypatch):
    piece = W.PIECE_BYTES
    noise = random.Random(5).randbytes(3 * piece)
    records = [b"a" * n for n in range(300)] + [noise, b"", noise[: piece - 40], b"x" * (50 * piece)] + [b"b"] * 300
    data = b"".join(gzip.compress(r, 6, mtime=0) for r in records)
    given, new = [], zlib.decompressobj

    class Counted:
        def __init__(self, **options):
            self.inner = new(**options)

        def decompress(self, part):
            given.append(len(part))
            return self.inner.decompress(part)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(zlib, "decompressobj", Counted)
    assert list(W._members(data)) == records
    assert max(given) <= piece
