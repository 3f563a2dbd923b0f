"""Very many small files on local paths: no checksums beside them, the same bytes, few calls."""

import os

from pyspark.sql import functions as F

from sunledger import session
from sunledger.plans import inputs as I
from sunledger.sinks import folders


def files(root):
    return {os.path.relpath(f"{d}/{n}", root) for d, _, names in os.walk(root) for n in names}


def test_tables_have_no_checksums_beside_them(spark, tmp_path):
    session.prepare(spark)
    rows = spark.range(20).withColumn("k", F.col("id") % 4)
    rows.write.partitionBy("k").parquet(f"{tmp_path}/t")
    assert not [n for n in files(tmp_path) if n.endswith(".crc")]
    assert spark.read.parquet(f"{tmp_path}/t").count() == 20


def test_a_session_keeps_the_local_system_it_names(spark):
    named = "org.apache.hadoop.fs.LocalFileSystem"
    other = spark.newSession()
    other.conf.set(session.LOCAL_SYSTEM, named)
    assert session.prepare(other).conf.get(session.LOCAL_SYSTEM) == named


def test_lines_are_written_as_they_are(spark, tmp_path):
    rows = [(n, p, f"{n}:{p}".encode() + b"\xff\xe9") for n in (0, 1, -3, None, 9) for p in (5, -1, 40)] + [(1, 7, None), (1, 8, b"")]
    lines = spark.createDataFrame(rows, "file_no bigint, place bigint, value binary").withColumn("value", F.col("value").cast("string"))
    written = I.write_lines(lines, f"{tmp_path}/here")
    lines.repartition("file_no").sortWithinPartitions("file_no", "place").drop("place").write.partitionBy("file_no").text(f"{tmp_path}/spark")
    found = {}
    for kind in ("here", "spark"):
        for name in files(f"{tmp_path}/{kind}"):
            if os.path.basename(name)[0] not in "._":
                with open(f"{tmp_path}/{kind}/{name}", "rb") as f:
                    found.setdefault(kind, {})[os.path.dirname(name)] = f.read()
    assert found["here"] == found["spark"] and len(found["here"]) == 5
    assert sorted(r.path for r in written.collect()) == sorted(files(f"{tmp_path}/here"))
    assert I.write_lines(lines.limit(0), f"{tmp_path}/none").count() == 0
    assert files(f"{tmp_path}/none") == set() and os.path.isdir(f"{tmp_path}/none")


def test_a_text_that_replaces_one_with_a_checksum_is_read(spark, tmp_path):
    plain = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/a/x.json")
    out = plain.create(path, True)
    out.write(bytearray(b"old"))
    out.close()
    folders.write_text(spark, f"{tmp_path}/a/x.json", "newer")
    assert spark.read.text(f"{tmp_path}/a/x.json").first().value == "newer"
    assert files(f"{tmp_path}/a") == {"x.json"}
    assert folders.local(spark, f"file://{tmp_path}") == folders.local(spark, str(tmp_path)) == str(tmp_path)
