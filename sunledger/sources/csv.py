"""Vendor CSV files: one profiling pass over the text, then one parsing scan."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.session import materialise
from sunledger.sources.files import as_glob

# Fields of a record that the parser is asked to hold. A longer record is cut to the header's width
# before it is parsed; a line has more signs than fields, so only longer lines are looked at.
MAX_COLUMNS = 20_480
# Lines beyond this length are walked field by field instead of matched as a whole.
LONG_LINE = 4096


def profile_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file: header line, data line count, detected foreign encoding.

    ``detected_encoding`` is NULL for UTF-8. The whole file is checked, byte by byte.
    ``may_span_lines`` marks files in which a quoted field may span lines, a
    line holds only blanks or may have more fields than the parser holds; they
    are read by :func:`scan_spanning_rows`.
    """
    lines = spark.read.text([as_glob(p) for p in paths]).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("place"),
    )
    value = F.col("value")
    used = value != ""
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    per_file = lines.groupBy("file_path").agg(
        F.count_if(used).alias("lines"),
        # A set aggregate keeps this a hash aggregate, so lines are not sorted.
        F.collect_set(F.when(~F.is_valid_utf8(value), F.lit("non-UTF-8"))).alias("defects"),
        F.count_if((quotes % 2 == 1) | (used & (F.trim(value) == "")) | (F.length(value) > MAX_COLUMNS)).alias("odd_lines"),
        F.min_by(F.when(used, value), F.when(used, F.col("place"))).alias("first_line"),
    )
    start = F.hex(F.col("first_line").cast("binary"))
    encoding = (
        F.when(start.startswith("FFFE0000"), "UTF-32 LE")
        .when(start.startswith("FFFE"), "UTF-16 LE")
        .when(start.startswith("FEFF"), "UTF-16 BE")
        .when(start.startswith("0000FEFF"), "UTF-32 BE")
        .otherwise(F.get("defects", F.lit(0)))
    )
    return per_file.select(
        "file_path",
        encoding.alias("detected_encoding"),
        F.greatest(F.col("lines") - 1, F.lit(0)).alias("data_lines"),
        F.when(F.is_valid_utf8("first_line"), F.regexp_replace("first_line", "^\\x{feff}", "")).alias("header_line"),
        (F.col("odd_lines") > 0).alias("may_span_lines"),
    )


def header_names(header_line: str, delimiter: str) -> list[str]:
    """Column names of one header line."""
    return next(csv.reader([header_line], delimiter=delimiter), [])


def header_spans_lines(header_line: str) -> bool:
    return header_line.count('"') % 2 == 1


def text_column(i: int) -> Column:
    return F.col(f"_c{i}")


def scan_rows(spark: SparkSession, paths: Sequence[str], width: int, delimiter: str) -> DataFrame:
    """Text columns ``_c0 … _c{width-1}`` of files that share one header, plus row places.

    Short rows are padded, long rows cut, stray quotes tolerated and nothing is
    trimmed. ``file_path``, ``block_start`` and ``scan_id`` locate each row. The
    files are split among tasks; see :func:`scan_spanning_rows` for quoted line breaks.
    """
    rows = (
        spark.read.schema(_text_schema(width))
        .option("header", True)
        .option("sep", delimiter)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("maxColumns", max(MAX_COLUMNS, width))
        .csv([as_glob(p) for p in paths])
    )
    return rows.select(
        *[f"_c{i}" for i in range(width)],
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )


def _text_schema(width: int) -> str:
    return ", ".join(f"_c{i} STRING" for i in range(width))


def _patterns(delimiter: str) -> tuple[str, str]:
    """Patterns of lines that end inside a quoted field: begun outside, begun inside one.

    A quote opens a field only as its first character; two quotes inside a field
    are one; text after a closing quote runs to the delimiter.
    """
    d = "\\t" if delimiter == "\t" else "\\" + delimiter
    inside = r'[^"]*+(?:""[^"]*+)*+'
    tail = rf'(?:(?:"{inside}"[^{d}]*+|(?!")[^{d}]*+){d})*+"{inside}\z'
    return f"^{tail}", rf'^{inside}(?:\z|"[^{d}]*+{d}{tail})'


def _fields(value: Column, delimiter: str) -> Column:
    """The text between delimiters, quoted ones included."""
    return F.split(value, "\t" if delimiter == "\t" else "\\" + delimiter)


def _after(open_: Column, part: Column) -> Column:
    """Whether a quoted field is open after ``part``, a stretch without delimiters."""
    inside = r'[^"]*+(?:""[^"]*+)*+'
    return F.when(open_, part.rlike(rf"^{inside}\z")).otherwise(part.rlike(rf'^"{inside}\z'))


def _ends_open(value: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field: begun outside, begun inside one."""
    return tuple(
        F.when(
            F.length(value) > LONG_LINE, F.aggregate(_fields(value, delimiter), F.lit(begun), lambda o, part: _after(o, part))
        ).otherwise(value.rlike(pattern))
        for begun, pattern in zip((False, True), _patterns(delimiter))
    )


def _first_fields(value: Column, width: int, delimiter: str) -> Column:
    """A record, cut after its first ``width`` fields if it has more than the parser holds."""

    def step(state: Column, part: Column) -> Column:
        still = _after(state["open"], part)
        more = F.struct(
            still.alias("open"),
            (state["fields"] + F.when(still, 0).otherwise(1)).alias("fields"),
            (state["taken"] + 1).alias("taken"),
        )
        return F.when(state["fields"] >= width, state).otherwise(more)

    begin = F.struct(F.lit(False).alias("open"), F.lit(0).alias("fields"), F.lit(0).alias("taken"))
    cut = F.array_join(
        F.slice(_fields(value, delimiter), F.lit(1), F.aggregate(_fields(value, delimiter), begin, step, lambda s: s["taken"])),
        delimiter,
    )
    fields = F.length(value) - F.length(F.replace(value, F.lit(delimiter), F.lit(""))) + 1
    return F.when((F.length(value) > MAX_COLUMNS) & (fields > MAX_COLUMNS), cut).otherwise(value)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its place and the line end that was sent: line feed, carriage return or both."""
    text = spark.read.option("lineSep", "\n").text([as_glob(p) for p in paths]).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block")
    )
    returned = F.col("value").endswith("\r")
    body = F.when(returned, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    parts = text.withColumn("returned", returned).withColumn("parts", F.split(body, "\r"))
    each = parts.select("file_path", "block", "returned", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "value"))
    end = F.when(F.col("at") < F.col("n") - 1, "\r").when(F.col("returned"), "\r\n").otherwise("\n")
    return each.select("file_path", "block", F.monotonically_increasing_id().alias("line"), "value", end.alias("line_end"))


def spanning_records(spark: SparkSession, paths: Sequence[str], delimiter: str, scratch: str) -> DataFrame:
    """(file_path, record, value): the records of files whose quoted fields hold line breaks; record 1 is the header.

    Line breaks inside a field are kept as sent. The files are split among
    tasks, however large one is. Whether a line begins inside a quoted field
    depends on all lines before it, but each line only keeps, flips or sets that
    state. The states are added up inside each split, then over the splits of a
    file, and only the lines of records that do span lines are brought together.
    """
    value = F.col("value")
    from_out, from_in = _ends_open(value, delimiter)
    lines = _lines(spark, paths).withColumn("from_out", from_out).withColumn("from_in", from_in)
    lines = lines.select(
        "value",
        "line_end",
        "file_path",
        "block",
        "line",
        (F.col("from_out") & ~F.col("from_in")).cast("bigint").alias("flips"),
        F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").cast("bigint")).alias("sets"),
    )
    split = W.partitionBy("file_path", "block").orderBy("line")
    before = split.rowsBetween(W.unboundedPreceding, -1)
    flipped = F.coalesce(F.sum("flips").over(before), F.lit(0))
    # A line that sets the state leaves a mark to which the flips so far are added.
    local = (
        lines.withColumn("flipped", flipped)
        .withColumn("mark", F.col("sets") + F.col("flipped"))
        .withColumn("last_mark", F.last("mark", ignorenulls=True).over(before))
    )
    local = materialise(local, f"{scratch}/lines")

    file_order = W.partitionBy("file_path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = local.groupBy("file_path", "block").agg(
        F.sum("flips").alias("_flips"), F.max(F.when(F.col("mark").isNotNull(), F.struct("line", "mark"))).alias("_top")
    )
    splits = splits.withColumn("_before", F.coalesce(F.sum("_flips").over(file_order), F.lit(0)))
    splits = splits.withColumn("_mark", F.col("_top.mark") + F.col("_before"))
    begin = F.coalesce(F.last("_mark", ignorenulls=True).over(file_order), F.lit(0)) + F.col("_before")
    begins = materialise(splits.select("file_path", "block", begin.alias("begin")), f"{scratch}/begins")

    inside_now = (F.coalesce("last_mark", "begin") + F.col("flipped")) % 2 == 1
    stated = local.join(begins, ["file_path", "block"]).withColumn("inside", inside_now)
    # Empty lines between records are no records.
    stated = stated.filter(F.col("inside") | (value != "")).withColumn("starts", (~F.col("inside")).cast("bigint"))
    stated = stated.withColumn("open", F.coalesce(F.col("sets") == 1, F.col("inside") != (F.col("flips") == 1)))
    counted = stated.withColumn("record", F.sum("starts").over(split))
    counts = stated.groupBy("file_path", "block").agg(F.sum("starts").alias("_n"))
    earlier = materialise(
        counts.select("file_path", "block", F.coalesce(F.sum("_n").over(file_order), F.lit(0)).alias("earlier")),
        f"{scratch}/counts",
    )
    placed = counted.join(earlier, ["file_path", "block"]).withColumn("record", F.col("record") + F.col("earlier"))
    placed = placed.select("file_path", "block", "line", "record", "value", "line_end", "inside", "open")

    spanning = F.col("inside") | F.col("open")
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value", "line_end"))).alias("parts")
    whole = F.transform(
        "parts", lambda p, i: F.when(i < F.size("parts") - 1, F.concat(p["value"], p["line_end"])).otherwise(p["value"])
    )
    joined = (
        placed.filter(spanning).groupBy("file_path", "record").agg(parts).select("file_path", "record", F.array_join(whole, "").alias("value"))
    )
    return placed.filter(~spanning).select("file_path", "record", "value").unionByName(joined)


def scan_records(records: DataFrame, width: int, delimiter: str) -> DataFrame:
    """The text columns and places of :func:`scan_rows` from ``records``; other columns are carried along."""
    options = {"sep": delimiter, "escape": '"', "mode": "PERMISSIVE", "maxColumns": str(max(MAX_COLUMNS, width))}
    cells = F.from_csv(_first_fields(F.col("value"), width, delimiter), _text_schema(width), options)
    rest = [c for c in records.columns if c not in ("value", "record")]
    read = records.filter(F.col("record") > 1).select(*rest, "record", cells.alias("cells"))
    return read.select(
        *[F.col(f"cells._c{i}").alias(f"_c{i}") for i in range(width)],
        *rest,
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("record").alias("scan_id"),
    )


def scan_spanning_rows(
    spark: SparkSession, paths: Sequence[str], width: int, delimiter: str, scratch: str
) -> DataFrame:
    """Like :func:`scan_rows` for files whose quoted fields hold line breaks, and for records of any number of fields."""
    return scan_records(spanning_records(spark, paths, delimiter, scratch), width, delimiter)
