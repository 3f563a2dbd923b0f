"""Row checks and the transform on inline rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sunledger.operators import quality as Q
from sunledger.operators.layout import RawLayout
from sunledger.operators.registry import ColumnRule, Mapping
from sunledger.operators.transform import conform, output_schema

BASE = (ColumnRule("ts", "timestamp", "datetime"), ColumnRule("sid", "site_id", "string"))
GOOD = "2026-03-15T10:00:00Z"


def mapping(low=None, high=None, pass_through=False, required=("ts", "sid"), extra=()):
    bounds = (None if b is None else Decimal(b) for b in (low, high))
    power = ColumnRule("pwr_kw", "power_w", "decimal", "kw_to_w", *bounds)
    return Mapping(columns=(*BASE, power, *extra), required_fields=tuple(required), pass_through=pass_through)


def check(spark, m, rows, header=("ts", "sid", "pwr_kw"), **options):
    names = [f"c{i}" for i in range(len(header))]
    frame = spark.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows)], "row_index bigint, " + ", ".join(f"{n} string" for n in names)
    )
    return conform(
        frame, m, RawLayout(header, lambda i: F.col(names[i])), carry=["row_index"], dataset_id=F.lit("d"),
        schema_version=F.lit("v2"), ingestion_time=F.lit("2026-04-10").cast("timestamp"), **options,
    )


def failures(spark, m, rows, **more):
    found = Q.explode_failures(check(spark, m, rows, **more)).orderBy("row_index", "pos").collect()
    return [(r.row_index, r.field, r.rule) for r in found]


@pytest.mark.parametrize(
    "m, rows, expected",
    [
        (mapping(), [(GOOD, "s", "1.5"), (GOOD, "s", "2")], []),
        (mapping(0), [(GOOD, "s", "-3.25"), (GOOD, "s", "-0.0000000001"), (GOOD, "s", "-0.0")], [(1, "pwr_kw", "NumericRange"), (2, "pwr_kw", "NumericRange")]),
        (mapping(0, 640), [(GOOD, "s", "640.0000000001"), (GOOD, "s", "6.4e2")], [(1, "pwr_kw", "NumericRange")]),
        (mapping(-4, 640), [(GOOD, "s", "-4.00"), (GOOD, "s", "640.000")], []),
        (mapping(), [(GOOD, "s", "-73215.5")], []),
        (mapping(), [("soon", "s", "7")], [(1, "ts", "NumericParse")]),
        (mapping(required=("sid",)), [("", "s", "1")], [(1, "ts", "RequiredField")]),
        (mapping(), [("", "s", "1"), ("noon-ish", "s", "1")], [(1, "ts", "RequiredField"), (2, "ts", "NumericParse")]),
        (mapping(required=("ts", "sid", "pwr_kw")), [(GOOD, "s", " ")], [(1, "pwr_kw", "RequiredField"), (1, "pwr_kw", "NumericParse")]),
        (mapping(), [(GOOD, "s", "9999999999")], [(1, "pwr_kw", "NumericRange")]),
        (mapping(), [(GOOD, None, None)], [(1, "sid", "RequiredField"), (1, "pwr_kw", "NumericParse")]),
    ],
)
def test_rules(spark, m, rows, expected):
    assert failures(spark, m, rows) == expected


def test_detail_texts(spark):
    rows = Q.explode_failures(check(spark, mapping(0, 1000), [(GOOD, "s", "(1.0)"), (GOOD, "s", "+1,001.50"), ("x", "", "y")]))
    assert [r.detail for r in rows.orderBy("row_index", "pos").collect()] == [
        "Field 'pwr_kw' value -1.0 is below minimum 0 at row 1.",
        "Field 'pwr_kw' value 1001.50 exceeds maximum 1000 at row 2.",
        "Required field 'sid' is null or empty at row 3.",
        "Timestamp field 'ts' value 'x' is not a valid datetime at row 3.",
        "Field 'pwr_kw' value 'y' is not a valid number at row 3.",
    ]


def test_pass_through_needs_no_mapped_column(spark):
    m = mapping(pass_through=True)
    assert failures(spark, m, [(GOOD, "s")], header=("ts", "sid")) == []
    assert failures(spark, m, [("", "s")], header=("TS", "sid")) == [(1, "ts", "RequiredField")]
    assert failures(spark, m, [("s",)], header=("sid",)) == [(1, "ts", "RequiredField")]
    row = check(spark, m, [(GOOD, "s", "3.75", "7", "z")], header=("ts", "sid", "dc", "POWER_W", "schema_version")).first()
    assert (row.dc, row.power_w, row.schema_version) == ("3.75", Decimal(7), "v2")


def test_header_names(spark):
    layout = RawLayout(["a", "A", "b", "b"], lambda i: F.lit(str(i)))
    assert layout.missing(Mapping(columns=(ColumnRule("B", "x"), ColumnRule("c", "y")))) == ["c"]
    row = spark.range(1).select(layout.get("a"), layout.get("B")).first()
    assert tuple(row) == ("1", "2")


TYPES = tuple(
    ColumnRule(k, f"as_{k}", k) for k in ("int", "long", "bool", "datetime", "double", "float", "text")
)


def test_defaults_and_strict_types(spark):
    header = ("ts", "sid", "pwr_kw", *[r.vendor_column for r in TYPES])
    m = mapping(extra=TYPES)
    rows = [(GOOD, "s", "1", "5", "6", "TRUE", "2026-01-02", "1e2", "0.5", " t "), (GOOD, "s", "1", "x", "x", "x", "x", "0", "0", "")]
    good, bad = check(spark, m, rows, header=header).orderBy("row_index").collect()
    assert (good.as_int, good.as_long, good.as_bool, good.as_double, good.as_text) == (5, 6, True, 100.0, " t ")
    assert (bad.failures, bad.as_int, bad.as_long, bad.as_bool) == (None, 0, 0, False)
    assert bad.as_datetime == bad.ingestion_time
    strict = failures(spark, m, rows, header=header, compat=False)
    assert strict == [(2, k, "TypeMismatch") for k in ("int", "long", "bool", "datetime")]
    overflow = [(GOOD, "s", "1", "3000000000", "6", "true", "2026-01-02", "1", "1", "")]
    assert failures(spark, m, overflow, header=header) == [(1, "int", "NumericRange")]


def test_output_schema():
    names = [f.name for f in output_schema(mapping(), ["extra"])]
    assert names == ["site_id", "timestamp", "ingestion_time", "source_dataset_id", "schema_version", "power_w", "extra"]


def test_plans_stay_on_the_jvm_and_bound_hot_groups(spark):
    rows = check(spark, mapping(0), [(GOOD, "s", "-1")]).withColumn("dataset_id", F.col("site_id"))
    first = Q.first_failures(Q.explode_failures(rows, "dataset_id"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("WindowGroupLimit") == 2
