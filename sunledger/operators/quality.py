"""Row checks, failure reports, dataset verdicts and the row quarantine split."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sunledger.functions import scalars as S
from sunledger.operators.layout import RawLayout
from sunledger.operators.registry import ColumnRule, Mapping

FAILURES_TYPE = "array<struct<pos:int,field:string,rule:string,code:string,detail:string>>"
FIRST_FAILURES = 10

# Quarantine reason codes.
REASON_CODES = {
    "RequiredField": "MISSING_REQUIRED_FIELD",
    "NumericParse": "TYPE_MISMATCH",
    "NumericRange": "VALUE_OUT_OF_RANGE",
    "TypeMismatch": "TYPE_MISMATCH",
    "TimestampParse": "TIMESTAMP_UNPARSEABLE",
    "UnknownSchema": "SCHEMA_VALIDATION_FAILED",
    "EmptyDataset": "EMPTY_DATASET",
    "UnsupportedEncoding": "UNSUPPORTED_ENCODING",
    "UnmappedSchema": "UNMAPPED_SCHEMA",
}


def literal_name(index: int) -> str:
    return f"__literal_{index}"


def number_name(index: int) -> str:
    return f"__number_{index}"


PARSED_TIME = "__time"


def parsed_columns(mapping: Mapping, layout: RawLayout) -> dict[str, Column]:
    """Values parsed once per row and used by both the checks and the transform."""
    parsed: dict[str, Column] = {}
    stamp = mapping.first_for("timestamp")
    if stamp is not None and layout.has(stamp.vendor_column):
        parsed[PARSED_TIME] = S.parse_time(layout.get(stamp.vendor_column))
    for i, rule in enumerate(mapping.columns):
        if rule.kind in S.NUMERIC_TYPES and layout.has(rule.vendor_column):
            parsed[literal_name(i)] = S.number_text(layout.get(rule.vendor_column))
    return parsed


def number_columns(mapping: Mapping, layout: RawLayout) -> dict[str, Column]:
    """Decimal values of the literals made by :func:`parsed_columns`."""
    return {
        number_name(i): S.number(F.col(literal_name(i)))
        for i, rule in enumerate(mapping.columns)
        if rule.kind in S.NUMERIC_TYPES and layout.has(rule.vendor_column)
    }


def _bound_text(bound: Decimal) -> str:
    text = format(bound, "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


# The wording of the details below is fixed: consumers match it.
def _numeric_checks(i: int, rule: ColumnRule, raw: Column) -> list[tuple]:
    name, value, literal = rule.vendor_column, F.col(number_name(i)), F.col(literal_name(i))
    shown = S.number_display(literal)
    stored = S.numeric_value(literal, rule.kind, rule.unit_conversion)

    def range_detail(words: str) -> Column:
        return F.concat(F.lit(f"Field '{name}' value "), shown, F.lit(f" {words}"))

    low, high = rule.min_value, rule.max_value
    below = S.compares(literal, value, low) < 0 if low is not None else F.lit(False)
    above = S.compares(literal, value, high) > 0 if high is not None else F.lit(False)
    checks = [
        (
            name,
            "NumericParse",
            value.isNull(),
            F.concat(F.lit(f"Field '{name}' value '"), raw, F.lit("' is not a valid number")),
        )
    ]
    if low is not None:
        checks.append((name, "NumericRange", below, range_detail(f"is below minimum {_bound_text(low)}")))
    if high is not None:
        checks.append((name, "NumericRange", ~below & above, range_detail(f"exceeds maximum {_bound_text(high)}")))
    if rule.kind == "decimal":
        checks.append(
            (
                name,
                "NumericRange",
                value.isNotNull() & ~below & ~above & stored.isNull(),
                range_detail("does not fit the stored decimal"),
            )
        )
    return checks


def _plain_checks(rule: ColumnRule, raw: Column, compat: bool) -> list[tuple]:
    """Checks of whole numbers, flags and other times."""
    name = rule.vendor_column
    shown = F.concat(F.lit(f"Field '{name}' value '"), raw, F.lit("'"))
    checks = []
    if rule.kind in ("int", "integer"):
        overflow = S.to_whole(raw, "long").isNotNull() & S.to_whole(raw, "int").isNull()
        checks.append((name, "NumericRange", overflow, F.concat(shown, F.lit(" does not fit a 32-bit integer"))))
    if compat:
        return checks
    bad = None
    if rule.kind in ("int", "integer", "long"):
        bad = S.to_whole(raw, "long").isNull()
    elif rule.kind in ("bool", "boolean"):
        bad = S.to_flag(raw).isNull()
    elif rule.kind == "datetime" and rule.canonical_field.lower() != "timestamp":
        bad = S.parse_time(raw).isNull()
    if bad is not None:
        checks.append((name, "TypeMismatch", bad, F.concat(shown, F.lit(f" is not a valid {rule.kind}"))))
    return checks


def failure_list(mapping: Mapping, layout: RawLayout, compat: bool = True) -> Column:
    """All failures of one row in rule order; NULL when the row is good.

    Details carry no row number; :func:`explode_failures` appends it, so one
    compiled expression serves scans that learn the row number later.
    """
    stamp = mapping.first_for("timestamp")
    required = {name.lower() for name in mapping.required_fields}
    checks: list[tuple] = []
    for name in mapping.required_fields:
        raw = layout.get(name)
        blank = F.lit(True) if raw is None else S.is_blank(raw)
        checks.append((name, "RequiredField", blank, F.lit(f"Required field '{name}' is null or empty")))
    if stamp is not None:
        name, raw = stamp.vendor_column, layout.get(stamp.vendor_column)
        blank = F.lit(True) if raw is None else S.is_blank(raw)
        if name.lower() not in required:
            checks.append((name, "RequiredField", blank, F.lit(f"Timestamp field '{name}' is null or empty")))
        if raw is not None:
            checks.append(
                (
                    name,
                    "NumericParse",
                    ~blank & F.col(PARSED_TIME).isNull(),
                    F.concat(F.lit(f"Timestamp field '{name}' value '"), raw, F.lit("' is not a valid datetime")),
                    REASON_CODES["TimestampParse"],
                )
            )
    for i, rule in enumerate(mapping.columns):
        raw = layout.get(rule.vendor_column)
        if raw is None:
            continue
        if rule.kind in S.NUMERIC_TYPES:
            checks += _numeric_checks(i, rule, raw)
    for rule in mapping.columns:
        raw = layout.get(rule.vendor_column)
        if raw is not None and rule.kind not in S.NUMERIC_TYPES:
            checks += _plain_checks(rule, raw, compat)

    if not checks:
        return F.lit(None).cast(FAILURES_TYPE)
    none = F.array().cast(FAILURES_TYPE)
    parts, any_broken = [], F.lit(False)
    for pos, (name, rule_name, broken, detail, *code) in enumerate(checks):
        broken = F.coalesce(broken, F.lit(False))
        any_broken = any_broken | broken
        failure = F.struct(
            F.lit(pos).alias("pos"),
            F.lit(name).alias("field"),
            F.lit(rule_name).alias("rule"),
            F.lit(code[0] if code else REASON_CODES[rule_name]).alias("code"),
            detail.alias("detail"),
        )
        parts.append(F.when(broken, F.array(failure).cast(FAILURES_TYPE)).otherwise(none))
    # The list is only built for bad rows; good rows cost the tests alone. Concatenation,
    # unlike a filter with a lambda, is compiled with the rest of the projection.
    return F.when(any_broken, F.concat(*parts))


def explode_failures(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per failure of rows that carry ``failures`` and ``row_index``."""
    return (
        rows.filter(F.col("failures").isNotNull())
        .select(*keys, "row_index", F.explode("failures").alias("_f"))
        .select(
            *keys,
            "row_index",
            "_f.pos",
            "_f.field",
            "_f.rule",
            "_f.code",
            F.concat("_f.detail", F.lit(" at row "), F.col("row_index").cast("string"), F.lit(".")).alias("detail"),
        )
    )


def header_failures(headers: DataFrame, mapping_columns: Column | list[str], key: str = "dataset_id") -> DataFrame:
    """Strict header check: one failure per mapped column a header lacks.

    ``headers`` has ``key`` and ``header ARRAY<STRING>``; the failures
    carry row 0 and the position of the column in the mapping.
    """
    wanted = (
        mapping_columns if isinstance(mapping_columns, Column) else F.array(*[F.lit(c) for c in mapping_columns])
    )
    present = F.transform("header", lambda h: F.lower(h))
    return (
        headers.select(key, present.alias("_present"), F.posexplode(wanted).alias("pos", "field"))
        .filter(~F.array_contains("_present", F.lower("field")))
        .select(
            key,
            F.lit(0).cast("bigint").alias("row_index"),
            "pos",
            "field",
            F.lit("UnknownSchema").alias("rule"),
            F.lit(REASON_CODES["UnknownSchema"]).alias("code"),
            F.concat(F.lit("Expected column '"), "field", F.lit("' not found in dataset headers.")).alias("detail"),
        )
    )


def verdicts(rows: DataFrame, key: str = "dataset_id", *more: Column) -> DataFrame:
    """Per ``key``: row count, failure count and whether it may be written; ``more`` aggregates are carried along.

    A failed dataset reports zero passes and counts failures, not rows.
    """
    counted = rows.groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.sum(F.when(F.col("failures").isNotNull(), F.size("failures")).otherwise(0)).alias("fail_count"),
        F.count("failures").alias("bad_rows"),
        *more,
    )
    good = F.col("fail_count") == 0
    known = (key, "row_count", "fail_count", "bad_rows")
    return counted.select(
        key,
        "row_count",
        good.alias("is_success"),
        F.when(good, F.col("row_count")).otherwise(F.lit(0)).alias("pass_count"),
        "fail_count",
        "bad_rows",
        *[c for c in counted.columns if c not in known],
    )


def summary(failures: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Failures and affected rows per ``key`` and rule."""
    return failures.groupBy(key, "rule").agg(
        F.count("*").alias("failures"), F.countDistinct("row_index").alias("failed_rows")
    )


def first_failures(failures: DataFrame, limit: int = FIRST_FAILURES, key: str = "dataset_id") -> DataFrame:
    """The first failures per ``key`` in file and rule order.

    A row-number limit is cut to ``limit`` rows per key in every task before
    the shuffle, so a hot dataset sends a bounded number of rows.
    """
    order = W.partitionBy(key).orderBy("row_index", "pos")
    return failures.withColumn("seq", F.row_number().over(order)).filter(F.col("seq") <= limit)


def failure_report(failures: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Per ``key``: the total and the first failures as an array, for the dead letter.

    Both are made from ``failures``, which should be a written table.
    """
    entry = F.struct(
        F.col("seq"), F.col("row_index").alias("row"), F.col("field"), F.col("rule"), F.col("detail")
    )
    first = first_failures(failures, key=key).groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    total = failures.groupBy(key).agg(F.count("*").alias("fail_count"))
    return total.join(first, key).select(
        key,
        "fail_count",
        F.transform("_list", lambda e: e.dropFields("seq")).alias("failures"),
    )


def accepted_rows(rows: DataFrame) -> DataFrame:
    """Rows of the datasets without any failure.

    Only ids of failed datasets are joined. They are one row per failed dataset
    after a map-side aggregate; Spark broadcasts them when they are small enough
    and otherwise splits skewed partitions of the left side at run time.
    """
    failed = rows.filter(F.col("failures").isNotNull()).select("dataset_id").distinct()
    return rows.join(failed, "dataset_id", "left_anti")


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("failures").isNull())


def bad_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("failures").isNotNull())


def conservation(rows: DataFrame) -> DataFrame:
    """Source rows against silver plus quarantine rows, per dataset."""
    good = F.col("failures").isNull()
    return rows.groupBy("dataset_id").agg(
        F.count("*").alias("source_rows"),
        F.count_if(good).alias("silver_rows"),
        F.count_if(~good).alias("quarantine_rows"),
    )
