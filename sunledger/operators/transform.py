"""Raw text rows to canonical, typed, enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions import scalars as S
from sunledger.functions.plans import evaluated_once
from sunledger.operators import quality as Q
from sunledger.operators.layout import RawLayout
from sunledger.operators.registry import LINEAGE, Mapping


def stored_type(kind: str) -> str:
    return S.STORED_TYPES.get(kind.lower(), "string")


def output_schema(mapping: Mapping, pass_through: list[str] | None = None) -> T.StructType:
    """Stored schema: lineage columns, mapped columns in mapping order, raw text columns."""
    schema = T.StructType()
    for name in LINEAGE:
        schema.add(name, "timestamp" if name in ("timestamp", "ingestion_time") else "string")
    for rule in mapping.columns:
        if rule.canonical_field.lower() not in LINEAGE:
            schema.add(rule.canonical_field, stored_type(rule.kind))
    for name in pass_through or []:
        schema.add(name, "string")
    return schema


def _typed(i: int, mapping: Mapping, layout: RawLayout, ingestion_time: Column, compat: bool) -> Column:
    rule = mapping.columns[i]
    target = stored_type(rule.kind)
    raw = layout.get(rule.vendor_column)
    if raw is None:
        # A pass-through file may carry the canonical name itself, already in stored units.
        same = layout.get(rule.canonical_field) if mapping.pass_through else None
        if same is None:
            return F.lit(None).cast(target)
        literal = S.number_text(same)
        return literal.try_cast(target) if rule.kind in S.NUMERIC_TYPES else same.try_cast(target)
    if rule.kind in S.NUMERIC_TYPES:
        return S.numeric_value(F.col(Q.literal_name(i)), rule.kind, rule.unit_conversion)
    if rule.kind == "datetime":
        moment = S.parse_time(raw)
        return F.coalesce(moment, ingestion_time) if compat else moment
    if rule.kind in ("int", "integer", "long"):
        whole = S.to_whole(raw, rule.kind)
        return F.coalesce(whole, F.lit(0).cast(target)) if compat else whole
    if rule.kind in ("bool", "boolean"):
        flag = S.to_flag(raw)
        return F.coalesce(flag, F.lit(False)) if compat else flag
    return raw


def conform(
    rows: DataFrame,
    mapping: Mapping,
    layout: RawLayout,
    *,
    carry: list[str],
    dataset_id: Column,
    schema_version: Column,
    ingestion_time: Column,
    compat: bool = True,
    site_id: Column | None = None,
) -> DataFrame:
    """Check and convert raw text rows in one pass.

    Output: ``carry`` columns, ``failures`` (NULL for a good row), then the
    stored columns of :func:`output_schema`. Numbers and the timestamp are parsed
    once and used by the checks and the conversion; a filter on ``failures`` uses
    the finished list. No shuffle.
    """
    parsed = rows.withColumns(Q.parsed_columns(mapping, layout))
    parsed = parsed.withColumns(Q.number_columns(mapping, layout))
    checked = evaluated_once(parsed, "failures", Q.failure_list(mapping, layout, compat))

    site_rules = [c for c in mapping.columns if c.canonical_field.lower() == "site_id"]
    site = next((layout.get(c.vendor_column) for c in reversed(site_rules) if layout.has(c.vendor_column)), None)
    if site is None:
        site = site_id if site_id is not None else F.lit("")
    stamp_rules = [c for c in mapping.columns if c.canonical_field.lower() == "timestamp"]
    moment = F.lit(None).cast("timestamp")
    if stamp_rules and layout.has(stamp_rules[0].vendor_column):
        moment = F.col(Q.PARSED_TIME)
    for later in stamp_rules[1:]:
        if layout.has(later.vendor_column):
            moment = S.parse_time(layout.get(later.vendor_column))

    stored = [
        _typed(i, mapping, layout, ingestion_time, compat).alias(rule.canonical_field)
        for i, rule in enumerate(mapping.columns)
        if rule.canonical_field.lower() not in LINEAGE
    ]
    extra = [layout.get(name).alias(stored) for name, stored in layout.stored_names(mapping).items()]
    return checked.select(
        *carry,
        "failures",
        site.alias("site_id"),
        moment.alias("timestamp"),
        ingestion_time.cast("timestamp").alias("ingestion_time"),
        dataset_id.alias("source_dataset_id"),
        schema_version.alias("schema_version"),
        *stored,
        *extra,
    )
