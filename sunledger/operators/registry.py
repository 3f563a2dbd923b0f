"""Vendor schema mappings: model, sanity rules, lookup, contract lint."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

REGISTRY_SCHEMA = """
    registry_key STRING,
    delimiter STRING,
    encoding STRING,
    pass_through_unmapped BOOLEAN,
    required_fields ARRAY<STRING>,
    column_mappings ARRAY<STRUCT<
        vendor_column: STRING, canonical_field: STRING, data_type: STRING,
        unit_conversion: STRING, min_value: DECIMAL(30,12), max_value: DECIMAL(30,12)>>
"""

# The five lineage columns every output row starts with.
LINEAGE = ("site_id", "timestamp", "ingestion_time", "source_dataset_id", "schema_version")

# What the mapping contract admits.
DELIMITERS = (",", ";", "\t")
ENCODINGS = ("UTF-8",)
DATA_TYPES = ("string", "decimal", "datetime", "int", "integer", "long", "bool", "boolean", "double", "float")
UNIT_CONVERSIONS = ("kw_to_w", "mw_to_w", "kwh_to_wh", "mwh_to_wh")


@dataclass(frozen=True)
class ColumnRule:
    vendor_column: str
    canonical_field: str
    data_type: str = "string"
    unit_conversion: str | None = None
    min_value: Decimal | None = None
    max_value: Decimal | None = None

    @property
    def kind(self) -> str:
        return self.data_type.lower()


@dataclass(frozen=True)
class Mapping:
    """One vendor schema mapping, as the driver compiles it into expressions."""

    columns: tuple[ColumnRule, ...]
    required_fields: tuple[str, ...] = ()
    pass_through: bool = False
    delimiter: str = ","
    registry_key: str = ""

    @staticmethod
    def from_row(row: Row) -> Mapping:
        return Mapping(
            columns=tuple(ColumnRule(**m.asDict()) for m in row.column_mappings),
            required_fields=tuple(row.required_fields),
            pass_through=row.pass_through_unmapped,
            delimiter=row.delimiter,
            registry_key=row.registry_key,
        )

    def first_for(self, canonical: str) -> ColumnRule | None:
        return next((c for c in self.columns if c.canonical_field.lower() == canonical), None)


def _maps(canonical: str) -> Column:
    return F.exists("column_mappings", lambda m: F.lower(m.canonical_field) == canonical)


def with_problem(registry: DataFrame) -> DataFrame:
    """Add ``problem``: why a mapping cannot be used, NULL when it can."""
    own = F.transform("column_mappings", lambda m: F.lower(m.canonical_field))
    stored = F.filter(own, lambda name: ~name.isin(*LINEAGE))
    return registry.withColumn(
        "problem",
        F.when(F.col("column_mappings").isNull(), "mapping is not readable")
        .when(~_maps("timestamp"), "no mapping for timestamp")
        .when(~F.col("pass_through_unmapped") & ~_maps("site_id"), "no mapping for site_id")
        .when(F.exists("column_mappings", lambda m: m.min_value > m.max_value), "min_value exceeds max_value")
        .when(F.size(F.array_distinct(stored)) < F.size(stored), "canonical field is mapped twice"),
    )


def registry_key(vendor: Column, version: Column) -> Column:
    return F.concat_ws("-", vendor, version)


def resolve(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Look every event's mapping up; ``problem`` is NULL when it is usable.

    The registry holds one row per vendor format, not per dataset. Spark
    broadcasts it when its size is below the broadcast threshold and falls back
    to a shuffle join above it.
    """
    keyed = with_problem(registry).withColumn("_known", F.lit(True))
    return (
        events.withColumn("registry_key", registry_key(F.col("source_vendor"), F.col("schema_version")))
        .join(keyed, "registry_key", "left")
        .withColumn("problem", F.when(F.col("_known").isNull(), "no such mapping").otherwise(F.col("problem")))
        .drop("_known")
    )


def lint(registry: DataFrame) -> DataFrame:
    """Contract findings, one row per mapping (and column); a report, never a reject."""
    of_mapping = F.array_compact(
        F.array(
            F.when(~F.col("delimiter").isin(*DELIMITERS), F.lit("delimiter")),
            F.when(~F.col("encoding").isin(*ENCODINGS), F.lit("encoding")),
            F.when(F.size("column_mappings") < 1, F.lit("no_columns")),
        )
    )

    def of_column(m: Column) -> Column:
        found = F.array_compact(
            F.array(
                F.when(F.coalesce(m.vendor_column, F.lit("")) == "", F.lit("vendor_column")),
                F.when(F.coalesce(m.canonical_field, F.lit("")) == "", F.lit("canonical_field")),
                F.when(~F.coalesce(m.data_type, F.lit("")).isin(*DATA_TYPES), F.lit("data_type")),
                F.when(~m.unit_conversion.isin(*UNIT_CONVERSIONS), F.lit("unit_conversion")),
                F.when(m.min_value > m.max_value, F.lit("bounds")),
            )
        )
        return F.transform(found, lambda f: F.struct(m.vendor_column.alias("vendor_column"), f.alias("finding")))

    findings = F.concat(
        F.transform(of_mapping, lambda f: F.struct(F.lit(None).cast("string").alias("vendor_column"), f.alias("finding"))),
        F.flatten(F.transform("column_mappings", of_column)),
    )
    return registry.select("registry_key", F.explode(findings).alias("_f")).select(
        "registry_key", "_f.vendor_column", "_f.finding"
    )
