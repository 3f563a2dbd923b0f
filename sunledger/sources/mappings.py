"""The schema registry: a folder of ``{vendor}-{version}.json`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.uris import percent_decode


def _member(name: str, target: str) -> str:
    """Text of one member of the exploded object, whatever its letter case."""
    return f"max(CASE WHEN lower(f.key) = '{name}' THEN try_variant_get(f.value, '$', '{target}') END)"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All mapping files of a folder; the key is the file name."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    name = percent_decode(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.json$", 1))
    return parse_mappings(files.select(name.alias("registry_key"), F.col("value").alias("body")))


def parse_mappings(texts: DataFrame) -> DataFrame:
    """``registry_key`` and JSON ``body`` to rows in the shape of ``registry.REGISTRY_SCHEMA``.

    Property names match in any letter case. A text that is not a JSON object
    gives a row without column mappings.
    """
    keyed = texts.select("registry_key", F.try_parse_json("body").alias("body"))
    return texts.sparkSession.sql(
        f"""
        WITH members AS (
            SELECT k.registry_key, lower(f.key) AS name, f.value
            FROM {{files}} k, LATERAL variant_explode(k.body) f
            WHERE f.key IS NOT NULL
        ),
        settings AS (
            SELECT f.registry_key,
                   max(CASE WHEN f.name = 'delimiter' THEN try_variant_get(f.value, '$', 'string') END) AS delimiter,
                   max(CASE WHEN f.name = 'encoding' THEN try_variant_get(f.value, '$', 'string') END) AS encoding,
                   max(CASE WHEN f.name = 'passthroughunmapped'
                       THEN try_variant_get(f.value, '$', 'boolean') END) AS pass_through_unmapped,
                   max(CASE WHEN f.name = 'requiredfields'
                       THEN try_variant_get(f.value, '$', 'array<string>') END) AS required_fields
            FROM members f GROUP BY f.registry_key
        ),
        entries AS (
            SELECT m.registry_key, e.pos, e.value
            FROM members m, LATERAL variant_explode(m.value) e
            WHERE m.name = 'columnmappings'
        ),
        columns AS (
            SELECT e.registry_key, e.pos,
                   {_member('vendorcolumn', 'string')} AS vendor_column,
                   {_member('canonicalfield', 'string')} AS canonical_field,
                   {_member('datatype', 'string')} AS data_type,
                   {_member('unitconversion', 'string')} AS unit_conversion,
                   {_member('minvalue', 'decimal(30,12)')} AS min_value,
                   {_member('maxvalue', 'decimal(30,12)')} AS max_value
            FROM entries e, LATERAL variant_explode(e.value) f
            GROUP BY e.registry_key, e.pos
        ),
        lists AS (
            SELECT registry_key,
                   transform(sort_array(collect_list(struct(pos, vendor_column, canonical_field, data_type,
                                                            unit_conversion, min_value, max_value))),
                             c -> struct(c.vendor_column, c.canonical_field,
                                         coalesce(c.data_type, '') AS data_type,
                                         c.unit_conversion, c.min_value, c.max_value)) AS column_mappings
            FROM columns GROUP BY registry_key
        )
        SELECT k.registry_key,
               coalesce(s.delimiter, ',') AS delimiter,
               coalesce(s.encoding, 'UTF-8') AS encoding,
               coalesce(s.pass_through_unmapped, false) AS pass_through_unmapped,
               coalesce(s.required_fields, cast(array() AS array<string>)) AS required_fields,
               l.column_mappings
        FROM {{files}} k
        LEFT JOIN settings s ON s.registry_key = k.registry_key
        LEFT JOIN lists l ON l.registry_key = k.registry_key
        """,
        files=keyed,
    )
