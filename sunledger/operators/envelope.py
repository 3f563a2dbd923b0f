"""Checks an incoming dataset-available event and projects it to typed columns.

Input: a DataFrame with a ``raw`` STRING column, one JSON event per row; other
columns are carried along. The whole check is one narrow projection per row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import uris
from sunledger.functions.outgoing import content_id
from sunledger.functions.plans import evaluated_once
from sunledger.operators import contracts

# Fixed values of the event contract that the job itself needs.
EXPECTED_TYPE = "solar.pvdaq.dataset.available.v1"
SPEC_VERSION = "1.0"
PRODUCER = "/energy-ingestion-boundary/pvdaq"
CONTENT_TYPE = "application/json"
VENDOR = "PVDAQ"
FILE_FORMAT = "csv"

# Where the contract of this deployment is published; the ``dataschema``
# attribute of every event must name exactly this address.
DEFAULT_DATASCHEMA = "https://contracts.example.org/dataset-available.v1.json"


@dataclass(frozen=True)
class Rule:
    """One attribute of the envelope and the single constraint on its value."""

    attribute: str
    keyword: str  # const | pattern | minLength | minimum | object
    operand: str | int | None = None


@dataclass(frozen=True)
class EventContract:
    """The rule table of events, compiled once from the contract document when a job is set up.

    ``document`` is the JSON text of the contract published at ``dataschema``;
    without one the engine's own document is taken.
    """

    dataschema: str = DEFAULT_DATASCHEMA
    document: str | None = None
    rules: tuple[Rule, ...] = field(init=False, compare=False)

    def __post_init__(self) -> None:
        if not re.fullmatch(r"https?://\S+/dataset-available\.v1\.json", self.dataschema):
            raise ValueError(f"not an address of the dataset-available.v1 contract: {self.dataschema!r}")
        contract = contracts.Contract(self.document or contracts.available_document(self.dataschema), self.dataschema)
        object.__setattr__(self, "rules", tuple(event_rules(contract)))


def event_rules(contract: contracts.Contract) -> list[Rule]:
    """The rules of an envelope whose member ``data`` is the only one with members of its own.

    The envelope must be closed and require all its members, ``data`` must be
    open and require all of its own, as the check of events relies on it.
    """
    root = contract.document
    data = contract.resolve(root["properties"].get("data", {}))
    for schema, closed in ((root, True), (data, False)):
        if set(schema.get("required", [])) != set(schema.get("properties", {})):
            raise ValueError("the contract of events requires all attributes it names")
        if (schema.get("additionalProperties", True) is False) != closed:
            raise ValueError("the contract of events is closed around an open data member")
    outer = {name: contract.resolve(s) for name, s in root["properties"].items()}
    inner = {f"data.{name}": contract.resolve(s) for name, s in data["properties"].items()}
    return [_rule(name, schema) for name, schema in {**outer, **inner}.items()]


def _rule(name: str, schema: dict) -> Rule:
    kind = schema.get("type")
    if kind == "object":
        return Rule(name, "object")
    if kind == "integer" and "minimum" in schema:
        return Rule(name, "minimum", schema["minimum"])
    if kind == "string" and "pattern" in schema:
        return Rule(name, "pattern", contracts.whole_pattern(schema))
    for keyword in ("const", "minLength"):
        if kind == "string" and keyword in schema:
            return Rule(name, keyword, schema[keyword])
    raise ValueError(f"the contract of events has no rule for {name}")


def _field(attribute: str, part: str) -> Column:
    return F.col("fields")[attribute.replace(".", "_")][part]


def _kind(attribute: str) -> Column:
    """Type name of one attribute: NULL when missing, VOID for JSON null."""
    return _field(attribute, "kind")


def _text(attribute: str) -> Column:
    """An attribute as text; numbers as they are spelled by Spark."""
    return _field(attribute, "text")


def attribute_fields(document: Column, contract: EventContract) -> Column:
    """Type name and text of every attribute the contract knows, read once."""
    fields = []
    for rule in contract.rules:
        path = f"$.{rule.attribute}"
        kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
        text = F.lit(None).cast("string") if rule.keyword == "object" else F.try_variant_get(document, path, "string")
        fields.append(F.struct(kind.alias("kind"), text.alias("text")).alias(rule.attribute.replace(".", "_")))
    return F.struct(*fields)


def _violation(rule: Rule) -> Column:
    """Error text when a present attribute breaks its rule, else NULL."""
    kind, text, name = _kind(rule.attribute), _text(rule.attribute), rule.attribute
    if rule.keyword == "object":
        return F.when(~kind.startswith("OBJECT"), F.lit(f"type: {name} must be an object"))
    if rule.keyword == "minimum":
        value = text.try_cast("double")
        return F.when(~contracts.whole_number(kind, text), F.lit(f"type: {name} must be an integer")).when(
            value < F.lit(rule.operand), F.lit(f"minimum: {name} must be at least {rule.operand}")
        )
    checks = {
        "const": (text != F.lit(rule.operand), f"const: {name} must be '{rule.operand}'"),
        "pattern": (~text.rlike(rf"^{rule.operand}\z"), f"pattern: {name} must match {rule.operand}"),
        "minLength": (F.length(text) < F.lit(rule.operand), f"minLength: {name} must not be empty"),
    }
    broken, message = checks[rule.keyword]
    return F.when(kind != "STRING", F.lit(f"type: {name} must be a string")).when(broken, F.lit(message))


def envelope_errors(raw: Column, contract: EventContract) -> Column:
    """All contract violations of one well-formed event, in contract order."""

    def listed(message: Column) -> Column:
        return F.when(message.isNotNull(), F.array(message)).otherwise(F.array().cast("array<string>"))

    def absent(rule: Rule) -> Column:
        gone = _kind(rule.attribute).isNull()
        if "." in rule.attribute:
            # Members of a missing or non-object ``data`` are not reported one by one.
            gone = gone & _kind("data").startswith("OBJECT")
        return F.when(gone, F.lit(f"required: {rule.attribute} is missing"))

    outer = [r for r in contract.rules if "." not in r.attribute]
    inner = [r for r in contract.rules if "." in r.attribute]
    unknown = F.array_except(F.json_object_keys(raw), F.array(*[F.lit(r.attribute) for r in outer]))
    extra = F.concat(F.lit("additionalProperties: "), F.array_join(unknown, ", "), F.lit(" is not allowed"))
    return F.concat(
        *[listed(absent(r)) for r in outer + inner],
        listed(F.when(F.size(unknown) > 0, extra)),
        *[listed(_violation(r)) for r in contract.rules],
    )


def parse_events(events: DataFrame) -> DataFrame:
    """Add ``document`` VARIANT: the event when ``raw`` is exactly one JSON object, else NULL.

    Spark's JSON parser stops after the first value; as the element of an array
    any trailing text becomes an error. Only text that could close that array
    by itself is also tried as the member of an object.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("raw"), F.lit("]")))
    nested = F.try_parse_json(F.concat(F.lit('{"event":'), F.col("raw"), F.lit("}")))
    only = F.try_variant_get(F.col("_listed"), "$[0]", "variant")
    second = F.try_variant_get(F.col("_listed"), "$[1]", "variant")
    parsed = evaluated_once(events, "_listed", listed)
    closes_array = F.col("raw").rlike(r"[}]\s*\]")
    alone = second.isNull() & F.when(closes_array, nested.isNotNull()).otherwise(True)
    document = F.when(alone & F.schema_of_variant(only).startswith("OBJECT"), only)
    return evaluated_once(parsed, "document", document).drop("_listed")


def check_events(events: DataFrame, contract: EventContract | None = None) -> DataFrame:
    """Typed event columns plus ``reason``/``payload`` of the first check that fails.

    Order of the checks: well-formed JSON object, event type, envelope contract,
    typed projection, absolute storage URI. ``reason`` is NULL for a good event.
    """
    contract = contract or EventContract()
    given = events.columns
    read = evaluated_once(parse_events(events), "fields", attribute_fields(F.col("document"), contract))
    actual = F.when(_kind("type") == "STRING", _text("type"))
    well_formed = F.col("document").isNotNull()
    typed = evaluated_once(
        read.select(*given, "fields", well_formed.alias("well_formed"), actual.alias("actual_type")),
        "errors",
        F.when(
            F.col("well_formed") & F.col("actual_type").eqNullSafe(F.lit(EXPECTED_TYPE)),
            envelope_errors(F.col("raw"), contract),
        ),
    )
    site = F.when(_kind("data.site_id") == "BIGINT", _text("data.site_id").try_cast("bigint"))
    category, path = _text("data.category"), _text("data.storage_path")
    projected = typed.select(
        *given,
        "well_formed",
        "actual_type",
        "errors",
        _text("id").alias("event_id"),
        F.try_to_timestamp(_text("time")).alias("event_time"),
        _text("source_vendor").alias("source_vendor"),
        _text("schema_version").alias("schema_version"),
        _text("mapping_version").alias("mapping_version"),
        _text("traceparent").alias("traceparent"),
        F.coalesce(F.nullif(F.trim(_text("correlation_id")), F.lit("")), content_id(F.col("raw"))).alias("correlation_id"),
        site.alias("site_id"),
        category.alias("category"),
        path.alias("storage_path"),
        F.coalesce(_text("data.version").try_cast("bigint"), _text("data.version").try_cast("double").try_cast("bigint")).alias("version"),
        F.coalesce(_text("data.file_size").try_cast("bigint"), _text("data.file_size").try_cast("double").try_cast("bigint")).alias("file_size"),
        F.when(site.isNotNull(), F.concat_ws("_", site, category)).alias("dataset_id"),
    )
    error_type = lambda name: F.lit(name).alias("error_type")
    reason = (
        F.when(~F.col("well_formed"), "DeserializationFailed")
        .when(~F.col("actual_type").eqNullSafe(F.lit(EXPECTED_TYPE)), "UnrecognizedEventType")
        .when(F.size("errors") > 0, "EnvelopeValidationFailed")
        .when(F.col("site_id").isNull(), "DeserializationFailed")
        .when(~uris.is_absolute(F.col("storage_path")), "InvalidStoragePath")
    )
    keep_nulls = {"ignoreNullFields": "false"}
    payload = (
        F.when(~F.col("well_formed"), F.lit("The message body is not one JSON object."))
        .when(
            F.col("reason") == "UnrecognizedEventType",
            F.to_json(
                F.struct(error_type("UnrecognizedEventType"), F.lit(EXPECTED_TYPE).alias("expected_type"), "actual_type"),
                keep_nulls,
            ),
        )
        .when(
            F.col("reason") == "EnvelopeValidationFailed",
            F.to_json(F.struct(error_type("EnvelopeValidationFailed"), "errors")),
        )
        .when(
            F.col("reason") == "DeserializationFailed",
            F.lit("data.site_id is not a 64-bit integer literal."),
        )
        .when(
            F.col("reason") == "InvalidStoragePath",
            F.concat(F.lit("storage_path is not a valid absolute URI: "), F.col("storage_path")),
        )
    )
    return projected.withColumn("reason", reason).withColumn("payload", payload).drop("well_formed")


def latest_per_dataset(events: DataFrame) -> DataFrame:
    """Mark the event that counts per dataset: highest version, then latest time.

    Adds ``superseded``. A partial aggregate per task reduces even one hot
    dataset to a single row before the shuffle.
    """
    order = F.struct("version", "event_time", "event_id", "event_key")
    winners = (
        events.groupBy("dataset_id")
        .agg(F.max(order).alias("_top"))
        .select(F.col("_top.event_key").alias("event_key"), F.lit(False).alias("superseded"))
    )
    return events.join(winners, "event_key", "left").withColumn(
        "superseded", F.coalesce("superseded", F.lit(True))
    )
