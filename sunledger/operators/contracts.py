"""JSON contracts compiled to expressions: one list of violations per message, no code outside the plan.

A contract is a JSON Schema document of the keywords below. It is read and
checked once, when a job is set up; an unknown keyword or another ``$id`` than
the expected one is an error then, not a message later.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

KEYWORDS = frozenset(
    "type const enum pattern minLength minimum required properties additionalProperties items allOf not if then $ref".split()
)
NOTES = frozenset("$schema $id $defs title description examples format default $comment".split())
TYPES = {"string": "a string", "integer": "an integer", "number": "a number", "object": "an object", "array": "an array",
         "boolean": "a flag", "null": "null"}


class Contract:
    """A contract document."""

    def __init__(self, document: str | dict, expected_id: str) -> None:
        try:
            self.document = json.loads(document) if isinstance(document, str) else document
        except json.JSONDecodeError as broken:
            raise ValueError(f"the contract is no JSON: {broken}") from None
        if not isinstance(self.document, dict):
            raise ValueError("the contract is no JSON object")
        if self.document.get("$id") != expected_id:
            raise ValueError(f"the contract has $id {self.document.get('$id')!r}, expected is {expected_id!r}")
        self._verify(self.document)

    def resolve(self, schema: dict) -> dict:
        """``schema`` with the definition it refers to; its own members come first."""
        if "$ref" not in schema:
            return schema
        prefix, _, name = schema["$ref"].rpartition("/")
        known = self.document.get("$defs", {})
        if prefix != "#/$defs" or name not in known:
            raise ValueError(f"unknown reference {schema['$ref']!r}")
        return {**self.resolve(known[name]), **{k: v for k, v in schema.items() if k != "$ref"}}

    def _verify(self, schema: dict) -> None:
        schema = self.resolve(schema)
        unknown = set(schema) - KEYWORDS - NOTES
        if unknown:
            raise ValueError(f"keywords that are not known: {', '.join(sorted(unknown))}")
        for kind in _kinds(schema):
            if kind not in TYPES:
                raise ValueError(f"unknown type {kind!r}")
        if "pattern" in schema:
            re.compile(schema["pattern"])
        inner = [*schema.get("properties", {}).values(), *schema.get("allOf", [])]
        inner += [schema[k] for k in ("items", "not", "if", "then") if k in schema]
        for s in [*inner, *(schema.get("$defs", {}).values())]:
            self._verify(s)

    def errors(self, raw: Column) -> Column:
        """All violations of a JSON text; one entry when it is no JSON at all."""
        document = F.try_parse_json(raw)
        found = _listed(self._value(self.document, document, "", F.json_object_keys(raw)))
        return F.when(document.isNull(), F.array(F.lit("json: the text is not readable"))).otherwise(found)

    def _value(self, schema: dict, value: Column, name: str, keys: Column | None = None) -> list[Column]:
        """Violations of a present value, as lists of texts."""
        schema = self.resolve(schema)
        kind = F.schema_of_variant(value)
        text = F.try_variant_get(value, "$", "string")
        shown = name or "message"
        checks: list[Column] = []
        kinds = _kinds(schema)
        right = _is_any(kind, text, kinds)
        if kinds:
            checks.append(_one(~right, f"type: {shown} must be {' or '.join(TYPES[k] for k in kinds)}"))
        is_text = kind == "STRING"
        if "const" in schema:
            checks.append(_one(is_text & (text != F.lit(schema["const"])), f"const: {shown} must be '{schema['const']}'"))
        if "enum" in schema:
            checks.append(_one(is_text & ~text.isin(*schema["enum"]), f"enum: {shown} must be one of {', '.join(schema['enum'])}"))
        if "pattern" in schema:
            checks.append(_one(is_text & ~text.rlike(java_pattern(schema["pattern"])), f"pattern: {shown} must match {bare(schema['pattern'])}"))
        if "minLength" in schema:
            checks.append(_one(is_text & (F.length(text) < schema["minLength"]), f"minLength: {shown} must not be empty"))
        if "minimum" in schema:
            number = text.try_cast("double")
            checks.append(_one(~is_text & (number < schema["minimum"]), f"minimum: {shown} must be at least {schema['minimum']}"))
        if "not" in schema:
            held = F.size(_listed(self._value(schema["not"], value, name))) == 0
            checks.append(_one(held, f"not: {shown} must not match {bare(schema['not'].get('pattern', ''))}"))
        for part in schema.get("allOf", []):
            checks += self._value(part, value, name)
        if "if" in schema:
            meets = F.size(_listed(self._value(schema["if"], value, name))) == 0
            then = _listed(self._value(schema.get("then", {}), value, name))
            checks.append(F.when(meets, then).otherwise(_none()))
        checks += self._members(schema, value, kind, name, keys)
        if "items" in schema:
            each = F.transform(
                F.try_variant_get(value, "$", "array<variant>"), lambda v: _listed(self._value(schema["items"], v, f"{shown}[]"))
            )
            checks.append(F.coalesce(F.array_distinct(F.flatten(each)), _none()))
        return checks

    def _members(self, schema: dict, value: Column, kind: Column, name: str, keys: Column | None) -> list[Column]:
        is_object, path = kind.startswith("OBJECT"), lambda m: f"{name}.{m}" if name else m
        member = lambda m: F.try_variant_get(value, f"$.{m}", "variant")
        checks = [
            _one(is_object & F.schema_of_variant(member(m)).isNull(), f"required: {path(m)} is missing") for m in schema.get("required", [])
        ]
        if schema.get("additionalProperties") is False:
            keys = keys if keys is not None else F.json_object_keys(F.to_json(value))
            known = F.array(*[F.lit(m) for m in schema.get("properties", {})])
            unknown = F.when(is_object, F.array_except(keys, known))
            message = F.concat(F.lit("additionalProperties: "), F.array_join(unknown, ", "), F.lit(" is not allowed"))
            checks.append(F.when(F.size(unknown) > 0, F.array(message)).otherwise(_none()))
        for m, inner in schema.get("properties", {}).items():
            found = _listed(self._value(inner, member(m), path(m)))
            checks.append(F.when(is_object & F.schema_of_variant(member(m)).isNotNull(), found).otherwise(_none()))
        return checks


def _kinds(schema: dict) -> list[str]:
    kinds = schema.get("type", [])
    return [kinds] if isinstance(kinds, str) else list(kinds)


def _none() -> Column:
    return F.array().cast("array<string>")


def _one(broken: Column, message: str) -> Column:
    return F.when(broken, F.array(F.lit(message))).otherwise(_none())


def _listed(checks: list[Column]) -> Column:
    return F.concat(*checks) if checks else _none()


def whole_number(kind: Column, text: Column) -> Column:
    """Whether a JSON number has no fraction, however it is written."""
    value = text.try_cast("double")
    return (kind == "BIGINT") | kind.rlike(r"^DECIMAL\([0-9]+,0\)$") | (((kind == "DOUBLE") | kind.startswith("DECIMAL")) & (value == F.floor(value)))


def _is(kind: Column, text: Column, name: str) -> Column:
    return {
        "string": kind == "STRING",
        "integer": whole_number(kind, text),
        "number": kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
        "object": kind.startswith("OBJECT"),
        "array": kind.startswith("ARRAY"),
        "boolean": kind == "BOOLEAN",
        "null": kind == "VOID",
    }[name]


def _is_any(kind: Column, text: Column, names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [_is(kind, text, n) for n in names]) if names else F.lit(True)


def bare(pattern: str) -> str:
    """A pattern without its anchors, as messages show it."""
    return pattern.removeprefix("^").removesuffix("$")


def java_pattern(pattern: str) -> str:
    """A contract's pattern for the JVM, where ``$`` would also match before a last line break."""
    return pattern.removesuffix("$") + r"\z" if pattern.endswith("$") and not pattern.endswith(r"\$") else pattern


def whole_pattern(schema: dict) -> str:
    """The pattern of a text with the patterns it must not match, as one that covers the whole text."""
    refused = [part["not"]["pattern"] for part in schema.get("allOf", []) if "pattern" in part.get("not", {})]
    ahead = "".join(f"(?!{p.removeprefix('^')})" if p.startswith("^") else f"(?!.*{p})" for p in refused)
    return ahead + bare(schema["pattern"])


# --- contracts of the messages this engine reads and writes; all members below are fixed values -------------

UUID = {"type": "string", "pattern": "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"}
MOMENT = {
    "type": "string",
    "pattern": "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$",
}
TRACE = {"type": "string", "pattern": "^00-(?!0{32}-)[0-9a-f]{32}-(?!0{16}-)[0-9a-f]{16}-[0-9a-f]{2}$"}
BLOB_URI = {"type": "string", "pattern": "^https?://[^ ]+$"}
VERSION_TAG = {"type": "string", "pattern": "^v[0-9]+$"}
MAPPING_TAG = {"type": "string", "pattern": "^(v[0-9]+|unknown)$"}
REASON = {"type": "string", "pattern": "^[A-Z][A-Z0-9_]{2,63}$"}
FILLED = {"type": "string", "minLength": 1}
TEXT = {"type": "string"}


def _exactly(value: str) -> dict:
    return {"type": "string", "const": value}


def _at_least(least: int) -> dict:
    return {"type": "integer", "minimum": least}


def _object(members: dict, required: list[str] | None = None, closed: bool = True) -> dict:
    return {
        "type": "object",
        "required": list(members) if required is None else required,
        "additionalProperties": not closed,
        "properties": members,
    }


def available_document(address: str) -> dict:
    """The contract of dataset-available events, published at ``address``."""
    data = {
        "site_id": _at_least(1), "category": FILLED, "file_format": _exactly("csv"), "storage_path": BLOB_URI,
        "version": _at_least(1), "ingestion_id": {"$ref": "#/$defs/uuid"}, "source_url": FILLED, "file_size": _at_least(0),
        "file_hash": {"type": "string", "pattern": "^[0-9a-f]{64}$"},
    }
    envelope = {
        "specversion": _exactly("1.0"), "type": _exactly("solar.pvdaq.dataset.available.v1"),
        "source": _exactly("/energy-ingestion-boundary/pvdaq"), "id": {"$ref": "#/$defs/uuid"}, "time": {"$ref": "#/$defs/moment"},
        "datacontenttype": _exactly("application/json"), "dataschema": _exactly(address), "tenant_id": FILLED,
        "source_vendor": _exactly("PVDAQ"), "schema_version": VERSION_TAG, "mapping_version": MAPPING_TAG,
        "correlation_id": {"$ref": "#/$defs/uuid"}, "ingestion_timestamp": {"$ref": "#/$defs/moment"}, "traceparent": TRACE,
        "data": _object(data, closed=False),
    }
    return {"$id": address, **_object(envelope), "$defs": {"uuid": UUID, "moment": MOMENT}}


def validated_document(address: str) -> dict:
    """The contract of dataset-validated events, published at ``address``."""
    data = {"dataset_id": FILLED, "record_count": _at_least(0), "silver_path": BLOB_URI}
    envelope = {
        "specversion": _exactly("1.0"), "type": _exactly("solar.pvdaq.dataset.validated.v1"),
        "source": _exactly("/dataset-processing/pvdaq"), "id": UUID, "time": MOMENT, "datacontenttype": _exactly("application/json"),
        "dataschema": _exactly(address), "source_vendor": _exactly("PVDAQ"), "schema_version": VERSION_TAG, "correlation_id": UUID,
        "traceparent": TRACE, "data": _object(data, closed=False),
    }
    return {"$id": address, **_object(envelope)}


def quarantine_document(address: str) -> dict:
    """The contract of quarantine records, published at ``address``."""
    source = {
        "source_vendor": FILLED, "site_id": _at_least(1), "device_id": {"type": ["string", "null"]}, "category": FILLED,
        "source_uri": FILLED, "version": _at_least(1),
    }
    row = {"row_index": _at_least(0), "reason_code": REASON, "field": TEXT, "rule": TEXT, "detail": TEXT}
    record = {
        "reason_code": REASON, "scope": {"type": "string", "enum": ["row", "file"]}, "quarantined_at": MOMENT,
        "quarantined_by": {"type": "string", "enum": ["ingestion-func", "processing-func"]}, "correlation_id": UUID,
        "traceparent": TRACE, "schema_version": VERSION_TAG, "mapping_version": MAPPING_TAG, "record_count": _at_least(1),
        "data_path": BLOB_URI, "source": _object(source), "rows": {"type": "array", "items": _object(row, ["row_index", "reason_code"])},
        "detail": {"type": "object", "additionalProperties": True},
    }
    required = ["reason_code", "scope", "quarantined_at", "quarantined_by", "correlation_id", "traceparent", "source"]
    return {
        "$id": address, **_object(record, required),
        "if": {"properties": {"scope": {"const": "row"}}, "required": ["scope"]}, "then": {"required": ["record_count"]},
    }
