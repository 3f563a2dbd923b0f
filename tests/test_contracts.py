"""Contracts compiled from documents: keywords, the event rules, and bodies that break them."""

import json

import pytest

from sunledger.operators import contracts as C
from sunledger.operators import envelope as E
from tests import helpers as H

ADDRESS = "https://example.test/things.json"


def errors(spark, document, bodies):
    contract = C.Contract({"$id": ADDRESS, **document}, ADDRESS)
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    return [r.e for r in frame.select("i", contract.errors(frame.body).alias("e")).orderBy("i").collect()]


def test_keywords(spark):
    document = {
        "type": "object",
        "required": ["kind", "n"],
        "additionalProperties": False,
        "properties": {
            "kind": {"type": "string", "enum": ["a", "b"]},
            "n": {"type": "integer", "minimum": 1},
            "code": {"$ref": "#/$defs/code"},
            "maybe": {"type": ["string", "null"]},
            "rows": {"type": "array", "items": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number"}}}},
            "open": {"type": "object"},
            "flag": {"type": "boolean"},
        },
        "if": {"properties": {"kind": {"const": "b"}}, "required": ["kind"]},
        "then": {"required": ["code"]},
        "$defs": {"code": {"type": "string", "pattern": "^[a-z]+$", "allOf": [{"not": {"pattern": "^zz"}}]}},
    }
    assert errors(
        spark,
        document,
        [
            {"kind": "a", "n": 1},
            {"kind": "a", "n": 2.0, "maybe": None, "rows": [{"x": 1}, {"x": 1.5, "y": 2}], "open": {"z": 1}, "flag": True},
            {"kind": "c", "n": 0, "more": 1, "other": 2},
            {"kind": "b", "n": 1.5, "maybe": 3},
            {"kind": "b", "n": "1", "code": "zzz", "rows": [{"x": "1"}, {}, {"x": "2"}], "flag": "no"},
            {"kind": "a", "n": 1, "code": "ab\n", "rows": {}, "open": []},
            [1],
            "not json",
        ],
    ) == [
        [],
        [],
        ["additionalProperties: more, other is not allowed", "enum: kind must be one of a, b", "minimum: n must be at least 1"],
        ["required: code is missing", "type: n must be an integer", "type: maybe must be a string or null"],
        [
            "type: n must be an integer", "not: code must not match zz", "type: rows[].x must be a number", "required: rows[].x is missing",
            "type: flag must be a flag",
        ],
        ["pattern: code must match [a-z]+", "type: rows must be an array", "type: open must be an object"],
        ["type: message must be an object"],
        ["json: the text is not readable"],
    ]


def test_documents_are_checked_once():
    for broken in ("no json", "[1]", {"$id": "elsewhere"}, {"$id": ADDRESS, "oneOf": []}, {"$id": ADDRESS, "type": "text"}):
        with pytest.raises(ValueError):
            C.Contract(broken, ADDRESS)
    with pytest.raises(ValueError, match="unknown reference"):
        C.Contract({"$id": ADDRESS, "properties": {"a": {"$ref": "#/$defs/none"}}}, ADDRESS)
    with pytest.raises(Exception):
        C.Contract({"$id": ADDRESS, "pattern": "("}, ADDRESS)


def test_event_rules_come_from_the_document(spark):
    own = C.available_document(E.DEFAULT_DATASCHEMA)
    assert E.EventContract(document=json.dumps(own)).rules == E.EventContract().rules and len(E.EventContract().rules) == 24
    other = json.loads(json.dumps(own))
    other["properties"]["tenant_id"] = {"type": "string", "const": "ops"}
    other["properties"]["traceparent"] = {
        "type": "string", "pattern": "^00-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}$",
        "allOf": [{"not": {"pattern": "^00-0{32}-"}}, {"not": {"pattern": "-0{16}-[0-9a-f]{2}$"}}],
    }
    zero = f"00-{'0' * 32}-{'1' * 16}-01"
    events = [H.event(1, tenant_id="ops"), H.event(2), H.event(3, tenant_id="ops", traceparent=zero), H.event(4, tenant_id="ops", traceparent=f"00-{'1' * 32}-{'0' * 16}-01")]
    frame = spark.createDataFrame([(json.dumps(e), str(i)) for i, e in enumerate(events)], "raw string, event_key string")
    checked = E.check_events(frame, E.EventContract(document=json.dumps(other))).orderBy("event_key").collect()
    assert [len(r.errors) for r in checked] == [0, 1, 1, 1] and checked[1].errors == ["const: tenant_id must be 'ops'"]
    assert all(r.errors[0].startswith("pattern: traceparent") for r in checked[2:])


def test_event_documents_that_cannot_be_used():
    own = C.available_document(E.DEFAULT_DATASCHEMA)
    for change in (
        {"$id": "https://elsewhere.example.org/dataset-available.v1.json"},
        {"required": ["type"]},
        {"additionalProperties": True},
        {"properties": {**own["properties"], "tenant_id": {"type": "boolean"}}},
    ):
        with pytest.raises(ValueError):
            E.EventContract(document=json.dumps({**own, **change}))


def test_both_readings_of_the_event_contract_agree(spark):
    """The rule table of the job and the general compiler find the same events at fault."""
    changes = [{}, {"tenant_id": ""}, {"id": "x"}, {"extra": 1}, {"data__version": 0}, {"data__version": "1"}, {"data__file_size": -1}, {"time": ...}, {"data__new": 2},
               {"data__site_id": 1.5}, {"data": 3}, {"data__file_hash": "0" * 63}, {"specversion": None}]
    texts = [json.dumps(H.event(1, **c)) for c in changes]
    frame = spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)], "raw string, event_key string")
    compiled = C.Contract(C.available_document(E.DEFAULT_DATASCHEMA), E.DEFAULT_DATASCHEMA).errors(frame.raw)
    rows = E.check_events(frame.withColumn("compiled", compiled)).collect()
    assert [sorted(r.errors) == sorted(r.compiled) for r in rows] == [True] * len(changes)
    assert sum(not r.errors for r in rows) == 2
