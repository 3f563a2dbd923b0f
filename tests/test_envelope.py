"""Event envelope: one case per rule, routing order, storage URIs."""

import json

import pytest
from pyspark.sql import functions as F

from sunledger.functions import uris
from sunledger.operators.envelope import EventContract, check_events, latest_per_dataset
from tests.helpers import event


def check(spark, *messages):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return check_events(spark.createDataFrame(rows, "n int, raw string")).orderBy("n").collect()


def test_valid_events(spark):
    a, b, c = check(
        spark,
        event(1),
        event(2, data__device_id="extra", data__storage_path="https://lake.example.org/bronze/x_v1.csv"),
        json.dumps(event(3), indent=2),
    )
    assert (a.reason, b.reason, c.reason) == (None, None, None)
    assert (a.dataset_id, a.site_id, a.version, a.correlation_id) == (
        "1_ac_power", 1, 1, "10000000-0000-4000-8000-000000000001",
    )


BROKEN = {
    "specversion": {"specversion": "1.1"},
    "source": {"source": "/elsewhere"},
    "id": {"id": "ABCDEF00-0000-4000-8000-000000000001"},
    "time": {"time": "2025-11-03T08:15:30"},
    "datacontenttype": {"datacontenttype": "text/plain"},
    "dataschema": {"dataschema": ...},
    "tenant_id": {"tenant_id": ""},
    "source_vendor": {"source_vendor": "OTHER"},
    "schema_version": {"schema_version": "v1\n"},
    "mapping_version": {"mapping_version": "latest"},
    "correlation_id": {"correlation_id": None},
    "ingestion_timestamp": {"ingestion_timestamp": 5},
    "traceparent": {"traceparent": "00-00000000000000000000000000000000-b01dface0ddba110-01"},
    "mapping_hint": {"mapping_hint": "x"},
    "data.site_id": {"data__site_id": 0},
    "data.category": {"data__category": ""},
    "data.file_format": {"data__file_format": "parquet"},
    "data.storage_path": {"data__storage_path": "s3://bronze/x.csv"},
    "data.version": {"data__version": 1.5},
    "data.ingestion_id": {"data__ingestion_id": ...},
    "data.source_url": {"data__source_url": ["x"]},
    "data.file_size": {"data__file_size": -1},
    "data.file_hash": {"data__file_hash": "F" * 64},
    "data": {"data": [1]},
}


def test_each_rule_names_its_attribute(spark):
    rows = check(spark, *[event(1, **change) for change in BROKEN.values()])
    for name, row in zip(BROKEN, rows):
        assert row.reason == "EnvelopeValidationFailed", name
        errors = json.loads(row.payload)["errors"]
        assert len(errors) == 1 and f" {name} " in errors[0], (name, errors)
    zero_parent = check(spark, event(1, traceparent="00-0b57ac1e5eed0000deadbea7f00dcafe-0000000000000000-01"))[0]
    assert "traceparent" in zero_parent.payload


def test_routing_order(spark):
    cases = [
        ("not json", "DeserializationFailed"),
        ("", "DeserializationFailed"),
        ("[]", "DeserializationFailed"),
        ("null", "DeserializationFailed"),
        (json.dumps(event(1)) + " x", "DeserializationFailed"),
        (json.dumps(event(1)) + json.dumps(event(1)), "DeserializationFailed"),
        (json.dumps(event(1)) + "," + json.dumps(event(1)), "DeserializationFailed"),
        (json.dumps(event(1)) + "] ", "DeserializationFailed"),
        (json.dumps(event(1)) + "} ", "DeserializationFailed"),
        ('{"specversion":"1.0"}', "UnrecognizedEventType"),
        (event(1, type=5, tenant_id=""), "UnrecognizedEventType"),
        (event(1, type="solar.pvdaq.dataset.available"), "UnrecognizedEventType"),
        (event(1, data__site_id=31.5), "EnvelopeValidationFailed"),
        (event(1, data__site_id="31"), "EnvelopeValidationFailed"),
        (event(1, data__site_id=31.0), "DeserializationFailed"),
        (event(1, data__site_id=2**64), "DeserializationFailed"),
        (event(1, data__version=2.0, data__file_size=1e3), None),
        (event(1, data__storage_path="http://"), "EnvelopeValidationFailed"),
        (event(1, data__storage_path="http://:80/x"), "InvalidStoragePath"),
        (json.dumps(event(1)).replace('"tenant_id"', '"tenant_id": "", "tenant_id"'), None),
        (json.dumps(event(1)).replace('"tenant_id": "research"', '"tenant_id": "research", "tenant_id": ""'), "EnvelopeValidationFailed"),
    ]
    rows = check(spark, *[c for c, _ in cases])
    assert [r.reason for r in rows] == [expected for _, expected in cases]
    assert json.loads(rows[9].payload) == {
        "error_type": "UnrecognizedEventType",
        "expected_type": "solar.pvdaq.dataset.available.v1",
        "actual_type": None,
    }
    assert json.loads(rows[11].payload)["actual_type"] == "solar.pvdaq.dataset.available"


def test_contract_is_checked_when_it_is_set_up():
    with pytest.raises(ValueError):
        EventContract("https://contracts.example.org/dataset-available.v2.json")


def test_latest_event_counts(spark):
    rows = check_events(
        spark.createDataFrame(
            [
                ("a", json.dumps(event(1, data__version=2))),
                ("b", json.dumps(event(1, data__version=10))),
                ("c", json.dumps(event(1, data__version=10, time="2025-11-02T00:00:00Z"))),
                ("d", json.dumps(event(2))),
            ],
            "event_key string, raw string",
        )
    )
    got = {r.event_key: r.superseded for r in latest_per_dataset(rows).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False}


@pytest.mark.parametrize(
    "uri, container, blob",
    [
        ("http://10.1.2.3:8080/account/raw/plant=north/31_v2.csv", "raw", "plant=north/31_v2.csv"),
        ("https://lake.example.org/raw/plant=north/31_v2.csv", "raw", "plant=north/31_v2.csv"),
        ("http://store:8080/account/raw/plant%3Dnorth/a%20b.csv", "raw", "plant=north/a b.csv"),
        ("http://localhost/account/raw/a+b%2Bc.csv", "raw", "a+b+c.csv"),
        ("http://localhost/account", "", ""),
        ("https://lake.example.org/raw", "raw", ""),
    ],
)
def test_storage_paths(spark, uri, container, blob):
    row = spark.createDataFrame([(uri,)], "u string").select(uris.container(F.col("u")), uris.blob(F.col("u"))).first()
    assert tuple(row) == (container, blob)
