import hashlib
import json
from datetime import datetime

import pytest

from logmill import PipelineConfig
from logmill.operators.normalize import (
    normalize,
    normalize_flat,
    to_source_json,
)

FLAT = {
    "host.name": "rack-7",
    "body": "shelf restocked",
    "resource": {"attributes": {"region": "north", "service.version": "3.9"}},
    "logger": "stock.Shelf",
    "serviceName": "warehouse",
    "attributes": {"list": {"arrayValue": {"values": [{"intValue": "1"}, {"stringValue": "x"}]}}, "tenant.id": "acme"},
    "spanId": "span-5",
    "traceId": "trace-4",
    "severityText": "INFO",
    "timestamp": "2025-11-03T07:15:30Z",
}
OTLP = {
    "resourceLogs": [
        {
            "resource": {"attributes": [{"key": "service.name", "value": {"stringValue": "pay"}}, {"value": {"stringValue": "no key"}}]},
            "scopeLogs": [
                {"logRecords": []},
                {
                    "logRecords": [
                        {
                            "timeUnixNano": "1779667200000001999",
                            "severityText": "ERROR",
                            "body": {"kvlistValue": {"values": [{"key": "a", "value": {"arrayValue": {"values": [{"boolValue": True}]}}}]}},
                            "attributes": [
                                {"key": "error.type", "value": {"stringValue": "A"}},
                                {"key": "error.type", "value": {"stringValue": "B"}},
                            ],
                        },
                        {"body": {"stringValue": "second"}},
                    ]
                },
            ],
        },
        {"scopeLogs": [{"logRecords": [{"body": {"stringValue": "third"}}]}]},
    ]
}
CASES = [
    (json.dumps(FLAT), {"message": "shelf restocked", "event_time": datetime(2025, 11, 3, 7, 15, 30), "failure": None}),
    (json.dumps(OTLP), {"message": '{"a":[true]}', "event_time": datetime(2026, 5, 25, 0, 0, 0, 1), "failure": None}),
    ("plain text", {"message": "plain text", "event_time": datetime(2026, 1, 1, 0, 0, 2)}),
    ("   ", {"message": ""}),
    ("[1, 2]", {"message": "[1, 2]", "failure": None}),
    ("17", {"message": "17", "failure": None}),
    ("null", {"failure": "payload_is_null"}),
    ('{"a": 1} trailing', {"message": "", "failure": None}),
    ('{"body": "x", "body": "y"}', {"message": "y"}),
    ('{"body": null, "message": "m"}', {"message": "m"}),
    ('{"body": {"stringValue": null, "intValue": 5}, "msg": "no"}', {"message": ""}),
    ('{"body": {"k": [1, {"z": "q"}]}}', {"message": '{"k":[1,{"z":"q"}]}'}),
    ('{"time": 1779667200}', {"event_time": datetime(2026, 5, 25)}),
    ('{"time": 1779667200123}', {"event_time": datetime(2026, 5, 25, 0, 0, 0, 123000)}),
    ('{"time": "1779667200"}', {"event_time": datetime(2026, 5, 25)}),
    ('{"time": 1779667200.9}', {"event_time": datetime(2026, 5, 25)}),
    ('{"time": 1779667200000000}', {"failure": "event_time_out_of_range"}),
    ('{"time": "2026-05-25"}', {"failure": "event_time_unparseable"}),
    ('{"time": "2026-02-30T00:00:00Z"}', {"failure": "event_time_unparseable"}),
    ('{"time": "2026-05-25T02:00:00+02:00"}', {"event_time": datetime(2026, 5, 25)}),
    ('{"time": " ", "@timestamp": "x"}', {"failure": None}),
    ('{"serviceName": " "}', {"service": "unknown-service"}),
    ('{"resource": {"service.name": "r"}, "service": "s"}', {"service": "r"}),
    ('{"resource": {"attributes": []}, "service": "s"}', {"service": "s"}),
    ('{"exception": {"type": "T", "stack_trace": "s"}, "attributes": {"error.type": " "}}', {"error_type": "T"}),
    ('{"resourceLogs": [{"resource": {}}]}', {"message": "", "failure": None}),
    ('{"resourceLogs": [5]}', {"message": "", "failure": None}),
]


@pytest.fixture(scope="module")
def rows(messages_of):
    found = normalize(messages_of([payload for payload, _ in CASES])).collect()
    return {r.source.offset: r for r in found}


@pytest.mark.parametrize("index", range(len(CASES)))
def test_case(rows, index):
    row = rows[index]
    actual = row.asDict() | {
        "service": row.service.name,
        "error_type": row.error.type if row.error else None,
    }
    for name, value in CASES[index][1].items():
        assert actual[name] == value, (CASES[index][0], name)


def test_flat_json_fields(rows):
    row = rows[0]
    assert row.id == "t-0-0"
    assert (row.log.level, row.log.logger) == ("INFO", "stock.Shelf")
    assert (row.service.version, row.service.environment) == ("3.9", "prod")
    assert (row.trace.id, row.span.id, row.tenant.id) == ("trace-4", "span-5", "acme")
    assert row.labels == {"region": "north", "host.name": "rack-7"}
    assert row.attributes["list"] == '["1","x"]'
    assert row.ingest.policy == "normal" and row.ingest.raw_payload == CASES[0][0]


def test_last_duplicate_attribute_wins(rows):
    assert rows[1].attributes == {"error.type": "B"}
    assert rows[1].service.name == "pay"


def test_all_records(messages_of):
    cfg = PipelineConfig(otlp_records="all")
    found = normalize(messages_of([json.dumps(OTLP), "plain"]), cfg).select("id", "message").collect()
    assert sorted(map(tuple, found)) == [
        ("t-0-0", '{"a":[true]}'),
        ("t-0-0-1", "second"),
        ("t-0-0-2", "third"),
        ("t-0-1", "plain"),
    ]


def test_long_message_and_payload(messages_of):
    text = "é" * 30
    cfg = PipelineConfig(max_message_length=10, max_raw_payload_length=20)
    row = normalize(messages_of([text]), cfg).first()
    assert row.message == row.ingest.message_preview == "é" * 10
    assert row.ingest.original_length == 30 and row.ingest.truncated
    assert row.ingest.message_hash == hashlib.sha256(text.encode()).hexdigest()
    assert row.ingest.policy == "truncate-message" and row.ingest.raw_payload is None


def test_hash_id_without_offset(messages_of):
    row = normalize(messages_of(["x"], start_offset=-1)).first()
    assert row.id == "t-" + hashlib.sha256(b"x").hexdigest()


def test_flat_form(messages_of):
    payloads = [json.dumps(FLAT | {"severityNumber": "9"}), '{"severity_number": "high"}', '{"severity_number": 3.7}']
    rows = {r.offset: r for r in normalize_flat(messages_of(payloads)).collect()}
    assert rows[0].bucket == "logs-flat-2025.11.03" and rows[0].severity_number == 9
    assert rows[0].resource["service.version"] == "3.9"
    assert rows[1].failure == "severity_number_unparseable"
    assert rows[2].severity_number == 3 and rows[2].failure is None


def test_serialised_without_nulls(messages_of):
    row = to_source_json(normalize(messages_of(['{"time": 1779667200123, "body": "b"}']))).first()
    source = json.loads(row.source_json)
    assert source["@timestamp"] == "2026-05-25T00:00:00.123Z"
    assert "trace" not in source and "error" not in source
    assert source["ingest"]["ingested_at"].endswith("Z")
    assert source["attributes"] == {} and source["service"] == {"environment": "prod", "name": "unknown-service"}
