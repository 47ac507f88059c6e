"""Wrapped values that nest, at any depth and in any field."""

import json

import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.functions.nested import entries, opened, settled_record, text_of
from logmill.operators.normalize import normalize

CFG = PipelineConfig()


def lists(depth, value):
    for _ in range(depth):
        value = {"arrayValue": {"values": [value]}}
    return value


def pairs(depth, value):
    for _ in range(depth):
        value = {"kvlistValue": {"values": [{"key": "k", "value": value}]}}
    return value


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ({"stringValue": {"arrayValue": 1}}, {"arrayValue": 1}),  # what a scalar wrapper holds stays as it is
        ({"intValue": "5", "arrayValue": {"values": []}}, "5"),
        ({"arrayValue": {}}, []),
        ({"arrayValue": {"values": {"a": 1}}}, []),
        ({"arrayValue": {"values": [None, 1, {"x": {"stringValue": "s"}}]}}, [None, 1, {"x": {"stringValue": "s"}}]),
        ({"kvlistValue": {"values": [{"key": "a", "value": 1}, {"key": "a", "value": 2}, {"key": None, "value": 3}, 4]}}, {"a": 2}),
        ({"kvlistValue": {"values": {"a": {"boolValue": False}}}}, {"a": False}),
        ({"kvlistValue": 7}, {}),
        ([{"stringValue": "s"}], [{"stringValue": "s"}]),
    ],
    ids=str,
)
def test_opened(value, want):
    assert opened(value) == want


def test_texts_of_values():
    assert [text_of(v) for v in (None, "a", True, 3, 1.0, {"b": 1, "a": "é"}, [])] == [None, "a", "true", "3", "1.0", '{"a":"é","b":1}', "[]"]
    assert entries("text") == {} and entries([{"key": 1, "value": {"intValue": "2"}}]) == {"1": "2"}


def test_records_change_only_where_wrappers_nest():
    record = {"body": "plain", "level": {"stringValue": "x"}, "msg": lists(2, 1), "exception": {"type": pairs(1, 2), "other": lists(1, 1)}}
    got = json.loads(settled_record(json.dumps(record), ["body", "level", "msg", "type"], "exception", "attributes"))
    assert got == {"body": "plain", "level": {"stringValue": "x"}, "msg": "[[1]]", "exception": {"type": '{"k":2}', "other": lists(1, 1)}}
    assert settled_record("[1]", ["body"], "exception", "attributes") == "[1]"


@pytest.mark.parametrize("depth", [1, 4, 9, 60])
def test_documents_at_any_depth(messages_of, depth):
    leaf = {"stringValue": "end"}
    record = {
        "timeUnixNano": {"intValue": "1767225600000000000"}, "body": lists(depth, leaf), "severityText": lists(depth, leaf), "traceId": pairs(depth, leaf),
        "exception": {"type": pairs(depth, leaf), "stacktrace": lists(depth, leaf)}, "host.name": pairs(depth, leaf),
        "attributes": [{"key": "deep", "value": lists(depth, leaf)}, {"key": "tenant.id", "value": {"stringValue": "acme"}}],
    }
    bundle = {"resource": {"attributes": [{"key": "service.name", "value": pairs(depth, leaf)}]}, "scopeLogs": [{"logRecords": [record, record]}]}
    in_lists, in_pairs = "[" * depth + '"end"' + "]" * depth, '{"k":' * depth + '"end"' + "}" * depth
    flat = json.dumps({"body": "flat", "serviceName": "s"})
    messages = messages_of([json.dumps({"resourceLogs": [bundle]}), json.dumps({**record, "serviceName": pairs(depth, leaf)}), flat])
    rows = normalize(messages, CFG).orderBy("source.offset").collect()
    for row in rows[:2]:
        assert row.failure is None and row.message == in_lists and row.log.level == in_lists and row.trace.id == in_pairs
        assert row.service.name == in_pairs and row.error.type == in_pairs and row.error.stack_trace == in_lists and row.labels["host.name"] == in_pairs
        assert row.attributes == {"deep": in_lists, "tenant.id": "acme"} and row.event_time.year == 2026
    assert rows[2].message == "flat" and rows[2].service.name == "s"
    every = normalize(messages, CFG.with_(otlp_records="all"))
    assert every.where(F.col("message") == in_lists).count() == 3


def test_only_rows_that_nest_reach_python(messages_of):
    """Records of other rows are not even rendered."""
    rows = normalize(messages_of(['{"body":"a"}', json.dumps({"body": lists(2, 1)})]), CFG)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "CASE WHEN" in plan.split("ArrowEvalPython")[1].split("\n")[0] + plan
    assert sorted(r.message for r in rows.collect()) == ["[[1]]", "a"]
