"""Filters, classification, retention and text rules."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.functions.text import first_line, stream_part, template
from logmill.operators import filters, retention
from logmill.operators.classify import class_patterns, retention_class, retention_policy
from logmill.operators.fingerprint import fingerprint_text
from logmill.operators.normalize import normalize
from logmill.plans.ingest import prepare


def routed(messages_of, payloads, **changes):
    cfg = PipelineConfig(debug_sample_rate=1.0, **changes)
    return {r.source.offset: r for r in prepare(messages_of([json.dumps(p) for p in payloads]), cfg).collect()}


def test_routing(messages_of):
    rows = routed(
        messages_of,
        [
            {"serviceName": "ticket-desk", "exception": {"type": "E", "message": "m", "stacktrace": "s"}},
            {"serviceName": "front-door", "attributes": {"http.request.method": "GET"}, "level": "ERROR"},
            {"serviceName": "parcel-desk", "level": "debug"},
            {"serviceName": "x", "attributes": {"audit.action": "a", "url.path": "/p"}},
            {"serviceName": "A  b//C", "attributes": {"tenantId": "T_1"}},
            {"serviceName": "--", "attributes": {"tenant.id": "!!"}},
            {"attributes": {"url.path": "/actuator/health"}},
            {"level": "Fatal"},
        ],
    )
    assert {k: r.data_stream for k, r in rows.items()} == {
        0: "logs-ticket-desk-error-prod",
        1: "logs-front-door-access-prod",
        2: "logs-parcel-desk-debug-prod",
        3: "logs-audit-prod",
        4: "logs-a-b-c-t_1",
        5: "logs-application-application",
        7: "logs-unknown-service-error-prod",
    }
    assert [rows[i].retention for i in range(5)] == ["ERROR", "SHORT", "SHORT", "AUDIT", "DEFAULT"]
    assert rows[1].event.type == ["access"] and rows[0].event.hash


def test_redaction(messages_of):
    row = routed(
        messages_of,
        [{"attributes": {"userPassword": "p", "X-Token": None, "plain": "v"}}],
        redact_raw_payload=True,
    )[0]
    assert row.attributes == {
        "userPassword": "sha256:" + hashlib.sha256(b"p").hexdigest(),
        "X-Token": None,
        "plain": "v",
    }
    assert row.ingest.raw_payload is None


def test_sampling_follows_the_id(messages_of):
    documents = normalize(messages_of([json.dumps({"level": "TRACE", "body": str(i)}) for i in range(300)]))
    kept = lambda rate: {r.id for r in documents.where(filters.should_keep(PipelineConfig(debug_sample_rate=rate))).select("id").collect()}
    some = kept(0.3)
    assert kept(0.0) == set() and len(kept(1.0)) == 300
    assert 40 < len(some) < 140 and some == kept(0.3) and some <= kept(0.6)


def test_retention_tables(spark):
    rows = spark.createDataFrame([("ACCESS",), ("AUDIT",), ("SECURITY",), ("SLOW_LOG",), (None,)], "c string")
    got = rows.select(retention_class(F.col("c")), retention_policy(retention_class(F.col("c")))).collect()
    assert [tuple(r) for r in got] == [
        ("SHORT", "short-policy"),
        ("AUDIT", "audit-policy"),
        ("AUDIT", "audit-policy"),
        ("DEFAULT", "default-policy"),
        ("DEFAULT", "default-policy"),
    ]
    assert spark.range(1).select(class_patterns(F.lit("SHORT"))).first()[0] == ["logs-*-access-*", "logs-*-debug-*"]


def test_best_pattern_wins(spark):
    cfg = PipelineConfig()
    names = ["logs-audit-error-x", "logs-front-door-error-prod", "logs-aggregate-metrics-t", "logs-a-debug-p", "logs-a-p", "other"]
    streams = spark.createDataFrame([(n,) for n in names], "data_stream string")
    by_rule = dict(streams.select("data_stream", retention.rule_column(F.col("data_stream"), cfg)).collect())
    assert [by_rule[n] for n in names] == [
        "audit-policy", "error-policy", "aggregate-policy", "short-policy", "default-policy", None,
    ]
    table = retention.match_rules(streams, retention.rules_table(spark, cfg.retention_rules))
    assert {r.data_stream: r.policy for r in table.collect()} == {n: p for n, p in by_rule.items() if p}


def test_template_and_names(spark):
    texts = {
        "id 7 and 12 and é12 x12 3_4": "id 7 and <num> and é<num> x12 3_4",
        "123e4567-e89b-12d3-a456-426614174000 end": "<uuid> end",
        "deadbeefdeadbeef1 9 deadbeef": "<hex> 9 deadbeef",
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert dict(rows.select("t", template(F.col("t"))).collect()) == texts
    assert spark.range(1).select(first_line(F.lit("top\r\nrest"))).first()[0] == "top"
    assert spark.range(1).select(stream_part(F.lit("-Ä b-"), "d")).first()[0] == "b"


def test_fingerprint_null_words(messages_of):
    rows = normalize(messages_of(["x 42", '{"body":"b","exception":{"message":"m"}}']))
    texts = [r[0] for r in rows.orderBy("source.offset").select(fingerprint_text()).collect()]
    assert texts == ["unknown-service|null||x <num>|", "unknown-service|null|null|b|"]


def test_validation_reports_the_first_rule(messages_of):
    row = prepare(messages_of(["x"])).withColumns({"event_time": F.lit(None).cast("timestamp"), "data_stream": F.lit(" ")})
    assert filters.validate(row).first().failure == "@timestamp is required"
    assert filters.validate(row.withColumn("event_time", F.current_timestamp())).first().failure == "data stream name is required"


@pytest.mark.parametrize("bad", [{"merge_threshold": 0}, {"otlp_records": "x"}, {"zone": "Nowhere/Land"}])
def test_bad_settings(bad):
    with pytest.raises(Exception):
        PipelineConfig(**bad)
