"""Offsets: lag, scans between offsets, and what progress events tell."""

import json

import pytest
from pyspark.sql import functions as F

from logmill.operators import offsets
from logmill.sources.messages import _from_broker, scan_options
from logmill.streaming.progress import ProgressCounters, parsed_offsets, source_lag

POINTS = "topic string, partition int, next_offset bigint"


def log(spark, *rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, handled boolean")


def test_lag_per_partition(spark):
    rows = log(
        spark, *[("a", 0, n, n != 4) for n in range(2, 9)], *[("a", 1, n, True) for n in (5, 9)], ("b", 0, 7, False), ("b", 0, 20, True)
    )
    got = sorted(map(tuple, offsets.partition_lag(rows, rows).collect()))
    # gaps count as offsets, not as rows; without a commit point everything is to be read
    assert got == [("a", 0, 4, 9, 5, 5), ("a", 1, 10, 10, 0, 0), ("b", 0, 7, 21, 14, 2)]
    ahead = log(spark, ("a", 0, 99, True))
    assert [tuple(r) for r in offsets.partition_lag(ahead, rows.where("topic = 'a' AND partition = 0")).collect()] == [("a", 0, 100, 9, 0, 0)]
    assert offsets.partition_lag(rows, rows.where("false")).count() == 0


def test_offsets_as_json_and_back(spark):
    rows = [("t \"x\"", 0, 5), ("a", 10, 1), ("a", 2, 3), ("a", 2, 2), ("a", None, 3), (None, 1, 1), ("a", 4, None)]
    text = offsets.offsets_json(spark.createDataFrame(rows, POINTS))
    assert json.loads(text) == {"a": {"2": 2, "10": 1}, 't "x"': {"0": 5}}
    back = offsets.offsets_table(spark, text)
    assert back.schema.simpleString() == "struct<topic:string,partition:int,next_offset:bigint>"
    assert offsets.offsets_json(back) == text
    assert offsets.offsets_json(back.where("false")) == "{}" and offsets.offsets_table(spark, "{}").count() == 0


def test_scan_between_offsets(spark):
    rows = log(spark, *[("a", p, n, True) for p in (0, 1, 2) for n in range(6)], ("b", 0, 1, True))
    read = lambda first, last: sorted((r.topic, r.partition, r.offset) for r in offsets.in_offset_range(rows, json.dumps(first), json.dumps(last)).collect())
    assert read({"a": {"0": 2, "1": -2, "2": 9}}, {"a": {"0": 4, "1": 2, "2": -1}}) == [("a", 0, 2), ("a", 0, 3), ("a", 1, 0), ("a", 1, 1)]
    assert read({"b": {"0": 0}, "a": {"0": 5}}, {"b": {"0": -1}}) == [("b", 0, 1)]
    assert read({}, {}) == []


def test_options_of_a_broker_scan():
    got = scan_options('{"a":{"10":4,"2":-2},"b":{"0":1}}', '{"a":{"2":8}}')
    assert {k: json.loads(v) for k, v in got.items()} == {
        "assign": {"a": [2, 10], "b": [0]},
        "startingOffsets": {"a": {"10": 4, "2": -2}, "b": {"0": 1}},
        "endingOffsets": {"a": {"10": -1, "2": 8}, "b": {"0": -1}},
    }
    with pytest.raises(ValueError, match="a-3"):
        scan_options('{"a":{"2":1}}', '{"a":{"3":8}}')


def test_columns_of_the_broker(spark):
    kind = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    raw = spark.createDataFrame([(None, bytearray("é".encode()), "a", 1, 7, None, 0), (bytearray(b"k"), None, "a", 1, 8, None, 0)], kind)
    rows = _from_broker(raw.withColumn("timestamp", F.lit("2026-01-01").cast("timestamp")))
    assert rows.columns == ["topic", "partition", "offset", "key", "value", "timestamp"]
    assert [(r.offset, r.key, r.value) for r in rows.orderBy("offset").collect()] == [(7, None, "é"), (8, "k", None)]


def test_offsets_of_progress_events():
    end, latest = '{"a":{"0":5,"1":9}}', '{"a":{"0":8,"1":7,"2":3}}'
    assert parsed_offsets(end) == {("a", 0): 5, ("a", 1): 9}
    assert source_lag(end, latest) == {("a", 0): 3, ("a", 1): 0, ("a", 2): 3}
    # a file source counts its log, other sources say anything
    assert parsed_offsets('{"logOffset":3}') == parsed_offsets(None) == parsed_offsets("12") == source_lag(None, None) == {}
    counters = ProgressCounters()
    counters.totals["q"]["polled"] = 10
    counters.wrote("q", 4, 1)
    counters.wrote("q", 2)
    assert counters.skipped_or_merged("q") == 3 and counters.skipped_or_merged("none") == 0
