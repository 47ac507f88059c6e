from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.operators import metrics, offsets, outcomes, replay, search
from logmill.schemas import MESSAGES, WRITE_OUTCOMES
from logmill.sources.messages import ad_hoc, text_lines


def values(df, *names):
    return sorted(map(tuple, df.select(*names).collect()))


def test_failure_classes(spark):
    rows = spark.createDataFrame(
        [(None, "x"), (429, None), (400, "parse"), (400, "circuit_breaking_exception"), (404, None), (504, "y")],
        "status int, error_type string",
    )
    kinds = [r[0] for r in rows.select(outcomes.failure_class(F.col("status"), F.col("error_type"))).collect()]
    assert kinds == ["RETRYABLE", "RETRYABLE", "DEAD_LETTER", "RETRYABLE", "DEAD_LETTER", "RETRYABLE"]


def attempts(spark, rows):
    full = [(1, item, attempt, "s", f"d{item}", status, kind, None) for item, attempt, status, kind in rows]
    return spark.createDataFrame(full, WRITE_OUTCOMES)


def test_retries(spark):
    log = attempts(
        spark,
        [
            (0, 0, 201, None),
            (1, 0, 429, "es_rejected_execution_exception"), (1, 1, 201, None),
            (2, 0, 400, "mapper_parsing_exception"),
            (3, 0, 503, None), (3, 1, 503, None), (3, 2, 503, None), (3, 3, 201, None),
            (4, 0, 503, None), (4, 1, 400, "x"),
            (5, 0, None, "io_exception"),
        ],
    )
    fates = outcomes.retry_disposition(log)
    assert values(fates, "item_index", "retries", "disposition") == [
        (0, 0, "created"), (1, 1, "created_after_retry"), (2, 0, "dead_letter"),
        (3, 2, "dead_letter"), (4, 1, "dead_letter"), (5, 0, "dead_letter"),
    ]
    none = fates.where("false")
    row = outcomes.handling_summary(fates, fates.where("item_index = 5"), none).first()
    assert (row.initial_failures, row.retried, row.retry_success) == (5, 4, 1)
    assert (row.dead_letters, row.unresolved, row.fully_handled) == (3, 1, False)
    no_retry = outcomes.retry_disposition(log, PipelineConfig(max_retries=0))
    assert no_retry.where("disposition = 'created_after_retry'").count() == 0


def test_status_and_commit(spark):
    rows = spark.createDataFrame(
        [
            (0, 0, 0, 0, 0, True, "skipped"), (1, 0, 0, 0, 0, True, "created"),
            (2, 1, 1, 0, 0, True, "created_after_retry"), (2, 1, 0, 1, 0, True, "dead_letter"),
            (2, 2, 1, 0, 1, False, "partial_failure"),
        ],
        "documents int, initial_failures int, retry_success int, dead_letters int, unresolved int, fully_handled boolean, want string",
    )
    assert rows.where(outcomes.ingest_status() != F.col("want")).count() == 0
    strict = PipelineConfig(commit_after_dead_letter=False)
    assert [r[0] for r in rows.select(outcomes.may_commit(strict)).collect()] == [True, True, True, False, False]


def test_dead_letters_and_replay(spark):
    def at(s):
        return datetime(2026, 1, 1, 0, 0, s)

    messages = spark.createDataFrame(
        [("t", 0, 1, "k", "old", at(1)), ("t", 0, 1, "k", "new", at(2)), ("t", 0, 2, None, " ", at(3))], MESSAGES
    )
    failed = spark.createDataFrame(
        [("t", 0, o, 0, "s", "d", 400, "bad", None) for o in (1, 2, 9)],
        "topic string, partition int, offset bigint, item_index int, data_stream string, document_id string, status int, error_type string, reason string",
    )
    rows = outcomes.dead_letter_rows(failed, messages)
    assert values(rows, "offset", "payload", "reason") == [
        (1, "new", "s[0]: status=400, type=bad, reason=null"),
        (2, " ", "s[0]: status=400, type=bad, reason=null"),
    ]
    assert values(outcomes.unresolved_sources(failed, messages), "offset") == [(9,)]
    letters = outcomes.dead_letter_documents(rows, at=F.col("timestamp"))
    first = letters.orderBy("offset").first()
    assert first.id == "deadletter-t-0-1" and first.data_stream == "logs-deadletter-prod"
    assert first.attributes["deadletter.status"] == "400" and first.attributes["deadletter.payload"] == "new"

    pick = lambda **kw: [r.offset for r in replay.select_for_replay(letters, replay.ReplayRequest(**kw)).collect()]
    assert pick() == [1, 2] and pick(limit=1) == [1] and pick(error_type="other") == []
    assert pick(since=at(3), topic="t") == [2] and pick(until=at(2)) == [1] and pick(topic=" ") == [1, 2]
    assert replay.ReplayRequest(limit=0).safe_limit == 100 and replay.ReplayRequest(limit=None).safe_limit is None
    with pytest.raises(ValueError):
        replay.ReplayRequest(limit=9_999)
    assert values(replay.rebuild_messages(letters), "value", "offset") == [("new", -1)]
    processed = spark.createDataFrame([(None,)], "failure string")
    assert tuple(replay.replay_counts(letters, processed, False).first()) == (2, 1, 0, 1)
    assert tuple(replay.replay_counts(letters, processed, True).first()) == (2, 0, 0, 0)


def test_offsets(spark):
    records = spark.createDataFrame(
        [("logs", 0, 10), ("logs", 0, 12), ("logs", 1, 3), ("audit", 0, 7)], "topic string, partition int, offset bigint"
    )
    plan = [tuple(r) for r in offsets.next_offsets(records).collect()]
    assert plan == [("audit", 0, 8), ("logs", 0, 13), ("logs", 1, 4)]
    marks = spark.createDataFrame(
        [("a", 0, 1, True), ("a", 0, 5, True), ("a", 0, 9, False), ("a", 0, 11, True), ("b", 0, 1, False), ("c", 0, 4, True), ("c", 0, 4, False), ("d", 0, 2, True)],
        "topic string, partition int, offset bigint, handled boolean",
    )
    one_each = offsets.offset_outcomes(marks)
    assert values(offsets.handled_prefix(one_each), "topic", "next_offset") == [("a", 6), ("d", 3)]


def test_offset_marks(spark):
    written = spark.createDataFrame(
        [(b, "t", 0, b * 10 + i) for b in (1, 2, 3) for i in (0, 1)], "batch_id int, topic string, partition int, offset bigint"
    )
    unresolved = written.where("offset = 21")
    handled = spark.createDataFrame([(1, True), (2, False), (3, False)], "batch_id int, may_commit boolean")
    unfinished = offsets.mark_offsets(written, unresolved, handled.where("batch_id <> 2"))
    assert values(unfinished.where("offset IN (20, 21)"), "handled") == [(False,), (False,)]
    rows = offsets.mark_offsets(written, unresolved, handled)
    assert values(rows, "offset", "handled") == [(10, True), (11, True), (20, True), (21, False), (30, False), (31, False)]


def test_ad_hoc_and_text(spark, tmp_path):
    rows = spark.createDataFrame([("hello", " "), (" ", "x"), ("y", "own")], "payload string, topic string")
    assert values(ad_hoc(rows, "dflt"), "topic", "value", "offset") == [("dflt", "hello", -1), ("own", "y", -1)]
    (tmp_path / "a.log").write_text("one\n\ntwo\n")
    assert values(text_lines(spark, str(tmp_path), "t"), "topic", "value") == [("t", "one"), ("t", "two")]


def test_search_tokens(spark):
    rows = spark.createDataFrame([("Disk full, now",), ("diskless",), (None,)], "m string")
    assert [r[0] for r in rows.select(search.has_token(F.col("m"), "DISK")).collect()] == [True, False, False]
    top = search.top_terms(spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "t string"), F.col("t"), 2)
    assert [tuple(r) for r in top.collect()] == [("b", 2), ("a", 1)]


def test_progress(spark):
    rows = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0, 0, s), 10, d, d, 0, "t", 0, s, "ds") for s, d in ((1, 8), (3, 12), (12, 10))],
        "ingested_at timestamp, messages int, documents int, successes int, failures int, topic string, partition int, offset bigint, data_stream string",
    )
    got = values(metrics.write_progress(rows, 10), "messages", "documents", "skipped_or_merged", "last_offset")
    assert got == [(10, 10, 0, 12), (20, 20, 2, 3)]
    assert tuple(metrics.write_totals(rows).first()) == (30, 30, 30, 0, 2)
