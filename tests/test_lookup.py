"""Keyed writes whose rows move between days, and the word index of a routed table."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.operators import keywords
from logmill.operators.search import keyword
from logmill.plans.ingest import prepare
from logmill.sources import tables
from logmill.sources.tables import read_table, upsert_by_id, write_routed

CFG = PipelineConfig(debug_sample_rate=1.0)


def rows_of(spark, *values):
    rows = [(i, v, at, datetime(2026, 1, day) if day else None) for i, v, at, day in values]
    return spark.createDataFrame(rows, "id string, v int, ingested_at int, event_time timestamp")


def state(spark, path):
    return sorted(((r.id, r.v, r.dt.day if r.dt else None) for r in read_table(spark, path).collect()), key=str)


def test_moved_rows_leave_their_old_day(spark, tmp_path):
    path = str(tmp_path / "k")
    upsert_by_id(spark, rows_of(spark, ("a", 1, 1, 1), ("b", 1, 1, 2), ("c", 1, 1, 3), ("e", 1, 1, 3)), path)
    untouched = sorted(glob.glob(path + "/dt=2026-01-03/*"))
    # a moves to another day, its first day is left empty; b gets an older row, which loses; d has no day
    upsert_by_id(spark, rows_of(spark, ("a", 2, 2, 2), ("b", 0, 0, 1), ("d", 1, 1, None), (None, 7, 1, 2)), path)
    assert state(spark, path) == sorted([("a", 2, 2), ("b", 1, 2), ("c", 1, 3), ("e", 1, 3), ("d", 1, None), (None, 7, 2)], key=str)
    assert not os.path.exists(path + "/dt=2026-01-01") and sorted(glob.glob(path + "/dt=2026-01-03/*")) == untouched
    # back again, several rows of one id in one write, and ids that lost their day
    upsert_by_id(spark, rows_of(spark, ("a", 3, 3, 1), ("a", 4, 4, 3), ("d", 2, 2, 1), (None, 8, 2, 1)), path)
    assert state(spark, path) == sorted([("a", 4, 3), ("b", 1, 2), ("c", 1, 3), ("e", 1, 3), ("d", 2, 1), (None, 8, 1)], key=str)
    upsert_by_id(spark, rows_of(spark).limit(0), path)
    assert len(state(spark, path)) == 6


def test_a_failed_write_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "k")
    upsert_by_id(spark, rows_of(spark, ("a", 1, 1, 1), ("b", 1, 1, 1)), path)
    second = rows_of(spark, ("a", 2, 2, 2), ("b", 2, 2, 2), ("c", 1, 1, 1))
    for step in ("write_parts", "drop_folders"):

        def fail(*_):
            raise RuntimeError(step)

        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(tables, step, fail)
            upsert_by_id(spark, second, path)
    for _ in range(2):
        upsert_by_id(spark, second, path, write_id="second")
        assert state(spark, path) == [("a", 2, 2), ("b", 2, 2), ("c", 1, 1)]


def test_a_search_reads_only_folders_that_can_match(spark, messages_of, tmp_path, monkeypatch):
    table, index = str(tmp_path / "t"), str(tmp_path / "words")
    line = '{"time":"2026-01-%02dT00:00:00Z","body":"%s"}'
    texts = {1: "pump Größe started", 2: "pump stopped", 3: "valve open; pump off", 9: "", 10: "straße nach größe"}
    for day, text in texts.items():
        write_routed(prepare(messages_of([line % (day, text)] * 3), CFG).drop("payload"), table, f"w{day}")
    keywords.index_words(spark, table, index, "i1")
    write_routed(prepare(messages_of([line % (12, "late pump started")]), CFG).drop("payload"), table, "w12")

    def days(token):
        return sorted(r.dt.day for r in keywords.search_words(spark, table, index, token).select("dt").distinct().collect())

    plain = read_table(spark, table)
    for token in ("pump", "GRÖSSE", "größe", "pump started", "started pump", "open pump", "", "; ", "absent", "pump off"):
        assert days(token) == sorted(r.dt.day for r in plain.where(keyword(token)).select("dt").distinct().collect()), token
    assert days("pump") == [1, 2, 3, 12] and days("pump started") == [12]
    # a later run takes only what is new; the same run again adds nothing twice
    for _ in range(2):
        keywords.index_words(spark, table, index, "i2")
        added = read_table(spark, index).where("write_id = 'i2'")
        assert sorted(r.word for r in added.collect()) == ["", "late", "pump", "started"]
    with monkeypatch.context() as patch:  # many folders: the same rows through a join
        patch.setattr(keywords, "MAX_LISTED", 1)
        assert days("pump") == [1, 2, 3, 12] and days("valve") == [3]
    # folders without the word are never opened: destroy one
    broken = glob.glob(f"{table}/*/dt=2026-01-10/*/*.parquet")
    for file in broken:
        open(file, "wb").write(b"x" * 100)
    for crc in glob.glob(f"{table}/*/dt=2026-01-10/*/.*.crc"):
        open(crc, "wb").write(b"")
    assert broken and days("valve") == [3] and days("pump") == [1, 2, 3, 12]
    with pytest.raises(Exception):
        plain.where(keyword("valve")).select(F.count("*")).collect()
