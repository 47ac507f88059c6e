"""Duplicate windows that go on from batch to batch."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.functions.anchored import fold
from logmill.operators.merge import merge_anchored
from logmill.plans.ingest import prepare
from logmill.session import checkpointed, scratch_path, shared_dir, staged, workspace
from logmill.streaming.windows import close_windows, merge_batch, open_windows

CFG = PipelineConfig(merge_window_millis=20_000, merge_threshold=3)
FINAL = CFG.with_(merge_flush="final")


@pytest.fixture(scope="module")
def log(spark, messages_of):
    """Prepared documents in arrival order ``n``: a hot fingerprint, rare ones, late rows, failures."""
    rng = random.Random(11)
    payloads = []
    for i in range(900):
        second = i // 3 - (rng.randrange(40) if rng.random() < 0.05 else 0)
        at = f"2026-01-01T00:{max(second, 0) // 60:02d}:{max(second, 0) % 60:02d}Z"
        body = "cache is cold" if rng.random() < 0.5 else f"task {'abcdefgh'[rng.randrange(8)]} is late"
        payloads.append("null" if i % 100 == 99 else f'{{"timestamp":"{at}","level":"ERROR","serviceName":"s","body":"{body}","exception":{{"stacktrace":"at {i}"}}}}')
    rows = prepare(messages_of(payloads), CFG).withColumn("arrived_at", F.timestamp_seconds(F.col("source.offset")))
    return staged(rows, "log").drop("row_id")


def batches(log, cuts):
    for low, high in zip([0, *cuts], [*cuts, 10**9]):
        yield log.where((F.col("source.offset") >= low) & (F.col("source.offset") < high))


def told(rows):
    found = F.col("attributes")
    picked = rows.select("id", "action", "failure", found["merge.occurrence_count"], found["merge.window_end"], found["merge.sample_stack_trace"])
    return sorted(map(str, picked.collect()))


def streamed(spark, log, cuts, cfg, twice=(), whole_every=20, path=None, lateness=None):
    path, out = path or scratch_path(spark, "windows"), []
    for i, batch in enumerate(batches(log, cuts)):
        windows = open_windows(spark, path, batch, cfg)
        windows.whole_every = whole_every
        for _ in range(2 if i in twice else 1):
            rows = told(merge_batch(staged(batch, "batch"), windows, i, cfg, lateness))
        out += rows
    if cfg.merge_flush == "final":
        out += told(close_windows(windows, 99, cfg))
        assert not close_windows(windows, 100, cfg).count()
    return sorted(out), path


@pytest.mark.parametrize(("cfg", "cuts"), [(CFG, [300, 600]), (FINAL, [1, 50, 51, 880])], ids=["threshold", "final"])
def test_batches_give_the_rows_of_the_whole(spark, log, cfg, cuts):
    """Also when a batch is repeated, and when old states are put together."""
    whole = told(merge_anchored(staged(log, "whole"), cfg))
    rows, path = streamed(spark, log, cuts, cfg, twice=(1, 2), whole_every=2)
    assert rows == whole
    if cfg is FINAL:
        assert "whole-3" in os.listdir(path) and "delta-0" not in os.listdir(path)


def test_final_reports_each_window_once_with_its_true_count(spark, log):
    rows = merge_anchored(staged(log, "whole"), FINAL).where("failure IS NULL")
    sums = rows.where("action = 'aggregate'").select("id", F.col("attributes")["merge.occurrence_count"].cast("int").alias("n"), F.col("attributes")["merge.sample_stack_trace"].alias("trace"))
    found = sums.collect()
    assert len({r.id for r in found}) == len(found) and all(r.n > 3 and r.trace.startswith("at ") for r in found)
    hidden = sum(r.n - 3 for r in found)
    assert rows.where("action = 'raw'").count() + hidden == log.where("failure IS NULL").count()


def test_late_windows_close_and_leave_the_table(spark, log):
    """With a bound on lateness the summaries are the same, but for rows later than that."""
    on_time = log.where("failure IS NULL").withColumn("event_time", F.timestamp_seconds(F.lit(1_767_225_600) + F.col("source.offset") / 3))
    rows, path = streamed(spark, on_time, [100, 600], FINAL, path=scratch_path(spark, "late"), lateness=5_000)
    assert rows == told(merge_anchored(staged(on_time, "whole"), FINAL))
    windows = open_windows(spark, path, on_time, FINAL)
    before_last = windows.before(2).where("hash IS NOT NULL AND window_us IS NOT NULL")
    assert before_last.count() <= 9 and windows.before(0).count() == 0


def test_row_that_stands_for_several():
    us = np.array([0, 5_000, 9_000, 30_000], dtype=np.int64) * 1000
    starts, ordinals = fold(np.zeros(4, np.int64), us, 10_000, None, np.array([6, 0, 0, 0]))
    assert ordinals.tolist() == [7, 8, 9, 1] and starts.tolist() == [0, 0, 0, 30_000_000]


def test_hot_fingerprint_spans_tasks(spark, log):
    """No partition of the fold holds a third of the rows."""
    from logmill.operators.merge import folded

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = folded(staged(log.where("failure IS NULL"), "hot"), CFG)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 900 / 3


def test_workspace_removes_what_was_made_in_it(spark):
    with workspace(spark) as folder:
        assert staged(spark.range(3), "a").count() == 3 and checkpointed(spark.range(4)).count() == 4
        assert folder.startswith(shared_dir(spark)) and len(os.listdir(folder)) == 2
    assert not os.path.exists(folder) and not scratch_path(spark, "b").startswith(folder)
