import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.functions.anchored import exits, fold
from logmill.operators.merge import merge_anchored, merge_tumbling, with_positions
from logmill.plans.ingest import finish, prepare, process


def walk(times, width, state=None):
    """Row-by-row rule: ``(window start, ordinal)`` of each time of one group."""
    out = []
    for t in times:
        if state is None or t // 1000 - state[0] // 1000 >= width:
            state = (t, 1)
        else:
            state = (state[0], state[1] + 1)
        out.append(state)
    return out


def random_times(rng, size, late):
    now, out = 1_700_000_000_000_000, []
    for _ in range(size):
        now += rng.choice([0, 1, 900, 40_000, 700_000, 5_000_000])
        out.append(now - (rng.randrange(9_000_000) if rng.random() < late else 0))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_kernel_matches_rule(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 4000) for _ in range(6)]
    groups = np.repeat(np.arange(6), sizes)
    lists = [random_times(rng, n, 0.2 * (seed % 3)) for n in sizes]
    carry = (lists[0][0] - 1_500_000, 4) if seed % 2 else None
    starts, ordinals = fold(groups, np.array(sum(lists, []), np.int64), 2_000, carry)
    want = [row for i, t in enumerate(lists) for row in walk(t, 2_000, carry if i == 0 else None)]
    assert list(zip(starts.tolist(), ordinals.tolist())) == want


@pytest.mark.parametrize("seed", range(8))
def test_exits_match_rule(seed):
    rng = random.Random(seed)
    width = rng.choice([1, 500, 20_000])
    times = random_times(rng, 500, 0.2 * (seed % 3))
    before, run = times[:100], times[100:]
    incoming = walk(before, width)[-1]
    us = np.array(run, np.int64)
    top = np.maximum.accumulate(us // 1000)
    at = np.flatnonzero(np.concatenate(([True], top[1:] > top[:-1])))
    entry, start, n = exits(us[at], at, len(us), width, max(before) // 1000)
    place = int(np.searchsorted(entry, incoming[0] // 1000 + width, "left"))
    got = (int(start[place]), int(n[place])) if place < len(entry) else (incoming[0], incoming[1] + len(us))
    assert got == walk(run, width, incoming)[-1]


def documents(spark, groups):
    """Documents with given fingerprints; ``groups`` maps a hash to its times in arrival order."""
    rows = []
    for name, times in groups.items():
        for i, t in enumerate(times):
            rows.append((name, i, t))
    base = spark.createDataFrame(rows, "hash string, n bigint, us bigint")
    event = F.struct(
        F.lit("d").alias("dataset"), F.lit("event").alias("kind"), F.array(F.lit("application")).alias("category"),
        F.array(F.lit("info")).alias("type"), F.sha2("hash", 256).alias("hash"),
    )
    return base.select(
        F.concat_ws("-", "hash", F.col("n").cast("string")).alias("id"),
        F.timestamp_micros("us").alias("event_time"),
        F.timestamp_micros(F.col("n")).alias("arrived_at"),
        event.alias("event"),
        F.struct(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("n").alias("offset")).alias("source"),
        F.lit(None).cast("string").alias("failure"),
    )


@pytest.mark.parametrize("width", [2_000, 60_000, 10**9])
def test_positions_of_a_dominant_fingerprint(spark, width):
    """One fingerprint fills most partitions, so windows cross several of them."""
    rng = random.Random(width)
    groups = {"hot": random_times(rng, 20_000, 0.1), "one": [5], "same": [7] * 3_000}
    groups |= {f"c{i}": random_times(rng, rng.randrange(1, 30), 0.1) for i in range(200)}
    placed = with_positions(documents(spark, groups), PipelineConfig(merge_window_millis=width))
    got = {r.id: (r.us, r.ordinal) for r in placed.select("id", F.unix_micros("window_start").alias("us"), "ordinal").collect()}
    want = {f"{k}-{i}": row for k, times in groups.items() for i, row in enumerate(walk(times, width))}
    assert got == want


def test_raw_suppressed_aggregate(messages_of):
    cfg = PipelineConfig(merge_threshold=2)
    rows = process(messages_of(['{"level":"ERROR","body":"failed 77","serviceName":"s"}'] * 7 + ["null"]), cfg).collect()
    good = [r for r in rows if r.failure is None]
    assert sorted(r.action for r in good) == ["aggregate", "aggregate", "raw", "raw"]
    summaries = sorted((r for r in good if r.action == "aggregate"), key=lambda r: r.source.offset)
    last = summaries[-1]
    assert [r.attributes["merge.occurrence_count"] for r in summaries] == ["4", "6"]
    assert last.data_stream == "logs-aggregate-metrics-prod" and last.event.dataset == "aggregate-metrics"
    assert last.event.kind == "metric" and last.event.type == ["aggregation"]
    assert last.attributes["merge.window_end"] == "2026-01-01T00:00:05Z"
    assert last.attributes["merge.sample_message"] == "failed 77"
    assert last.ingest.policy == "merge-window" and last.id.startswith("aggregate-")
    assert [r.failure for r in rows if r.failure] == ["payload_is_null"]


def test_identical_copies_without_offset(messages_of):
    """Copies of one hand-made message share an id; each still counts once."""
    rows = merge_anchored(prepare(messages_of(["same"] * 9, start_offset=-1))).collect()
    assert sorted(r.action for r in rows) == ["aggregate"] * 2 + ["raw"] * 3


def test_disabled_merge(messages_of):
    rows = finish(merge_anchored(prepare(messages_of(["x"] * 5)), PipelineConfig(merge_enabled=False)))
    assert rows.count() == 5


def test_tumbling_counts(spark):
    minute = 60_000_000
    rows = merge_tumbling(documents(spark, {"a": [1, 2, minute, minute + 5]}).withColumn("message", F.col("id")))
    got = sorted((r.occurrence_count, r.first_message, r.last_message) for r in rows.collect())
    assert got == [(2, "a-0", "a-1"), (2, "a-2", "a-3")]
    assert rows.orderBy("window_start").first().window_start == datetime(1970, 1, 1) + timedelta(0)
