"""Jobs that write tables, and streams against their static counterparts."""

import os

from pyspark.sql import functions as F

from logmill import PipelineConfig
from logmill.operators.merge import merge_tumbling
from logmill.operators.replay import ReplayRequest
from logmill.plans import jobs
from logmill.plans.ingest import prepare, process
from logmill.session import spread
from logmill.sources.messages import file_stream, message_files
from logmill.sources.tables import read_table, upsert_by_day, write_routed
from logmill.streaming.ingest import read_tumbling, start_ingest, start_tumbling, tumbling_counts
from logmill.streaming.progress import ProgressCounters

CFG = PipelineConfig(debug_sample_rate=1.0, merge_threshold=2)
PAYLOADS = (
    ['{"time":"2026-01-01T00:00:%02dZ","body":"disk 42 full","level":"ERROR","attributes":{"n":null}}' % (i % 60) for i in range(40)]
    + ['{"time":"bad","body":"x"}', "null", "text 1", '{"attributes":{"url.path":"/health"}}']
    + ['{"time":"2026-01-0%dT00:00:00.123456Z","body":"late","serviceName":"s%d"}' % (1 + i % 9, i % 3) for i in range(12)]
)


def picked(df):
    return sorted(
        (r.id, r.data_stream, r.event.kind, r.event_time, r.message, str(sorted(r.attributes.items(), key=str)))
        for r in df.select("id", "data_stream", "event", "event_time", "message", "attributes").collect()
    )


def test_stream_equals_batch(spark, messages_of, tmp_path):
    source, table, dead = (str(tmp_path / n) for n in ("in", "table", "dead"))
    base = messages_of(PAYLOADS).orderBy("offset")
    for lo in (0, 15, 30):
        base.where(f"offset >= {lo} AND offset < {lo + 15 if lo < 30 else 999}").coalesce(1).write.mode("append").parquet(source)
    # three files, read in the order they were written, one per micro-batch
    stream = file_stream(spark, source, max_files=1)
    counters = ProgressCounters()
    spark.streams.addListener(counters)
    named = [("t", 0), ("t", 77)]
    query = start_ingest(stream, table, dead, str(tmp_path / "ck"), CFG, {"availableNow": True}, counters=counters, partitions=named)
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive

    expected = process(message_files(spark, source), CFG)
    good = expected.where("failure IS NULL")
    assert picked(read_table(spark, table)) == picked(good)
    assert good.where("action = 'aggregate'").count() > 0
    reasons = {r.reason for r in read_table(spark, dead).collect()}
    assert reasons == {"event_time_unparseable", "payload_is_null"}
    spark.streams.removeListener(counters)
    (name, totals), = counters.totals.items()
    assert totals["polled"] == len(PAYLOADS) and totals["batches"] >= 3
    assert (totals["written"], totals["dead_letters"]) == (good.count(), 2)
    assert counters.skipped_or_merged(name) == len(PAYLOADS) - good.count() - 2 > 0
    # filtered rows are polled too
    assert counters.rows[name] == {("t", 0): len(PAYLOADS), ("t", 77): 0} and counters.offsets[name] == {("t", 0): len(PAYLOADS)}


def test_tumbling_stream(spark, messages_of, tmp_path):
    source = str(tmp_path / "in")
    messages_of(PAYLOADS).write.parquet(source)
    stream = tumbling_counts(file_stream(spark, source), CFG, "1 hour")
    query = stream.writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(300)
    want = merge_tumbling(prepare(message_files(spark, source), CFG).where("failure IS NULL"), CFG)
    names = ["hash", "window_start", "occurrence_count", "first_message", "last_message"]
    assert sorted(map(tuple, spark.table("tumbling").select(names).collect())) == sorted(map(tuple, want.select(names).collect()))


def test_late_rows_of_a_stream_are_counted(spark, messages_of, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "counts")
    payload = '{"message": "shelf %s empty", "level": "ERROR", "timestamp": "2026-01-%02dT00:00:00Z"}'
    for day, run in ((20, 0), (2, 1), (2, 2), (20, 3)):  # the later files are weeks late
        messages_of([payload % ("x", day)] * 2).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):  # the second start finds nothing new
        stream = file_stream(spark, source, max_files=1)
        start_tumbling(stream, table, str(tmp_path / "ck"), CFG, {"availableNow": True}).awaitTermination(300)
    rows = read_tumbling(spark, table).collect()
    assert sorted(r.occurrence_count for r in rows) == [4, 4]


def test_batch_job_replay_and_retention(spark, messages_of, tmp_path):
    table, dead, again = (str(tmp_path / n) for n in ("table", "dead", "again"))
    counts = jobs.ingest_batch(messages_of(PAYLOADS), table, dead, CFG).first()
    assert counts.dead_letters == 2 and counts.aggregates > 0
    assert read_table(spark, table).count() == counts.documents

    dry = jobs.replay_job(spark, dead, table, again, ReplayRequest(), CFG).first()
    assert tuple(dry) == (2, 0, 0, 0)
    done = jobs.replay_job(spark, dead, table, again, ReplayRequest(dry_run=False), CFG).first()
    assert tuple(done) == (2, 0, 2, 0)
    assert read_table(spark, again).count() == 2

    before = read_table(spark, table).count()
    folder = read_table(spark, table).select("data_stream", F.col("dt").cast("string")).first()
    jobs.compact_partition(spark, table, folder[0], folder[1])
    assert read_table(spark, table).count() == before
    expired = jobs.expired_partitions(spark, table, "2026-02-03", CFG)
    assert {r.policy for r in expired.collect()} == {"default-policy"}
    gone = expired.count()
    assert jobs.retention_job(spark, table, "2026-02-03", CFG) == gone > 0
    assert jobs.expired_partitions(spark, table, "2026-02-03", CFG).count() == 0


def test_replay_after_a_crash(spark, messages_of, tmp_path, monkeypatch):
    table, dead, again, done = (str(tmp_path / n) for n in ("table", "dead", "again", "done"))
    bad = ['{"time":"bad %d","body":"x"}' % i for i in range(5)]
    jobs.ingest_batch(messages_of(bad), table, dead, CFG)
    first = ReplayRequest(dry_run=False, limit=2)

    def stop(*args):
        raise RuntimeError("lost")

    # nothing of the replay was noted, then only that it began: both are made good by the next run
    for step in ("write_both", "_note_done"):
        with monkeypatch.context() as patch:
            patch.setattr(jobs, step, stop)
            try:
                jobs.replay_job(spark, dead, table, again, first, CFG, done)
            except RuntimeError:
                pass
    assert read_table(spark, again).count() == 2
    # the run after it takes up those two, whatever it is asked for; the next one takes the others
    assert jobs.replay_job(spark, dead, table, again, ReplayRequest(dry_run=False, limit=None), CFG, done).first()[0] == 2
    assert read_table(spark, again).count() == 2 and jobs.replayed_ids(spark, done).count() == 2
    assert jobs.replay_job(spark, dead, table, again, ReplayRequest(dry_run=False, limit=None), CFG, done).first()[0] == 3
    assert read_table(spark, again).count() == 5 and jobs.replayed_ids(spark, done).distinct().count() == 5
    assert jobs.replay_job(spark, dead, table, again, ReplayRequest(dry_run=False, limit=None), CFG, done).first()[0] == 0
    assert read_table(spark, again).count() == 5


def test_repeated_batch_write_replaces(spark, messages_of, tmp_path):
    rows = prepare(messages_of(["a", "b"]), CFG)
    for batch in (3, 3, 4):
        write_routed(rows, str(tmp_path / "t"), f"stream-{batch}")
    assert read_table(spark, str(tmp_path / "t")).count() == 4


def test_keyed_write(spark, tmp_path):
    def rows(*values):
        return spark.createDataFrame(values, "id string, v int, ingested_at int").withColumn("event_time", F.lit("2026-01-01").cast("timestamp"))

    path = str(tmp_path / "k")
    upsert_by_day(spark, rows(("a", 1, 1), ("b", 1, 1)), path)
    upsert_by_day(spark, rows(("a", 2, 2), ("a", 0, 0)), path)
    assert sorted((r.id, r.v) for r in read_table(spark, path).collect()) == [("a", 2), ("b", 1)]
    assert os.path.isdir(path)


def test_one_row_group_is_dealt_to_many_tasks(spark, tmp_path):
    """A file has more splits than cores and yet all of its rows in one of them."""
    conf = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1024"}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        spark.range(100_000).coalesce(1).selectExpr("id", "xxhash64(id) AS h").write.parquet(str(tmp_path / "rows"))
        rows = spark.read.parquet(str(tmp_path / "rows"))
        assert rows.rdd.getNumPartitions() > 8
        dealt = spread(rows)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) <= 25_000
        assert spread(dealt).rdd.getNumPartitions() == dealt.rdd.getNumPartitions()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
