"""Wiring of streaming ingestion: source, document path, merge, sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..operators.merge import merge_tumbling, sum_parts, tumbling_parts
from ..operators.metrics import observe_offsets, observe_progress
from ..plans.ingest import finish, prepare
from ..plans.jobs import write_both
from ..session import configure, staged, workspace
from ..sources.messages import no_messages
from ..sources.tables import read_table, write_parts
from .progress import ProgressCounters
from .windows import close_windows, merge_batch, open_windows

WINDOWS = "open-windows"


Sink = Callable[[DataFrame, int], None]


def start_routed(
    messages: DataFrame,
    sink: Sink,
    checkpoint: str,
    cfg: PipelineConfig = PipelineConfig(),
    trigger: dict | None = None,
    lateness_millis: int | None = None,
    counters: ProgressCounters | None = None,
    partitions: list[tuple[str, int]] | None = None,
) -> StreamingQuery:
    """Hand the routed rows of each micro-batch of a message stream to ``sink(rows, batch_id)``.

    Over all batches these are the rows of ``process`` on the same messages.  Parsed
    documents and other tables of a batch live until it is done; the open duplicate windows are
    a table in the checkpoint folder (see :mod:`logmill.streaming.windows`, also for
    ``lateness_millis``).  With ``merge_flush='final'``, :func:`finish_routed` writes the
    summaries of windows still open when the stream has ended.  ``counters`` is told what each batch
    wrote; of the topic ``partitions`` named, rows and offsets are observed.
    """
    spark = configure(messages.sparkSession)

    def run(batch: DataFrame, batch_id: int) -> None:
        with workspace(spark, "batch"):
            documents = staged(batch, "documents")
            if cfg.merge_enabled:
                windows = open_windows(spark, f"{checkpoint}/{WINDOWS}", documents, cfg)
                merged = merge_batch(documents, windows, batch_id, cfg, lateness_millis)
            else:
                merged = documents.drop("row_id").withColumn("action", F.lit("raw"))
            routed = staged(finish(merged, cfg), "routed").drop("row_id")
            sink(routed, batch_id)
            if counters is not None:
                failed = F.col("failure").isNotNull()
                n = routed.agg(F.count_if(~failed).alias("documents"), F.count_if(failed).alias("failures")).first()
                query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
                counters.wrote(query, n.documents, n.failures)

    return (
        observe_progress(prepare(observe_offsets(messages, partitions or []), cfg))
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )


def finish_routed(
    spark: SparkSession, sink: Sink, checkpoint: str, batch_id: int, cfg: PipelineConfig = PipelineConfig()
) -> None:
    """After the last batch of a stopped stream: summaries of its open windows go to ``sink``.

    ``batch_id`` is one that the stream has not used yet.
    """
    configure(spark)
    with workspace(spark, "batch"):
        windows = open_windows(spark, f"{checkpoint}/{WINDOWS}", prepare(no_messages(spark), cfg), cfg)
        sink(staged(finish(close_windows(windows, batch_id, cfg), cfg), "routed").drop("row_id"), batch_id)


def start_ingest(
    messages: DataFrame,
    table: str,
    dead_letters: str,
    checkpoint: str,
    cfg: PipelineConfig = PipelineConfig(),
    trigger: dict | None = None,
    lateness_millis: int | None = None,
    counters: ProgressCounters | None = None,
    partitions: list[tuple[str, int]] | None = None,
) -> StreamingQuery:
    """Start writing a message stream to the routed table and the dead letters.

    A micro-batch that is repeated after a failure replaces what its first attempt
    wrote, so rows are neither lost nor duplicated.  The write is named after the
    query, whose id belongs to its checkpoint, and the batch: another stream, or the
    same one from a new checkpoint, never replaces these rows.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_both(rows, table, dead_letters, cfg, f"stream-{query}-{batch_id}")

    return start_routed(messages, sink, checkpoint, cfg, trigger, lateness_millis, counters, partitions)


def start_tumbling(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    cfg: PipelineConfig = PipelineConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count duplicates per fingerprint and window over a stream, however late rows come.

    Every micro-batch writes the counts of its own rows, named as in
    :func:`start_ingest`; :func:`read_tumbling` adds them up.  So there is no state, no
    watermark that drops rows, and a repeated batch replaces its own counts.
    """
    configure(messages.sparkSession)

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_parts(tumbling_parts(batch, cfg), table, f"stream-{query}-{batch_id}")

    return (
        prepare(messages, cfg).where("failure IS NULL")
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_tumbling(spark: SparkSession, table: str) -> DataFrame:
    """Counts of all micro-batches so far."""
    return sum_parts(read_table(spark, table))


def tumbling_counts(
    messages: DataFrame, cfg: PipelineConfig = PipelineConfig(), lateness: str = "10 minutes"
) -> DataFrame:
    """Duplicate counts per fingerprint and window as a streaming aggregation.

    Rows later than ``lateness`` are dropped; :func:`start_tumbling` counts them too.
    """
    configure(messages.sparkSession)
    documents = prepare(messages, cfg).where("failure IS NULL")
    return merge_tumbling(documents.withWatermark("event_time", lateness), cfg)
