"""Jobs that read and write tables: ingestion, replay, retention, compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.outcomes import dead_letter_documents, processing_failures
from ..operators.replay import ReplayRequest, rebuild_messages, replay_counts, select_for_replay
from ..operators.retention import partition_lifecycle
from ..session import configure, staged
from ..sources.tables import (
    drop_folders,
    new_write_id,
    partition_writes,
    read_table,
    stream_partitions,
    table_exists,
    write_dead_letters,
    write_parts,
    write_routed,
)
from .ingest import finish, prepare
from ..operators.merge import merge_anchored

_WORKING_COLUMNS = ("failure", "payload", "arrived_at", "category", "namespace", "retention", "action")


def write_both(
    routed: DataFrame,
    table: str,
    dead_letters: str,
    cfg: PipelineConfig = PipelineConfig(),
    write_id: str | None = None,
) -> None:
    """Write understood rows to their streams and the others to the dead letters."""
    valid = routed.where(F.col("failure").isNull()).drop(*_WORKING_COLUMNS)
    write_routed(valid, table, write_id)
    dead = dead_letter_documents(processing_failures(routed), cfg)
    write_dead_letters(dead, dead_letters, write_id)


def ingest_batch(
    messages: DataFrame, table: str, dead_letters: str, cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """Ingest static messages; returns one row of counts."""
    configure(messages.sparkSession)
    documents = staged(prepare(messages, cfg), "documents")
    routed = finish(merge_anchored(documents, cfg), cfg).drop("row_id")
    routed = staged(routed, "routed").drop("row_id")
    write_both(routed, table, dead_letters, cfg)
    failed = F.col("failure").isNotNull()
    return routed.agg(
        F.count("*").alias("rows"),
        F.count_if(~failed).alias("documents"),
        F.count_if(failed).alias("dead_letters"),
        F.count_if(F.col("action") == "aggregate").alias("aggregates"),
    )


_REPLAYS = "id string, write_id string"


def replayed_ids(spark: SparkSession, replayed: str) -> DataFrame:
    """Ids that finished replays have done, from the table ``replayed`` of :func:`replay_job`."""
    return spark.read.schema(_REPLAYS).parquet(f"{replayed}/done").select("id")


def _note_begun(ids: DataFrame, replayed: str, write_id: str) -> None:
    write_parts(ids, f"{replayed}/begun", write_id)


def _note_done(ids: DataFrame, replayed: str, write_id: str) -> None:
    write_parts(ids, f"{replayed}/done", write_id)


def _unfinished(spark: SparkSession, replayed: str) -> DataFrame | None:
    """(id, write_id) of a replay that began and did not end."""
    if not table_exists(spark, f"{replayed}/begun"):
        return None
    begun = spark.read.schema(_REPLAYS).parquet(f"{replayed}/begun")
    if table_exists(spark, f"{replayed}/done"):
        ended = spark.read.schema(_REPLAYS).parquet(f"{replayed}/done").select("write_id").distinct()
        open_ = begun.join(ended, "write_id", "left_anti")
    else:
        open_ = begun
    # one row, not the ids
    name = open_.agg(F.min("write_id").alias("write_id")).first()["write_id"]
    return None if name is None else begun.where(F.col("write_id") == name)


def replay_job(
    spark: SparkSession,
    dead_letters: str,
    table: str,
    failed_again: str,
    request: ReplayRequest = ReplayRequest(),
    cfg: PipelineConfig = PipelineConfig(),
    replayed: str | None = None,
) -> DataFrame:
    """Send selected dead letters through the document path again; returns the counts.

    ``replayed`` is a folder that remembers the ids done so far: they are not selected
    again, so that repeated runs with a limit work through all dead letters.  It also
    remembers, before anything is written, what a run is about to do.  After a failure
    the next run takes up that selection, whatever it is asked for, under the name of the
    same write: it replaces what the failed one had written.  Without ``replayed`` a
    run that failed may have written rows that a second one writes again.  What was
    asked for by name is not sampled again.
    """
    configure(spark)
    letters = read_table(spark, dead_letters)
    if replayed is not None and table_exists(spark, f"{replayed}/done"):
        letters = letters.join(replayed_ids(spark, replayed), "id", "left_anti")
    if request.dry_run:
        selected = select_for_replay(letters, request)
        return replay_counts(selected, selected, dry_run=True)
    unfinished = _unfinished(spark, replayed) if replayed is not None else None
    if unfinished is None:
        write_id, selected = new_write_id("replay"), select_for_replay(letters, request)
    else:
        write_id = unfinished.select("write_id").first()["write_id"]
        selected = letters.join(unfinished.select("id"), "id", "left_semi")
    # the selection is used several times
    selected = staged(selected, "replay").drop("row_id")
    if replayed is not None and unfinished is None:
        _note_begun(selected.select("id"), replayed, write_id)
    again = cfg.with_(debug_sample_rate=1.0)
    documents = staged(prepare(rebuild_messages(selected, again), again), "replay-documents")
    routed = finish(merge_anchored(documents, again), again).drop("row_id")
    write_both(routed, table, failed_again, again, write_id)
    if replayed is not None:
        _note_done(selected.select("id"), replayed, write_id)
    return replay_counts(selected, documents, dry_run=False)


def expired_partitions(
    spark: SparkSession, table: str, as_of: str, cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """Partitions past their delete age, for a look before :func:`retention_job`."""
    partitions = stream_partitions(spark, table)
    phases = partition_lifecycle(partitions, as_of, cfg).where(F.col("phase") == "delete")
    return phases.join(partitions, ["data_stream", "dt"])


def retention_job(
    spark: SparkSession, table: str, as_of: str, cfg: PipelineConfig = PipelineConfig()
) -> int:
    """Drop expired partitions as a whole; single rows are never deleted."""
    folders = [r.folder for r in expired_partitions(spark, table, as_of, cfg).select("folder").collect()]
    return drop_folders(spark, folders)


def compact_partition(spark: SparkSession, table: str, data_stream: str, dt: str) -> None:
    """Rewrite the writes of one stream and day as one write of well-filled files.

    The folders there at the start are read, the new one is written, and only then
    those are removed: rows that other writers add meanwhile stay, and a failure before
    the end loses nothing.
    """
    folders = partition_writes(spark, table, data_stream, dt)
    if not folders:
        return
    rows = spark.read.option("basePath", table).parquet(*folders)
    write_routed(rows.drop("dt", "write_id"), table, new_write_id("compact"))
    drop_folders(spark, folders)
