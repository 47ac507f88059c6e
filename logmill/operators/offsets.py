"""Offset accounting as audit queries over outcome tables.

Spark's checkpoint commits offsets; these jobs tell what a table says is done.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = ["topic", "partition"]
OFFSETS = "map<string,map<string,bigint>>"
# What the broker reader takes for the first offset of a partition and its end
EARLIEST, LATEST = -2, -1


def next_offsets(records: DataFrame) -> DataFrame:
    """The offset to continue at per topic partition, in partition order."""
    return (
        records.groupBy(*PARTITION)
        .agg((F.max("offset") + 1).alias("next_offset"))
        .orderBy(*PARTITION)
    )


def offset_outcomes(marks: DataFrame) -> DataFrame:
    """One row per offset; it is handled only if every mark of it says so."""
    return marks.groupBy(*PARTITION, "offset").agg(F.bool_and("handled").alias("handled"))


def mark_offsets(written: DataFrame, unresolved: DataFrame, handled: DataFrame) -> DataFrame:
    """Offset marks of written documents.

    ``written`` ``(batch_id, topic, partition, offset)``; ``handled`` one row per
    batch ``(batch_id, may_commit)``; ``unresolved`` the open source keys per batch.
    A batch that may be committed handles all its offsets.  Otherwise only the
    unresolved ones stay open, or all of them if the batch lists none or has no row in
    ``handled`` (it has not ended).
    """
    keys = ["batch_id", *PARTITION, "offset"]
    listed = unresolved.select(*keys).distinct().withColumn("is_open", F.lit(True))
    lists_any = unresolved.select("batch_id").distinct().withColumn("lists_any", F.lit(True))
    state = handled.join(lists_any, "batch_id", "left")
    return (
        written.join(state, "batch_id", "left")
        .join(listed, keys, "left")
        .select(
            *PARTITION,
            "offset",
            F.coalesce(
                F.col("may_commit")
                | (F.col("may_commit").isNotNull() & F.coalesce("lists_any", F.lit(False)) & F.col("is_open").isNull()),
                F.lit(False),
            ).alias("handled"),
        )
    )


def handled_prefix(outcomes: DataFrame) -> DataFrame:
    """Commit point per topic partition: one past the last row before the first open one.

    Gaps in the numbers are fine.  Two combining aggregations instead of a running
    window, so a partition holding most rows needs no sort and no single task.
    """
    first_open = (
        outcomes.groupBy(*PARTITION)
        .agg(
            F.min(F.when(~F.coalesce("handled", F.lit(False)), F.col("offset"))).alias("first_open")
        )
    )
    return (
        outcomes.join(first_open, PARTITION)
        .where(F.col("first_open").isNull() | (F.col("offset") < F.col("first_open")))
        .groupBy(*PARTITION)
        .agg((F.max("offset") + 1).alias("next_offset"))
    )


def log_range(records: DataFrame) -> DataFrame:
    """First offset and end (one past the last) per topic partition of a log."""
    return records.groupBy(*PARTITION).agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def partition_lag(outcomes: DataFrame, log: DataFrame) -> DataFrame:
    """How far each topic partition of ``log`` is ahead of its commit point.

    A partition without a commit point continues at its first offset.  ``lag`` counts
    offsets, ``behind`` the rows of the log at or after the point; a commit point beyond
    the end gives 0.  Commit points and ends are one row per topic partition; the log is
    only counted, with partial counts before the shuffle.
    """
    ends = log_range(log).join(handled_prefix(outcomes), PARTITION, "left")
    ends = ends.withColumn("next_offset", F.coalesce("next_offset", "begin_offset"))
    rest = (
        log.join(ends.select(*PARTITION, "next_offset"), PARTITION)
        .where(F.col("offset") >= F.col("next_offset"))
        .groupBy(*PARTITION)
        .agg(F.count("*").alias("behind"))
    )
    return ends.join(rest, PARTITION, "left").select(
        *PARTITION,
        "next_offset",
        "end_offset",
        F.greatest(F.col("end_offset") - F.col("next_offset"), F.lit(0)).alias("lag"),
        F.coalesce("behind", F.lit(0)).alias("behind"),
    )


def offsets_json(points: DataFrame, offset: str = "next_offset") -> str:
    """Offsets per topic partition as JSON text for the broker reader: ``{"topic": {"0": 12}}``.

    One value per topic partition reaches the driver, as the reader needs them there.
    Of several rows of a topic partition the smallest offset counts, so nothing is
    skipped; rows without topic, partition or offset are left out.
    """
    held = points.where(F.col(offset).isNotNull() & F.col("topic").isNotNull() & F.col("partition").isNotNull())
    out: dict[str, dict[str, int]] = {}
    for r in held.groupBy(*PARTITION).agg(F.min(offset).alias("at")).orderBy(*PARTITION).collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["at"]
    return json.dumps(out, separators=(",", ":"))


def offsets_table(spark: SparkSession, text: str, offset: str = "next_offset") -> DataFrame:
    """The rows ``(topic, partition, offset)`` of :func:`offsets_json`, or of a progress event's offsets."""
    topics = spark.range(1).select(F.explode(F.from_json(F.lit(text), OFFSETS)).alias("topic", "at"))
    rows = topics.select("topic", F.explode("at").alias("partition", offset))
    return rows.withColumn("partition", F.col("partition").cast("int"))


def in_offset_range(messages: DataFrame, starting: str, ending: str) -> DataFrame:
    """Stored messages from the offsets ``starting`` on and before ``ending``, both JSON text.

    As the broker reader takes them: -2 stands for the first offset and -1 for the end,
    and only topic partitions named in both are read.  The ranges (one row per
    topic partition) are joined, so the log isn't shuffled while they are small.
    """
    spark = messages.sparkSession
    ranges = offsets_table(spark, starting, "from_offset").join(offsets_table(spark, ending, "to_offset"), PARTITION)
    reached = (F.col("from_offset") == EARLIEST) | ((F.col("from_offset") >= 0) & (F.col("offset") >= F.col("from_offset")))
    before = (F.col("to_offset") == LATEST) | (F.col("offset") < F.col("to_offset"))
    rows = messages.alias("m").join(ranges.alias("r"), PARTITION).where(reached & before)
    return rows.select(*[F.col(f"m.{c}") for c in messages.columns])


def in_partition_order(messages: DataFrame) -> DataFrame:
    """Rows of a topic partition together and in offset order.

    Range partitioning splits a partition that is too large for one task; its
    pieces stay consecutive.
    """
    keys = [*PARTITION, "offset"]
    return messages.repartitionByRange(*keys).sortWithinPartitions(*keys)
