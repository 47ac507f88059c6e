"""Progress counters as aggregations over outcome tables and observed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_INTERVAL_SECONDS = 1


def _counters() -> list:
    messages, documents = F.sum("messages"), F.sum("documents")
    return [
        messages.alias("messages"),
        documents.alias("documents"),
        F.sum("successes").alias("successes"),
        F.sum("failures").alias("failures"),
        F.sum(F.greatest(F.lit(0), F.col("messages") - F.col("documents"))).alias(
            "skipped_or_merged"
        ),
    ]


def write_totals(batches: DataFrame) -> DataFrame:
    """Totals over ``(messages, documents, successes, failures)`` per written batch."""
    return batches.agg(*_counters())


def write_progress(batches: DataFrame, interval_seconds: int = 10) -> DataFrame:
    """Counters per interval, with what was written last in it.

    ``batches`` also has ``ingested_at, topic, partition, offset, data_stream``.
    """
    width = f"{max(MIN_INTERVAL_SECONDS, interval_seconds)} seconds"
    last = F.max_by(
        F.struct("topic", "partition", "offset", "data_stream"),
        F.struct("ingested_at", "topic", "partition", "offset"),
    )
    return (
        batches.groupBy(F.window("ingested_at", width).alias("window"))
        .agg(*_counters(), last.alias("last"))
        .select(
            F.col("window.start").alias("interval_start"),
            "messages",
            "documents",
            "successes",
            "failures",
            "skipped_or_merged",
            F.col("last.topic").alias("last_topic"),
            F.col("last.partition").alias("last_partition"),
            F.col("last.offset").alias("last_offset"),
            F.col("last.data_stream").alias("last_data_stream"),
        )
    )


def outcome_counters(dispositions: DataFrame, failures: DataFrame) -> DataFrame:
    """One row of write, retry and dead-letter totals, with the last failure.

    ``dispositions`` as from ``retry_disposition``; ``failures`` has ``failed_at``
    and ``summary`` per failed item.
    """
    # one table of both inputs, so that a single aggregation gives everything
    fates = dispositions.select(
        "disposition",
        "failed_first",
        "retries",
        F.lit(None).cast("timestamp").alias("failed_at"),
        F.lit(None).cast("string").alias("summary"),
    )
    events = failures.select(
        F.lit(None).cast("string").alias("disposition"),
        F.lit(None).cast("boolean").alias("failed_first"),
        F.lit(None).cast("int").alias("retries"),
        "failed_at",
        "summary",
    )
    d = F.col("disposition")
    newest = F.when(F.col("failed_at").isNotNull(), F.struct("failed_at", "summary"))
    return fates.unionByName(events).agg(
        F.count("disposition").alias("documents"),
        F.count_if(d != "dead_letter").alias("successes"),
        F.count_if("failed_first").alias("failures"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("retried_documents"),
        F.count_if(d == "created_after_retry").alias("retry_successes"),
        F.count_if(d == "dead_letter").alias("dead_letters"),
        F.max("failed_at").alias("last_failure_at"),
        F.max(newest)["summary"].alias("last_failure"),
    )


def consumer_counters(outcomes: DataFrame) -> DataFrame:
    """Per topic partition: polled, processed and filtered rows and the highest offset.

    ``outcomes`` has one row per message with ``handled`` and ``filtered``.
    """
    return outcomes.groupBy("topic", "partition").agg(
        F.count("*").alias("polled"),
        F.count_if("handled").alias("processed"),
        F.count_if("filtered").alias("filtered"),
        F.count_if(~F.col("handled")).alias("in_flight"),
        F.max("offset").alias("last_offset"),
    )


def observe_progress(routed: DataFrame, name: str = "progress") -> DataFrame:
    """Attach counters to a running job; a listener reads them without another pass."""
    failed = F.col("failure").isNotNull()
    return routed.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(failed).alias("failures"),
        F.count_if(~failed).alias("documents"),
        F.max("source.offset").alias("last_offset"),
    )


def observe_offsets(
    messages: DataFrame, partitions: list[tuple[str, int]], name: str = "offsets"
) -> DataFrame:
    """Attach rows and last offset of each given topic partition, before anything is filtered.

    Two counters per topic partition, so their number is bounded by the topics.
    """
    counters = []
    for topic, partition in partitions:
        own = (F.col("topic") == topic) & (F.col("partition") == partition)
        counters.append(F.count_if(own).alias(f"rows {topic} {partition}"))
        counters.append(F.max(F.when(own, F.col("offset"))).alias(f"last {topic} {partition}"))
    return messages.observe(name, *counters) if counters else messages
