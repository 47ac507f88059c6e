"""Read side of the log lake: filters, keyword search, top terms, storm summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.plan import within_days
from .merge import merge_tumbling

GAPS = r"[^\p{L}\p{N}_]+"


def search(
    documents: DataFrame,
    since: str | None = None,
    until: str | None = None,
    service: str | None = None,
    level: str | None = None,
    trace_id: str | None = None,
    topic: str | None = None,
    partition: int | None = None,
    offset: int | None = None,
    keyword: Column | None = None,
    limit: int = 100,
) -> DataFrame:
    """Newest matching documents; ties are broken by ingestion time and id.

    A stored table is narrowed to the days of the time range.
    """
    equal = {
        "service.name": service,
        "log.level": level,
        "trace.id": trace_id,
        "source.topic": topic,
        "source.partition": partition,
        "source.offset": offset,
    }
    rows = within_days(documents, since, until)
    if since is not None:
        rows = rows.where(F.col("event_time") >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.where(F.col("event_time") < F.lit(until).cast("timestamp"))
    for name, value in equal.items():
        if value is not None:
            rows = rows.where(F.col(name) == value)
    if keyword is not None:
        rows = rows.where(keyword)
    order = [F.desc("event_time"), F.desc("ingest.ingested_at"), F.asc("id")]
    return rows.orderBy(*order).limit(limit)


def has_token(text: Column, token: str) -> Column:
    """Whole-word match, ignoring case; several words must stand one after the other.

    Words are runs of letters and digits of any script, and underscores.
    """
    joined = F.regexp_replace(F.lower(text), GAPS, " ")
    words = F.regexp_replace(F.lower(F.lit(token)), GAPS, " ")
    wanted = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    found = F.contains(F.concat(F.lit(" "), joined, F.lit(" ")), wanted)
    return F.coalesce(found & (F.trim(words) != ""), F.lit(False))


def keyword(token: str) -> Column:
    """Token in the message, the error message or the stack trace."""
    return (
        has_token(F.col("message"), token)
        | has_token(F.col("error.message"), token)
        | has_token(F.col("error.stack_trace"), token)
    )


def top_terms(documents: DataFrame, term: Column, limit: int = 10) -> DataFrame:
    return (
        documents.groupBy(term.alias("term"))
        .agg(F.count("*").alias("n"))
        .where(F.col("term").isNotNull())
        .orderBy(F.desc("n"), "term")
        .limit(limit)
    )


def storm_summary(
    documents: DataFrame, cfg: PipelineConfig = PipelineConfig(), traces: int = 3
) -> DataFrame:
    """Counts and samples per fingerprint and window, with a few trace ids.

    Reads ``documents`` twice: pass a stored table, not a plan that still parses.

    Trace ids are ranked with a per-group limit that Spark applies before the
    shuffle, so a storm of one fingerprint never gathers all its ids anywhere.
    """
    width = f"{cfg.merge_window_millis} milliseconds"
    keys = ["hash", "window_start"]
    ids = (
        documents.where(F.col("event.hash").isNotNull() & F.col("trace.id").isNotNull())
        .select(
            F.col("event.hash").alias("hash"),
            F.window("event_time", width)["start"].alias("window_start"),
            F.col("trace.id").alias("trace_id"),
        )
        .distinct()
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("trace_id"))
    samples = (
        ids.withColumn("rank", rank)
        .where(F.col("rank") <= traces)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("trace_id")).alias("trace_ids"))
    )
    return merge_tumbling(documents, cfg).join(samples, keys, "left")


def stream_inventory(documents: DataFrame) -> DataFrame:
    """Volume per stream and tenant, to find tenants that deserve a stream of their own."""
    return documents.groupBy("data_stream", F.col("tenant.id").alias("tenant_id")).agg(
        F.count("*").alias("documents"),
        F.sum(F.char_length("message")).alias("characters"),
        F.min("event_time").alias("oldest"),
        F.max("event_time").alias("newest"),
    )
