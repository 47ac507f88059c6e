"""Selection of dead letters and their way back into the document path."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.plan import within_days
from ..functions.text import has_text, text_or

# Replay limit if none is given, and the largest one.
DEFAULT_LIMIT = 100
MAX_LIMIT = 5_000


@dataclass(frozen=True)
class ReplayRequest:
    since: datetime | str | None = None
    until: datetime | str | None = None
    error_type: str | None = None
    topic: str | None = None
    # None: no limit; 0 or less: the default
    limit: int | None = DEFAULT_LIMIT
    dry_run: bool = True
    # the most that a limited request may ask for
    max_limit: int = MAX_LIMIT

    def __post_init__(self) -> None:
        if self.limit is not None and self.limit > self.max_limit:
            raise ValueError(f"limit {self.limit} is above {self.max_limit}; use None for all rows")

    @property
    def safe_limit(self) -> int | None:
        return DEFAULT_LIMIT if self.limit is not None and self.limit <= 0 else self.limit


def matching(dead_letters: DataFrame, request: ReplayRequest) -> DataFrame:
    """Dead letters within the time range, of the error type and topic asked for.

    All conditions are on top-level columns, so they reach the storage scan; a stored
    table is narrowed to the days of the time range.
    """
    rows = within_days(dead_letters, request.since, request.until)
    if request.since is not None:
        rows = rows.where(F.col("event_time") >= F.lit(request.since).cast("timestamp"))
    if request.until is not None:
        rows = rows.where(F.col("event_time") <= F.lit(request.until).cast("timestamp"))
    if request.error_type and request.error_type.strip():
        rows = rows.where(F.col("error_type") == request.error_type)
    if request.topic and request.topic.strip():
        rows = rows.where(F.col("topic") == request.topic)
    return rows


def select_for_replay(dead_letters: DataFrame, request: ReplayRequest) -> DataFrame:
    """The oldest matching dead letters up to the limit of the request, or all of them."""
    rows = matching(dead_letters, request)
    if request.safe_limit is None:
        return rows
    return rows.orderBy("event_time", "id").limit(request.safe_limit)


def rebuild_messages(dead_letters: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Dead letters to messages; a blank payload cannot be replayed and is left out.

    Partition and offset do not carry over: a replayed message is a new one.
    """
    return dead_letters.where(has_text(F.col("payload"))).select(
        text_or(F.col("topic"), cfg.default_topic).alias("topic"),
        F.lit(-1).cast("int").alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
        F.col("message_key").alias("key"),
        F.col("payload").alias("value"),
        F.col("event_time").alias("timestamp"),
    )


def replay_counts(selected: DataFrame, processed: DataFrame, dry_run: bool) -> DataFrame:
    """One row: matched, replayed, failed and skipped counts.

    ``processed`` is the document path applied to the rebuilt messages before
    any filter; filtered and suppressed rows count as replayed.
    """
    zero = F.lit(0)
    blank = (~has_text(F.col("payload"))).cast("int")
    rows = selected.select(F.lit(1).alias("matched"), zero.alias("failed"), blank.alias("skipped"))
    if not dry_run:
        failed = F.col("failure").isNotNull().cast("int")
        rows = rows.unionByName(
            processed.select(zero.alias("matched"), failed.alias("failed"), zero.alias("skipped"))
        )
    matched, failed, skipped = (
        F.coalesce(F.sum(name), zero).cast("bigint") for name in ("matched", "failed", "skipped")
    )
    nothing = zero.cast("bigint")
    return rows.agg(
        matched.alias("matched"),
        (nothing if dry_run else matched - skipped - failed).alias("replayed"),
        (nothing if dry_run else failed).alias("failed"),
        (nothing if dry_run else skipped).alias("skipped"),
    )
