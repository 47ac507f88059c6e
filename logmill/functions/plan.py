"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_barrier(df: DataFrame) -> DataFrame:
    """Keep later filters above the projections of ``df``.

    Catalyst moves a filter below a projection by repeating the projected
    expressions inside it, which for a parsed payload means parsing again per
    condition.  A projection with a non-deterministic member stops that, while
    unused columns are still pruned.
    """
    marked = df.withColumn("_task", F.spark_partition_id())
    return marked.where(F.col("_task") >= 0).drop("_task")


def within_days(rows: DataFrame, since=None, until=None) -> DataFrame:
    """A stored table narrowed to the day folders that a time range touches."""
    if "dt" not in rows.columns:
        return rows
    if since is not None:
        rows = rows.where(F.col("dt") >= F.to_date(F.lit(since).cast("timestamp")))
    if until is not None:
        rows = rows.where(F.col("dt") <= F.to_date(F.lit(until).cast("timestamp")))
    return rows
