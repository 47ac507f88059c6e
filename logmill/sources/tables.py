"""Sinks and scans of the lake tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, staged, workspace


def new_write_id(kind: str = "job") -> str:
    """Name of one write, different from that of every other write."""
    return f"{kind}-{uuid.uuid4().hex}"


def write_routed(
    documents: DataFrame, path: str, write_id: str | None = None, max_records: int = 2_000_000
) -> None:
    """Write documents to their stream, one folder per stream, day and write.

    Every writer uses these folders, so streams, jobs, replays and compaction share a
    table.  A write replaces only what the same ``write_id`` wrote before: repeating a
    micro-batch duplicates nothing, and no writer touches rows of another one.
    ``rebalance`` lets adaptive execution split the folder of a busy stream over
    several tasks and pack small ones together, so neither skew nor tiny files build up.
    """
    keys = ["data_stream", "dt"]
    rows = documents.withColumn("dt", F.to_date("event_time"))
    _replace(rows.hint("rebalance", *keys), path, keys, write_id, max_records)


def write_dead_letters(rows: DataFrame, path: str, write_id: str | None = None) -> None:
    """Write dead-letter documents, one folder per day and write."""
    _replace(rows.withColumn("dt", F.to_date("event_time")), path, ["dt"], write_id)


def _replace(
    rows: DataFrame, path: str, keys: list[str], write_id: str | None, max_records: int = 2_000_000
) -> None:
    named = rows.withColumn("write_id", F.lit(write_id or new_write_id()))
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*keys, "write_id")
        .parquet(path)
    )


def write_parts(rows: DataFrame, path: str, write_id: str) -> None:
    """Rows of one write beside those of other writes, in a table without days."""
    _replace(rows, path, [], write_id)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_per_id(
    rows: DataFrame, id_column: str = "id", order: str = "ingested_at", ties: tuple[str, ...] | None = None
) -> DataFrame:
    """The row written last per id, as a keyed store would hold it.

    An aggregation rather than a ranking: copies of one id are combined before
    the shuffle, however many there are.  Rows of equal ``order`` are told apart by the
    columns ``ties`` (the topic partition and offset of ``source``, where rows have it).
    """
    if ties is None:
        ties = ("source.topic", "source.partition", "source.offset") if "source" in rows.columns else ()
    others = [c for c in rows.columns if c != id_column]
    place = F.struct(F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    return (
        rows.groupBy(id_column)
        .agg(F.max_by(F.struct(*others), place).alias("_last"))
        .select(id_column, "_last.*")
    )


def upsert_by_day(
    spark: SparkSession, rows: DataFrame, path: str, id_column: str = "id", order: str = "ingested_at"
) -> None:
    """Keyed write: rows replace stored rows of the same id within their day partition."""
    fresh = rows.withColumn("dt", F.to_date("event_time"))
    target = fresh
    if table_exists(spark, path):
        days = fresh.select("dt").distinct()
        stored = spark.read.parquet(path).join(days, "dt", "left_semi")
        target = stored.unionByName(fresh)
    merged = scratch_path(spark, "upsert")
    latest_per_id(target, id_column, order).write.parquet(merged)
    spark.read.parquet(merged).hint("rebalance", "dt").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("dt").parquet(path)


def upsert_by_id(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    id_column: str = "id",
    order: str = "ingested_at",
    ties: tuple[str, ...] = (),
    write_id: str | None = None,
) -> None:
    """Keyed write over all days: one row per id, the one last by ``order``, ``ties`` and day.

    A row whose day changed leaves its old day.  Where an id is stored stands in a log of
    narrow rows beside the table (``path``-days), so that only the days that gain or lose
    rows are read and rewritten, and rows that come too late change nothing.  Winners
    are decided on narrow columns; each whole row is joined once.

    The result does not depend on the order of the writes.  The table is written before
    the log: a write that failed half-way is repeated with the same rows (and
    ``write_id``) before others, and ends as if it had not failed.  One writer at a time.
    Rows without ``order`` or without id lose against others of the same (or no) id.
    """
    log = f"{path}-days"
    with workspace(spark, "upsert"):
        fresh = staged(rows.withColumn("dt", F.to_date("event_time")), "rows")
        at = [F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], F.col("dt").alias("day")]
        key = F.col(id_column).alias("key")
        # the row id decides between equal places of one write
        new = fresh.groupBy(key).agg(F.max(F.struct(F.struct(*at).alias("place"), "row_id")).alias("new"))
        new = new.select("key", "new.place", "new.row_id")
        if table_exists(spark, log):
            stored = read_table(spark, log).groupBy("key").agg(F.max("place").alias("old"))
            last = new.join(stored, new.key.eqNullSafe(stored.key), "left").drop(stored.key)
            won = last.where(F.col("old").isNull() | (F.col("place") >= F.col("old")))
        else:
            won = new.withColumn("old", F.lit(None).cast(new.schema["place"].dataType))
        write_path = scratch_path(spark, "won")
        won.write.parquet(write_path)
        won = read_table(spark, write_path)
        # one value per day that gains or loses rows
        gains = {r.day for r in won.select("place.day").distinct().collect()}
        loses = {r.day for r in won.where("old IS NOT NULL").select("old.day").distinct().collect()}
        target = fresh.join(won.select("row_id"), "row_id", "left_semi").drop("row_id")
        emptied = set()
        if table_exists(spark, path):
            table = read_table(spark, path)
            ids = won.select(F.col("key").alias("won_key"))
            others = table.join(ids, table[id_column].eqNullSafe(ids.won_key), "left_anti")
            left = others.where(_on_days(loses - gains)).select("dt").distinct()
            emptied = loses - gains - {r.dt for r in left.collect()}
            target = others.where(_on_days(gains | loses)).unionByName(target, allowMissingColumns=True)
        target.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "dt"
        ).parquet(path)
        drop_folders(spark, [f"{path}/dt={day or '__HIVE_DEFAULT_PARTITION__'}" for day in sorted(emptied, key=str)])
        write_parts(won.select("key", "place"), log, write_id or new_write_id("upsert"))


def _on_days(days: set) -> Column:
    known = sorted(d for d in days if d is not None)
    inside = F.col("dt").isin(known) if known else F.lit(False)
    return (inside | F.col("dt").isNull()) if None in days else inside


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def partition_writes(spark: SparkSession, path: str, data_stream: str, dt: str) -> list[str]:
    """Folders of the writes of one stream and day."""
    fs, _ = _file_system(spark, path)
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data_stream={data_stream}/dt={dt}/write_id=*")
    return sorted(str(status.getPath()) for status in fs.globStatus(glob) or [])


def stream_partitions(spark: SparkSession, path: str) -> DataFrame:
    """``(data_stream, dt, folder)`` of a routed table, from folder names alone."""
    fs, _ = _file_system(spark, path)
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data_stream=*/dt=*")
    folders = [str(status.getPath()) for status in fs.globStatus(glob) or []]
    names = spark.createDataFrame([(f,) for f in folders], "folder string")
    return names.select(
        F.regexp_extract("folder", r"data_stream=([^/]+)/", 1).alias("data_stream"),
        F.to_date(F.regexp_extract("folder", r"/dt=([0-9-]+)", 1)).alias("dt"),
        "folder",
    )


def drop_folders(spark: SparkSession, folders: list[str]) -> int:
    """Remove whole partition folders; returns how many were there."""
    removed = 0
    for folder in folders:
        fs, target = _file_system(spark, folder)
        removed += bool(fs.delete(target, True))
    return removed
