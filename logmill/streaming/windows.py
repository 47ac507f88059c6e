"""Anchored duplicate windows over a stream: micro-batches and a table of open windows.

Every micro-batch is folded like a static table (:mod:`logmill.operators.merge`), so one
fingerprint with a third of all rows spans many tasks.  The windows that are open
between batches are a table of their own, keyed by fingerprint and batch: a batch reads
what earlier batches left for its fingerprints, and adds what it leaves itself.  A
repeated batch reads the same and replaces what its first attempt wrote.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig
from ..operators.merge import aggregate_rows, emitted, folded, has_window, last_of_windows, unplaced
from ..session import checkpointed, remove_folder

_FOLDER = re.compile(r"/(delta|whole)-(\d+)$")
# a row without fingerprint keeps the latest event time seen
_WINDOW = "hash binary, window_us bigint, ordinal bigint, batch bigint"


class OpenWindows:
    """The table of open windows of one stream, below ``path``.

    ``delta-N`` holds the fingerprints that batch N touched, ``whole-N`` all windows open
    after it; the latter is written every ``whole_every`` batches and makes older folders
    useless.  A window that was closed is a row without ``window_us``.  ``doc`` is the last
    document of a window, where a summary is due for it.
    """

    def __init__(self, spark: SparkSession, path: str, doc: T.StructType | None = None, whole_every: int = 20):
        self.spark, self.path, self.whole_every = spark, path.rstrip("/"), whole_every
        self.schema = T.StructType.fromDDL(_WINDOW) if doc is None else T.StructType.fromDDL(_WINDOW).add("doc", doc)

    def _folders(self) -> list[tuple[int, str, str]]:
        """(batch, kind, folder) of the finished writes: a few tens of names."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        done = hadoop.Path(f"{self.path}/*/_SUCCESS")
        found = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
        parents = [str(status.getPath().getParent()) for status in found or []]
        named = [(m, p) for p in parents if (m := _FOLDER.search(p))]
        return sorted((int(m[2]), m[1], p) for m, p in named)

    def before(self, batch: int) -> DataFrame:
        """The latest state per fingerprint left by batches before ``batch``, closed ones included."""
        folders = [f for f in self._folders() if f[0] < batch]
        start = max((b for b, kind, _ in folders if kind == "whole"), default=-1)
        used = [path for b, kind, path in folders if (kind == "whole" and b == start) or (kind == "delta" and b > start)]
        if not used:
            return self.spark.createDataFrame([], self.schema)
        rest = [c for c in self.schema.names if c not in ("hash", "batch")]
        rows = self.spark.read.schema(self.schema).parquet(*used)
        # the batch decides; without the row of the clock every fingerprint is there once a batch
        return rows.groupBy("hash").agg(F.max_by(F.struct("batch", *rest), "batch").alias("s")).select("hash", "s.*")

    def save(self, batch: int, rows: DataFrame) -> None:
        rows = rows.withColumn("batch", F.lit(batch).cast("bigint")).select(*self.schema.names)
        rows.write.mode("overwrite").parquet(f"{self.path}/delta-{batch}")
        if (batch + 1) % self.whole_every == 0:
            still = self.before(batch + 1).where("window_us IS NOT NULL")
            still.write.mode("overwrite").parquet(f"{self.path}/whole-{batch}")
            # a repetition of this batch still needs what is before it
            wholes = [b for b, kind, _ in self._folders() if kind == "whole" and b < batch]
            for b, kind, path in self._folders():
                if wholes and (b < max(wholes) or (b == max(wholes) and kind == "delta")):
                    remove_folder(self.spark, path)


def open_windows(spark: SparkSession, path: str, documents: DataFrame, cfg: PipelineConfig) -> OpenWindows:
    """The table for streams of ``documents``; only a final flush has to keep documents."""
    columns = [f for f in documents.schema.fields if f.name != "row_id"]
    doc = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns])
    return OpenWindows(spark, path, doc if cfg.merge_flush == "final" else None)


def _summaries(closed: DataFrame) -> DataFrame:
    """Documents of closed windows (doc, window_us, ordinal) as rows to be summed up."""
    due = closed.where("doc IS NOT NULL")
    return due.select("doc.*", F.timestamp_micros("window_us").alias("window_start"), "ordinal", F.lit("aggregate").alias("action"))


def merge_batch(
    documents: DataFrame,
    windows: OpenWindows,
    batch: int,
    cfg: PipelineConfig = PipelineConfig(),
    lateness_millis: int | None = None,
) -> DataFrame:
    """Rows to write from one micro-batch of staged ``documents``; saves the windows it leaves open.

    Arrival order holds within a batch, and batches follow each other, so any cut of the
    input into batches gives the rows of :func:`logmill.operators.merge.merge_anchored`
    over the whole.  Late rows join the window that is open.  With ``lateness_millis`` a
    window closes once the latest event time is that much past its end: its state goes,
    a summary that is due is written, and rows later than that find it closed.
    """
    final = cfg.merge_flush == "final"
    understood = has_window()
    own = documents.where(understood)
    state = checkpointed(windows.before(batch))
    stored = state.where("hash IS NOT NULL AND window_us IS NOT NULL")
    touched = own.select(F.unhex("event.hash").alias("hash")).distinct()
    seeds = stored.join(touched, "hash", "left_semi").select("hash", "window_us", "ordinal")
    found = checkpointed(folded(own, cfg, seeds))
    told = _emitted_raw(found, cfg) if final else emitted(found, cfg)
    rows = own.join(told, "row_id").drop("row_id").unionByName(unplaced(documents.where(~understood).drop("row_id")))

    lasts = last_of_windows(found)
    latest = lasts.groupBy("hash").agg(F.max(F.struct("window_us", "ordinal", "row_id")).alias("l")).select("hash", "l.*")
    # one row each: the largest event time now and before
    seen = own.agg(F.max(F.unix_micros("event_time")).alias("us")).unionByName(state.where("hash IS NULL").select(F.col("window_us").alias("us")))
    clock = seen.agg(F.max("us").alias("us")).first()["us"]
    if final:
        packed = F.struct(*[F.col(f"d.{c}").alias(c) for c in documents.columns if c != "row_id"])
        over = F.col("ordinal") > cfg.merge_threshold
        before = stored.select("hash", "window_us", F.col("doc").alias("stored"))
        # the last row of a window is one of this batch or, if nothing joined it, the stored one
        ends = lasts.where(over).alias("w").join(own.alias("d"), "row_id", "left").select("w.*", F.when(F.col("d.id").isNotNull(), packed).alias("fresh"))
        ends = ends.join(before, ["hash", "window_us"], "left").select("hash", "window_us", "ordinal", F.coalesce("fresh", "stored").alias("doc"))
        ends = checkpointed(ends)
        open_now = latest.join(ends.select("hash", "window_us", "doc"), ["hash", "window_us"], "left").drop("row_id")
        open_now = checkpointed(open_now)
        closed = ends.join(open_now.select("hash", "window_us"), ["hash", "window_us"], "left_anti")
        rows = rows.unionByName(_summaries(closed))
    else:
        open_now = latest.drop("row_id")
    delta = open_now
    if lateness_millis is not None and clock is not None:
        limit = clock - 1000 * (cfg.merge_window_millis + lateness_millis)
        others = stored.drop("batch").join(touched, "hash", "left_anti")
        due = F.col("window_us") <= limit
        expired = open_now.where(due).unionByName(others.where(due))
        if final:
            rows = rows.unionByName(_summaries(expired))
        gone = expired.select("hash").withColumns({"window_us": F.lit(None).cast("bigint"), "ordinal": F.lit(None).cast("bigint")})
        delta = open_now.where(~due).unionByName(gone, allowMissingColumns=True)
    if clock is not None:
        ticking = documents.sparkSession.createDataFrame([(None, clock, 0)], "hash binary, window_us bigint, ordinal bigint")
        delta = delta.unionByName(ticking, allowMissingColumns=True)
    windows.save(batch, delta)
    return aggregate_rows(rows, cfg).drop("window_start", "ordinal")


def _emitted_raw(found: DataFrame, cfg: PipelineConfig) -> DataFrame:
    rows = found.where((F.col("row_id").isNotNull()) & (F.col("ordinal") <= cfg.merge_threshold))
    return rows.select("row_id", F.timestamp_micros("window_us").alias("window_start"), "ordinal", F.lit("raw").alias("action"))


def close_windows(windows: OpenWindows, batch: int, cfg: PipelineConfig) -> DataFrame:
    """Summaries of all windows still open before ``batch``, for the end of a stream; saves that none is."""
    state = checkpointed(windows.before(batch))
    rest = state.where("hash IS NOT NULL AND window_us IS NOT NULL")
    gone = rest.select("hash").withColumns({"window_us": F.lit(None).cast("bigint"), "ordinal": F.lit(None).cast("bigint")})
    clock = state.where("hash IS NULL").select("hash", "window_us", "ordinal")
    windows.save(batch, gone.unionByName(clock).withColumns({c: F.lit(None).cast(windows.schema[c].dataType) for c in windows.schema.names if c == "doc"}))
    return aggregate_rows(_summaries(rest), cfg).drop("window_start", "ordinal")
