"""Session settings the transforms rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a later duplicate JSON key replaces an earlier one
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # HotSpot never compiles methods above this size: split projections run faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# a few seconds of parsing
TASK_ROWS = 20_000

_fallback_dirs: dict[str, str] = {}
_workspace: contextvars.ContextVar[str | None] = contextvars.ContextVar("workspace", default=None)
_checkpointing = threading.Lock()


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the expressions depend on; safe to call often."""
    # tasks get the helper functions with the job, wherever the package is installed
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may do without it; it then gets a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="logmill-")
    return _fallback_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_workspace.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any store that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder of any store that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


@contextlib.contextmanager
def workspace(spark: SparkSession, name: str = "work") -> Iterator[str]:
    """Staged tables and checkpoints made inside go when the block ends.

    For work that repeats, such as a micro-batch: write the results before leaving.
    """
    folder = scratch_path(spark, name)
    token = _workspace.set(folder)
    try:
        yield folder
    finally:
        _workspace.reset(token)
        remove_folder(spark, folder)


def tasks_for(rows: int) -> int:
    """How many tasks or files costly parsing of ``rows`` messages is dealt to."""
    return -(-rows // TASK_ROWS)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows to tasks of at most about ``TASK_ROWS``, and to all cores, for costly parsing.

    Splits of a file count by the rows they hold: many of them hold none, since a row group is
    read whole by one.  Rows are counted from the files' own figures.  Input that already
    comes in such tasks passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = df.select(F.spark_partition_id().alias("part")).groupBy("part").count()
    held = sizes.agg(F.count("*").alias("parts"), F.sum("count").alias("n"), F.max("count").alias("most")).first()
    if held.parts >= cores and held.most <= 2 * TASK_ROWS:
        return df
    return df.repartition(max(cores, tasks_for(held.n or 0)))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partitions and row order stay as they are."""
    spark = df.sparkSession
    # the folder is a setting of the whole application
    with _checkpointing:
        spark.sparkContext.setCheckpointDir(_workspace.get() or shared_dir(spark))
        return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to a shared parquet table, giving each row a stable ``row_id``.

    Costly parsing then runs once, later passes read only the columns they need,
    and a lost executor costs a re-read instead of a re-parse.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.withColumn("row_id", F.monotonically_increasing_id()).write.mode("error").parquet(target)
    return spark.read.schema(_schema_with_id(df)).parquet(target)


def _schema_with_id(df: DataFrame):
    return T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
        + [T.StructField("row_id", T.LongType(), True)]
    )
