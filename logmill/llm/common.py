"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import folder_bytes, remove_folder, scratch_path

# a kept table of so many bytes is small: more tasks than cores would take longer to start than to run
SMALL_BYTES = 16 << 20

# tasks get these functions with the job, wherever the package is installed
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from there.

    Cuts the lineage: what follows neither repeats the work before it nor depends
    on the executor that did it.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)
    kept.kept_at = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`keep` that nothing refers to any more."""
    for df in tables:
        path = df.__dict__.pop("kept_at", None)
        if path is not None:
            remove_folder(df.sparkSession, path)


def packed(made_from: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What puts tables made from the kept one, of about as many narrow rows, into a task a core.

    Only if that one is small; else they stay as they are.
    """
    spark, path = made_from.sparkSession, made_from.__dict__.get("kept_at")
    if path is None or folder_bytes(spark, path) > SMALL_BYTES:
        return lambda df: df
    return lambda df: df.coalesce(spark.sparkContext.defaultParallelism)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def worker_state(name: str) -> dict:
    """A dictionary that outlives a task in its Python worker; callers bound its size."""
    holder = sys.modules.setdefault("_training_data_worker", types.ModuleType("_training_data_worker"))
    return holder.__dict__.setdefault(name, {})


def bounded_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """``df``, with rows going to Python a few MB at a time rather than 10,000 at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def text_slices(batch, columns: Sequence[str], limit: int = 4 << 20):
    """Arrow batches cut into slices of about ``limit`` bytes of their first column's text.

    A single longer text stays whole; it is its own slice.
    """
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(columns[0])), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def prefix_sums(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows in front, per ``group``.

    Rows are range-partitioned by (group, order), so a hot group spans many tasks.
    Each partition is summed up, the few sums are chained, and rows are summed only
    within their partition.
    """
    keys = [F.col(g).asc_nulls_last() for g in group] + list(order)
    placed = keep(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    blocks = placed.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"))
    chain = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*group, "_part", F.coalesce(F.sum("_sum").over(chain), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = [F.col(f"b.{g}").eqNullSafe(F.col(f"r.{g}")) for g in [*group, "_part"]]
    summed = placed.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = summed.alias("r").join(blocks.alias("b"), on)
    return joined.select("r.*", (F.col("b._before") + F.col("r._inner")).alias("before")).drop("_inner", "_part")


def one_text_per_id(docs: DataFrame) -> DataFrame:
    """``docs`` without the further texts of an id: of several the one of smallest hash stays.

    Repeated rows stay.  Ids with several texts are the exception, so the table of them
    is small and Spark broadcasts it; documents are not shuffled for it.
    """
    h = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(h).alias("low"), F.max(h).alias("high")).where("low <> high")
    several = keep(several.select("doc_id", "low"), "ids-of-several-texts")
    other = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.xxhash64("d.text") != F.col("s.low"))
    return docs.alias("d").join(several.alias("s"), other, "left_anti")
