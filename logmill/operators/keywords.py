"""A word index over the folders of a routed table, so that a search reads only folders that can match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table_exists, write_parts
from .search import GAPS, keyword

PLACE = ["data_stream", "dt", "folder"]
# so many folders at most are named to the scan; a word of more is joined by their names instead
MAX_LISTED = 20_000


def words_of(text: Column) -> Column:
    """Words in lower case as the keyword search tells them apart."""
    return F.array_remove(F.split(F.lower(text), GAPS, -1), "")


def folder_words(documents: DataFrame) -> DataFrame:
    """``(word, data_stream, dt, folder)`` of a routed table: every word of a folder once.

    Copies of a word are dropped before the shuffle, so a word of all rows costs one row
    per task and folder.
    """
    texts = F.array("message", "error.message", "error.stack_trace")
    each = F.explode(F.array_distinct(F.flatten(F.transform(texts, lambda t: F.coalesce(words_of(t), F.array())))))
    return documents.select("data_stream", "dt", F.col("write_id").alias("folder"), each.alias("word")).distinct()


def folders_of(spark: SparkSession, table: str) -> DataFrame:
    """``(data_stream, dt, folder, path)`` of a routed table from file names; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    path = F.regexp_replace("path", "/[^/]*$", "").alias("path")
    return files.select("data_stream", "dt", F.col("write_id").alias("folder"), path).distinct()


def index_words(spark: SparkSession, table: str, index: str, write_id: str) -> None:
    """Add the folders that the index at ``index`` does not know yet; repeating it adds nothing twice.

    A folder never changes after its write ends, so it is indexed once.  Words are sorted
    over files, so that a look-up reads few row groups; a word of very many folders spans
    several files.
    """
    folders = folders_of(spark, table)
    if table_exists(spark, index):
        # a run of the same name replaces what it wrote before
        known = indexed_folders(spark.read.parquet(index).where(F.col("write_id") != write_id))
        folders = _match(folders, known, "left_anti")
    words = folder_words(read_folders(spark, table, folders))
    # a folder without words is known by the empty one
    entries = words.unionByName(folders.drop("path").withColumn("word", F.lit("")))
    keys = ["word", *PLACE]
    write_parts(entries.repartitionByRange(*keys).sortWithinPartitions(*keys), index, write_id)


def indexed_folders(index: DataFrame) -> DataFrame:
    return index.where(F.col("word") == "").select(*PLACE).distinct()


def _match(folders: DataFrame, others: DataFrame, how: str) -> DataFrame:
    return folders.join(others, [folders[c].eqNullSafe(others[c]) for c in PLACE], how)


def read_folders(spark: SparkSession, table: str, folders: DataFrame) -> DataFrame:
    """Rows of some folders of a routed table; up to ``MAX_LISTED`` of them, only these are opened."""
    rows = spark.read.parquet(table)
    few = folders.select("path").limit(MAX_LISTED + 1).collect()
    if len(few) > MAX_LISTED:
        same = [rows.data_stream == folders.data_stream, rows.dt.eqNullSafe(folders.dt), rows.write_id == folders.folder]
        return rows.join(folders, same, "left_semi")
    if not few:
        return rows.where(F.lit(False))
    return spark.read.schema(rows.schema).option("basePath", table).parquet(*[r.path for r in few])


def search_words(spark: SparkSession, table: str, index: str, token: str) -> DataFrame:
    """Rows of a routed table with ``token`` in one of their texts, as :func:`~.search.keyword` finds them.

    Only folders that hold every word of ``token``, and folders that are not indexed
    yet, are read.
    """
    words = spark.range(1).select(F.array_distinct(words_of(F.lit(token))).alias("w")).first().w
    if not words:
        return spark.read.parquet(table).where(F.lit(False))
    if not table_exists(spark, index):
        return spark.read.parquet(table).where(keyword(token))
    entries = spark.read.parquet(index)
    holding = (
        entries.where(F.col("word").isin(words))
        .groupBy(*PLACE)
        .agg(F.count_distinct("word").alias("n"))
        .where(F.col("n") == len(words))
        .select(*PLACE)
    )
    folders = folders_of(spark, table)
    wanted = _match(folders, holding, "left_semi").unionByName(_match(folders, indexed_folders(entries), "left_anti"))
    return read_folders(spark, table, wanted).where(keyword(token))
