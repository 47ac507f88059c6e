"""A corpus pipeline from the training-data operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import keep, table
from logmill.llm.mix import mixed_documents
from logmill.llm.near_copies import without_near_copies
from logmill.llm.pieces import decoded, encode, model_path
from logmill.llm.repeats import cut_repeats
from logmill.llm.toxicity import train, without_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a lexicon learned from ``labels`` scores 0.5 or more."""
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies, the one of smallest doc_id."""
    return without_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document of smallest doc_id that holds them."""
    return cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, sources by the weights 3, 1, 2."""
    return mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of the text, their number and score, and whether they decode to it."""
    told = docs.select("doc_id", "source", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = encode(told, model_path()).select("doc.doc_id", "doc.source", "doc.text_hash", "ids", "score")
    # kept: encoding and decoding in one stage would take two Python workers a task
    rows = keep(rows, "pieces")
    return rows.select(
        "doc_id",
        "source",
        "ids",
        F.size("ids").alias("n_tokens"),
        "score",
        (F.xxhash64(decoded(F.col("ids"), model_path())) == F.col("text_hash")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("mix_sources", mix_sources),
    ("sentence_pieces", encode_pieces),
]
# learned scores, alignments and segmentations are not SQL: the stages are tested one by one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each over what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
