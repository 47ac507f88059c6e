"""Message sources.  All give ``topic, partition, offset, key, value, timestamp``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import has_text, text_or
from ..operators.offsets import LATEST
from ..schemas import MESSAGES


def _from_broker(raw: DataFrame) -> DataFrame:
    return raw.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def topic_stream(
    spark: SparkSession, servers: str, topics: list[str], max_per_trigger: int = 1_000_000, **options: str
) -> DataFrame:
    """Subscribe to broker topics; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .options(**options)
    )
    return _from_broker(reader.load())


def scan_options(starting: str, ending: str | None = None) -> dict[str, str]:
    """Options of a scan between two offset JSONs (see :func:`logmill.operators.offsets.offsets_json`).

    The topic partitions of ``starting`` are read, each up to its offset in ``ending`` or
    else to its end.  One that only ``ending`` names is an error: it would be left out.
    """
    first = json.loads(starting)
    last = json.loads(ending) if ending is not None else {}
    extra = [f"{t}-{p}" for t, at in last.items() for p in at if p not in first.get(t, {})]
    if extra:
        raise ValueError(f"no starting offset for {', '.join(sorted(extra))}")
    assigned = {t: sorted(map(int, at)) for t, at in first.items()}
    until = {t: {p: last.get(t, {}).get(p, LATEST) for p in at} for t, at in first.items()}
    text = {"assign": assigned, "startingOffsets": first, "endingOffsets": until}
    return {k: json.dumps(v, separators=(",", ":")) for k, v in text.items()}


def topic_batch(
    spark: SparkSession,
    servers: str,
    topics: list[str] | None = None,
    starting: str | None = None,
    ending: str | None = None,
    **options: str,
) -> DataFrame:
    """Whole topics, or their partitions between two offset JSONs; needs the Kafka connector."""
    scope = {"subscribe": ",".join(topics or [])} if starting is None else scan_options(starting, ending)
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
    return _from_broker(reader.options(**scope, **options).load())


def file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of messages."""
    reader = spark.readStream.format(fmt).schema(MESSAGES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def message_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(MESSAGES).load(path)


def no_messages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MESSAGES)


def text_lines(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Every line of text files as one message without a broker offset."""
    return ad_hoc(spark.read.text(path).withColumnRenamed("value", "payload"), topic)


def ad_hoc(requests: DataFrame, default_topic: str = PipelineConfig.default_topic) -> DataFrame:
    """Hand-made messages ``(payload[, topic, key])``.

    A missing topic takes the default; a blank payload is not accepted.
    """
    columns = requests.columns
    none = F.lit(None).cast("string")
    topic = F.col("topic") if "topic" in columns else none
    key = F.col("key") if "key" in columns else none
    return requests.where(has_text(F.col("payload"))).select(
        text_or(topic, default_topic).alias("topic"),
        F.lit(-1).cast("int").alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
        key.alias("key"),
        F.col("payload").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
