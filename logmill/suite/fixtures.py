"""Log messages and write outcomes derived from the given tables.

``events`` becomes a message log: every event is one message whose payload shape
(plain text, OTLP JSON, flat JSON, access log, blank) follows from its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.outcomes import dead_letter_documents, dead_letter_rows, failure_class
from ..session import spread

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_VALUE = """
CASE event_id % 10
  WHEN 0 THEN concat('plain line ', event_id)
  WHEN 1 THEN concat('{"resourceLogs":[{"resource":{"attributes":[{"key":"service.name","value":{"stringValue":"svc-', event_type,
    '"}},{"key":"region","value":{"stringValue":"r', user_id % 3, '"}}]},"scopeLogs":[{"logRecords":[]},{"logRecords":[{"timeUnixNano":"', unix_micros(at) * 1000,
    '","severityText":"ERROR","body":{"stringValue":"', event_type, ' broke off at cart ', event_id,
    '"},"attributes":[{"key":"error.type","value":{"stringValue":"E', user_id % 2, '"}},{"key":"n","value":{"intValue":"', event_id, '"}}]},{"body":{"stringValue":"second ', event_id, '"}}]}]}]}')
  WHEN 2 THEN concat('{"timestamp":', unix_millis(at), ',"level":"DEBUG","service":"svc ', event_type,
    '","msg":"', event_type, ' broke off at cart ', event_id, '","severityNumber":', event_id % 24, '}')
  WHEN 3 THEN ''
  WHEN 4 THEN concat('{"timestamp":"', date_format(at, "{iso}"), '","severity":"INFO","serviceName":"gw","body":"access","attributes":{"url.path":"',
    CASE WHEN event_id % 20 = 4 THEN '/health' ELSE concat('/p/', event_id % 7) END, '","tenant.id":"t', user_id % 3, '","userPassword":"pw', user_id, '"}}')
  WHEN 5 THEN concat('{"timestamp":"', date_format(at, "{iso}"), '","severityText":"INFO","serviceName":"svc-', event_type, '","body":"', event_type,
    ' broke off at cart ', event_id, '","traceId":"tr', user_id, '","region":"home","exception":{"type":"X', user_id % 4, '","message":"m ', event_id,
    '","stacktrace":"at line ', event_id, '"},"attributes":{"tenant.id":"t', user_id % 3, '"}}')
  WHEN 6 THEN concat('{"timestamp":"not a time ', event_id, '","serviceName":"svc-', event_type, '","body":"late"}')
  ELSE concat('{"timestamp":"', date_format(at, "{iso}"), '","severityText":"', CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END,
    '","serviceName":"svc-', event_type, '","body":"', event_type, ' broke off at cart ', event_id, '","traceId":"tr', user_id,
    '","attributes":{"tenant.id":"t', user_id % 3, '","userPassword":"pw', user_id, '"}}')
END
""".replace("{iso}", ISO)


# a plain object keeps what it holds
_PLAIN_OBJECT = '{"z":1,"a":[{"stringValue":"kept"}]}'
_DEPTH = "CAST(event_id % 8 + 1 AS INT)"
_LISTS = f"""concat(repeat('{{"arrayValue":{{"values":[', {_DEPTH}), '{{"intValue":"', event_id, '"}}', repeat(']}}}}', {_DEPTH}))"""
_PAIRS = f"""concat(repeat('{{"kvlistValue":{{"values":[{{"key":"k","value":', {_DEPTH}), '{{"stringValue":"v', user_id, '"}}', repeat('}}]}}}}', {_DEPTH}))"""
# every seventh record is flat
_NESTED = f"""
CASE WHEN event_id % 7 = 0 THEN concat('{{"body":"flat ', event_id, '","severityText":"INFO","serviceName":"flat","region":"r","attributes":{{"plain":"7"}}}}')
ELSE concat('{{"body":', CASE WHEN event_id % 2 = 0 THEN {_PAIRS} ELSE {_LISTS} END,
  ',"severityText":', CASE event_id % 3 WHEN 0 THEN '{{"stringValue":"WARN"}}' WHEN 1 THEN '{{"arrayValue":{{"values":[{{"stringValue":"WARN"}},{{"boolValue":true}}]}}}}' ELSE '"INFO"' END,
  ',"serviceName":', CASE event_id % 5 WHEN 0 THEN {_PAIRS} ELSE '{{"stringValue":"svc"}}' END,
  ',"region":', {_LISTS}, ',"exception":{{"type":', {_LISTS}, ',"message":{{"stringValue":"m', event_id, '"}}}}',
  ',"attributes":[{{"key":"deep","value":', {_LISTS}, '}},{{"key":"plain","value":{{"intValue":"7"}}}},{{"key":"stringValue","value":{_PLAIN_OBJECT}}}]',
  ',"resource":{{"attributes":{{"kvlistValue":{{"values":[{{"key":"az","value":', {_PAIRS}, '}}]}}}}}}}}')
END
"""


def nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose values are wrapped up to eight levels deep, in every field."""
    return messages(spark, sf_dir, _NESTED)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    return raw.withColumn("at", F.col("ts").cast("timestamp"))


def messages(spark: SparkSession, sf_dir: str, value: str = _VALUE) -> DataFrame:
    return spread(events(spark, sf_dir)).select(
        F.lit("app.logs").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.expr(value).alias("value"),
        F.col("at").alias("timestamp"),
    )


_STATUS = (
    "CAST(CASE event_id % 11 WHEN 0 THEN 429 WHEN 1 THEN 400 WHEN 2 THEN 503 ELSE 201 END AS INT)"
)
_FIRST_RETRY = "CAST(CASE event_id % 3 WHEN 0 THEN 201 WHEN 1 THEN 503 ELSE 400 END AS INT)"
_SECOND_RETRY = "CAST(CASE event_id % 2 WHEN 0 THEN 201 ELSE 503 END AS INT)"
_ERROR_TYPE = (
    "CASE {s} WHEN 429 THEN 'rejected_execution_exception' WHEN 400 THEN 'parsing_exception'"
    " WHEN 503 THEN 'unavailable' END"
)


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per written document: batch, position, source and target."""
    return events(spark, sf_dir).select(
        F.expr("event_id div 500").alias("batch_id"),
        F.expr("CAST(event_id % 500 AS INT)").alias("item_index"),
        F.lit("app.logs").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.concat(F.lit("logs-"), "event_type", F.lit("-prod")).alias("data_stream"),
        F.concat(F.lit("doc-"), F.col("event_id")).alias("document_id"),
        "at",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log of the written documents: a first write and up to two retries."""
    base = events(spark, sf_dir).select(
        F.expr("event_id div 500").alias("batch_id"),
        F.expr("CAST(event_id % 500 AS INT)").alias("item_index"),
        F.expr(
            f"filter(array(named_struct('attempt', 0, 'status', {_STATUS}),"
            f" CASE WHEN event_id % 11 IN (0, 2) THEN named_struct('attempt', 1, 'status', {_FIRST_RETRY}) END,"
            f" CASE WHEN event_id % 11 IN (0, 2) AND event_id % 3 = 1"
            f" THEN named_struct('attempt', 2, 'status', {_SECOND_RETRY}) END), x -> x IS NOT NULL)"
        ).alias("tries"),
    )
    return base.select("batch_id", "item_index", F.explode("tries").alias("t")).select(
        "batch_id",
        "item_index",
        "t.attempt",
        "t.status",
        F.expr(_ERROR_TYPE.format(s="t.status")).alias("error_type"),
        F.concat(F.lit("reason "), F.col("item_index")).alias("reason"),
    )


def first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose first write failed, with the failure."""
    first = attempts(spark, sf_dir).where("attempt = 0 AND status >= 300").drop("attempt")
    return (
        written(spark, sf_dir)
        .join(first, ["batch_id", "item_index"])
        .withColumn("failure_class", failure_class(F.col("status"), F.col("error_type")))
    )


def available_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages still at hand, some of them received twice."""
    rows = messages(spark, sf_dir).where(
        "NOT (timestamp < TIMESTAMP '2024-01-10 00:00:00' AND key LIKE '%3')"
    )
    again = rows.where("key LIKE '%1'").withColumns(
        {
            "value": F.concat("value", F.lit(" again")),
            "timestamp": F.expr("timestamp + INTERVAL 1 SECOND"),
        }
    )
    return rows.unionByName(again)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the first writes that failed for good."""
    failed = first_failures(spark, sf_dir).where("failure_class = 'DEAD_LETTER'")
    rows = dead_letter_rows(failed, available_messages(spark, sf_dir))
    return dead_letter_documents(rows, at=F.col("timestamp"))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, documents and results per written batch."""
    return (
        events(spark, sf_dir)
        .groupBy(F.expr("event_id div 500").alias("batch_id"))
        .agg(
            F.max("at").alias("ingested_at"),
            F.count("*").alias("messages"),
            F.count_if(F.col("event_type") != "view").alias("documents"),
            F.count_if((F.col("event_type") != "view") & (F.col("event_id") % 11 > 2)).alias("successes"),
            F.count_if((F.col("event_type") != "view") & (F.col("event_id") % 11 <= 2)).alias("failures"),
            F.lit("app.logs").alias("topic"),
            F.max_by((F.col("user_id") % 4).cast("int"), "event_id").alias("partition"),
            F.max("event_id").alias("offset"),
            F.concat(F.lit("logs-"), F.max_by("event_type", "event_id"), F.lit("-prod")).alias("data_stream"),
        )
    )
