"""What became of written documents: failure classes, retries, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import or_null_word, sha256_hex

# Statuses and error-type parts that are worth a retry.
RETRYABLE_STATUS = (408, 429, 500, 502, 503, 504)
RETRYABLE_TYPES = ("timeout", "rejected_execution", "circuit_breaking")
DEFAULT_REASON = "bulk item failed"
DEAD_LETTER_MESSAGE = "log ingestion failed"
SOURCE_KEY = ["topic", "partition", "offset"]


def failure_class(status: Column, error_type: Column) -> Column:
    """RETRYABLE or DEAD_LETTER; no status means the write itself broke down."""
    transient = F.lit(False)
    for part in RETRYABLE_TYPES:
        transient = transient | F.coalesce(error_type.contains(part), F.lit(False))
    retry = status.isNull() | status.isin(*RETRYABLE_STATUS) | transient
    return F.when(retry, F.lit("RETRYABLE")).otherwise(F.lit("DEAD_LETTER"))


def failure_summary() -> Column:
    """One-line text of a failed item."""
    return F.format_string(
        "%s[%s]: status=%s, type=%s, reason=%s",
        *[
            or_null_word(F.col(name))
            for name in ("data_stream", "item_index", "status", "error_type", "reason")
        ],
    )


def response_failures(batches: DataFrame, responses: DataFrame) -> DataFrame:
    """Failed items of bulk responses.

    ``batches`` has one row per written document ``(batch_id, item_index,
    data_stream, document_id)``; ``responses`` one row per batch ``(batch_id,
    errors, items ARRAY<STRUCT<index, id, status, error STRUCT<type, reason>>>)``.
    Items without a matching document keep the names of the response.
    """
    items = (
        responses.where("errors")
        .select("batch_id", F.posexplode("items").alias("item_index", "item"))
        .where("item.error IS NOT NULL")
    )
    sent = batches.select(
        "batch_id", "item_index", F.col("data_stream").alias("sent_to"), F.col("document_id").alias("sent_id")
    )
    return (
        items.join(sent, ["batch_id", "item_index"], "left")
        .select(
            "batch_id",
            "item_index",
            F.coalesce("sent_to", "item.index").alias("data_stream"),
            F.coalesce("sent_id", "item.id").alias("document_id"),
            F.col("item.status").alias("status"),
            F.col("item.error.type").alias("error_type"),
            F.col("item.error.reason").alias("reason"),
        )
        .withColumn("failure_class", failure_class(F.col("status"), F.col("error_type")))
    )


def batch_failed(documents: DataFrame, reason: str) -> DataFrame:
    """Every document of a batch that could not be sent at all, as retryable failures."""
    return documents.select(
        "batch_id",
        "item_index",
        "data_stream",
        "document_id",
        F.lit(None).cast("int").alias("status"),
        F.lit("io_exception").alias("error_type"),
        F.lit(reason).alias("reason"),
        F.lit("RETRYABLE").alias("failure_class"),
    )


def complete_failures(documents: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """Item failures, and for failed batches without item detail one per document.

    ``results`` has one row per batch ``(batch_id, failure_count, first_reason)``.
    """
    detailed = failures.select("batch_id").distinct()
    bare = results.where("failure_count > 0").join(detailed, "batch_id", "left_anti")
    filled = documents.join(bare, "batch_id").select(
        "batch_id",
        "item_index",
        "data_stream",
        "document_id",
        F.lit(None).cast("int").alias("status"),
        F.lit("unknown").alias("error_type"),
        F.coalesce("first_reason", F.lit(DEFAULT_REASON)).alias("reason"),
        F.lit("DEAD_LETTER").alias("failure_class"),
    )
    return failures.select(*filled.columns).unionByName(filled)


def attach_failures(
    documents: DataFrame, failures: DataFrame, class_name: str | None = None
) -> DataFrame:
    """Documents joined to their failures by position; positions out of range drop out."""
    chosen = failures if class_name is None else failures.where(F.col("failure_class") == class_name)
    detail = chosen.select(
        "batch_id", "item_index", "status", "error_type", "reason", "failure_class"
    )
    return documents.join(detail, ["batch_id", "item_index"])


def retry_disposition(attempts: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Final fate of each document from its attempt log.

    ``attempts`` has one row per try ``(batch_id, item_index, attempt, status,
    error_type, reason)``, attempt 0 being the first write.  Tries beyond the retry
    limit do not count, nor do tries after a success or a permanent failure.
    """
    failed = F.col("status").isNull() | (F.col("status") >= 300)
    permanent = failed & (failure_class(F.col("status"), F.col("error_type")) == "DEAD_LETTER")
    final = F.when(~failed | permanent, F.col("attempt"))
    tries = attempts.where(F.col("attempt") <= cfg.max_retries)
    fate = tries.groupBy("batch_id", "item_index").agg(
        F.max_by(failed, "attempt").alias("last_failed"),
        F.min_by(failed, "attempt").alias("first_failed"),
        F.min(final).alias("final_attempt"),
        F.min_by(failed, F.coalesce(final, F.lit(2**31 - 1))).alias("final_failed"),
        F.max("attempt").alias("last_attempt"),
    )
    used = F.coalesce("final_attempt", "last_attempt")
    still = F.when(F.col("final_attempt").isNull(), F.lit(True)).otherwise(F.col("final_failed"))
    return fate.select(
        "batch_id",
        "item_index",
        F.col("first_failed").alias("failed_first"),
        used.alias("retries"),
        F.when(~still & (used == 0), F.lit("created"))
        .when(~still, F.lit("created_after_retry"))
        .otherwise(F.lit("dead_letter"))
        .alias("disposition"),
    )


def latest_messages(messages: DataFrame) -> DataFrame:
    """One message per (topic, partition, offset): the last one received."""
    value = F.struct("key", "value", "timestamp")
    return (
        messages.groupBy(*SOURCE_KEY)
        .agg(F.max_by(value, F.struct("timestamp", "value")).alias("m"))
        .select(*SOURCE_KEY, "m.key", "m.value", "m.timestamp")
    )


def dead_letter_rows(failed: DataFrame, messages: DataFrame, stage: str = "bulk-write") -> DataFrame:
    """Failed documents joined to their source message; see :func:`unresolved_sources`.

    ``failed`` has the source key, ``data_stream``, ``document_id`` and the failure.
    """
    # failures are few: only their messages take part in the shuffle
    wanted = messages.join(failed.select(*SOURCE_KEY).distinct(), SOURCE_KEY, "left_semi")
    return failed.join(latest_messages(wanted), SOURCE_KEY).select(
        *SOURCE_KEY,
        F.col("key").alias("message_key"),
        F.col("value").alias("payload"),
        "timestamp",
        F.lit(stage).alias("stage"),
        failure_summary().alias("reason"),
        F.col("data_stream").alias("failed_data_stream"),
        F.col("document_id").alias("failed_document_id"),
        "status",
        "error_type",
    )


def unresolved_sources(failed: DataFrame, messages: DataFrame) -> DataFrame:
    """Failed documents whose source message is not at hand."""
    complete = failed.where(" AND ".join(f"`{name}` IS NOT NULL" for name in SOURCE_KEY))
    asked = complete.select(*SOURCE_KEY).distinct()
    known = messages.select(*SOURCE_KEY).join(asked, SOURCE_KEY, "left_semi")
    return complete.join(known, SOURCE_KEY, "left_anti")


def dead_letter_documents(
    rows: DataFrame, cfg: PipelineConfig = PipelineConfig(), at: Column | None = None
) -> DataFrame:
    """Dead-letter rows as documents with the details in ``attributes``."""
    now = F.current_timestamp() if at is None else at
    details = {
        "deadletter.stage": F.col("stage"),
        "deadletter.reason": F.col("reason"),
        "deadletter.payload": F.coalesce("payload", F.lit("")),
        "deadletter.failed_data_stream": F.col("failed_data_stream"),
        "deadletter.failed_document_id": F.col("failed_document_id"),
        "deadletter.status": F.col("status").cast("string"),
        "deadletter.error_type": F.col("error_type"),
    }
    pairs = [x for key, value in details.items() for x in (F.lit(key), value)]
    return rows.select(
        F.concat_ws(
            "-", F.lit("deadletter"), "topic", F.col("partition").cast("string"), F.col("offset").cast("string"),
            # messages without an offset are told apart by their payload
            F.when(F.col("offset") < 0, sha256_hex(F.coalesce("payload", F.lit("")))),
        ).alias("id"),
        F.lit(cfg.dead_letter_stream).alias("data_stream"),
        now.alias("event_time"),
        F.lit(DEAD_LETTER_MESSAGE).alias("message"),
        F.struct(
            F.lit(cfg.dead_letter_service).alias("name"),
            F.lit(None).cast("string").alias("version"),
            F.lit(cfg.default_environment).alias("environment"),
        ).alias("service"),
        F.struct(
            F.lit(cfg.dead_letter_dataset).alias("dataset"),
            F.lit("event").alias("kind"),
            F.array(F.lit("application")).alias("category"),
            F.array(F.lit("error")).alias("type"),
            F.lit(None).cast("string").alias("hash"),
        ).alias("event"),
        F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("attributes"),
        # top level as well, so that replay filters reach the storage scan
        "topic",
        "partition",
        "offset",
        "message_key",
        "stage",
        "reason",
        F.coalesce("payload", F.lit("")).alias("payload"),
        "failed_data_stream",
        "failed_document_id",
        "status",
        "error_type",
    )


def processing_failures(prepared: DataFrame) -> DataFrame:
    """Rows whose ``failure`` is set, as dead-letter rows of stage ``process``."""
    none = F.lit(None).cast("string")
    return prepared.where(F.col("failure").isNotNull()).select(
        "source.topic",
        "source.partition",
        "source.offset",
        "source.message_key",
        "payload",
        F.col("arrived_at").alias("timestamp"),
        F.lit("process").alias("stage"),
        F.col("failure").alias("reason"),
        none.alias("failed_data_stream"),
        none.alias("failed_document_id"),
        F.lit(None).cast("int").alias("status"),
        none.alias("error_type"),
    )


def handling_summary(
    dispositions: DataFrame, unresolved: DataFrame, dead_letter_failures: DataFrame, by: str = "batch_id"
) -> DataFrame:
    """Counts per batch of failures, retries, dead letters and what stayed open.

    ``unresolved`` and ``dead_letter_failures`` hold one row per affected document.
    Each side is aggregated on its own before the counts are joined.
    """
    is_dead = F.col("disposition") == "dead_letter"
    counts = dispositions.groupBy(by).agg(
        F.count_if("failed_first").alias("initial_failures"),
        F.sum("retries").alias("retried"),
        F.count_if(F.col("disposition") == "created_after_retry").alias("retry_success"),
        F.count_if(is_dead).alias("dead"),
    )
    open_rows = unresolved.groupBy(by).agg(F.count("*").alias("open"))
    broken = dead_letter_failures.groupBy(by).agg(F.count("*").alias("broken"))
    joined = counts.join(open_rows, by, "left").join(broken, by, "left").fillna(0, ["open", "broken"])
    return joined.select(
        by,
        "initial_failures",
        "retried",
        "retry_success",
        (F.col("dead") - F.col("open")).alias("dead_letters"),
        F.col("broken").alias("dead_letter_failures"),
        F.col("open").alias("unresolved"),
        fully_handled(F.col("open"), F.col("broken")).alias("fully_handled"),
    )


def fully_handled(unresolved: Column, dead_letter_failures: Column) -> Column:
    return (unresolved == 0) & (dead_letter_failures == 0)


def ingest_status() -> Column:
    """Status of a batch from its handling summary and ``documents`` count."""
    return (
        F.when(F.col("documents") == 0, F.lit("skipped"))
        .when(F.col("initial_failures") == 0, F.lit("created"))
        .when(
            (F.col("retry_success") == F.col("initial_failures"))
            & (F.col("dead_letters") == 0)
            & (F.col("unresolved") == 0),
            F.lit("created_after_retry"),
        )
        .when((F.col("dead_letters") > 0) & F.col("fully_handled"), F.lit("dead_letter"))
        .otherwise(F.lit("partial_failure"))
    )


def may_commit(cfg: PipelineConfig = PipelineConfig()) -> Column:
    """Whether the offsets of a handled batch count as done."""
    return F.col("fully_handled") & (
        (F.col("dead_letters") == 0) | F.lit(cfg.commit_after_dead_letter)
    )
