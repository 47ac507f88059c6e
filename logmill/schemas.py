"""Table schemas, as DDL."""

MESSAGES = (
    "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, timestamp TIMESTAMP"
)

# The document every payload shape is normalised into.
DOCUMENT_COLUMNS = (
    "id",
    "event_time",
    "message",
    "log",
    "service",
    "event",
    "trace",
    "span",
    "tenant",
    "error",
    "labels",
    "attributes",
    "ingest",
    "source",
)

WRITE_OUTCOMES = (
    "batch_id BIGINT, item_index INT, attempt INT, data_stream STRING, document_id STRING, "
    "status INT, error_type STRING, reason STRING"
)

DEAD_LETTERS = (
    "id STRING, data_stream STRING, event_time TIMESTAMP, message STRING, topic STRING, "
    "partition INT, offset BIGINT, message_key STRING, stage STRING, reason STRING, "
    "payload STRING, failed_data_stream STRING, failed_document_id STRING, status INT, "
    "error_type STRING"
)
