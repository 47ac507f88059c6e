"""Raw messages to documents: JSON, OTLP-JSON or plain text into one fixed shape.

Every step is a projection, so the whole operator runs map-side in one stage.
The payload is parsed once into a VARIANT; anything that cannot be resolved sets
``failure`` instead of raising, so one bad message never stops a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.nested import may_nest, settled
from ..functions.plan import filter_barrier
from ..functions.text import has_text, iso_instant, sha256_hex, text_or, text_or_null
from ..functions.times import resolve_event_time
from ..functions.variants import (
    first_text,
    has_entries,
    lookup,
    members,
    sql,
    text_map,
    unwrapped,
    wrapper,
)

# Keys looked up in a record, first one present wins.  Dots belong
# to the key, they are not a path.
TIME_KEYS = ("timeUnixNano", "observedTimeUnixNano", "timestamp", "time", "@timestamp")
MESSAGE_KEYS = ("body", "message", "log", "msg")
LEVEL_KEYS = ("severityText", "severity", "level")
SEVERITY_NUMBER_KEYS = ("severityNumber", "severity_number")
LOGGER_KEYS = ("logger", "log.logger")
TRACE_KEYS = ("traceId", "trace_id")
SPAN_KEYS = ("spanId", "span_id")
SERVICE_KEYS = ("service.name", "serviceName", "service")
VERSION_KEYS = ("service.version",)
ENVIRONMENT_KEYS = ("service.environment", "deployment.environment.name")
TENANT_ID_KEYS = ("tenant.id", "tenantId")
TENANT_NAME_KEYS = ("tenant.name", "tenantName")
LABEL_KEYS = ("region", "az", "cluster", "host.name", "host.ip")
ERROR_ATTRIBUTE_KEYS = {
    "type": ("exception.type", "error.type"),
    "message": ("exception.message", "error.message"),
    "stack_trace": ("exception.stacktrace", "exception.stack_trace", "error.stack_trace"),
    "code": ("exception.code", "error.code"),
}
ERROR_RECORD_KEYS = {
    "type": ("type", "exception.type", "error.type"),
    "message": ("message", "exception.message", "error.message"),
    "stack_trace": ("stacktrace", "stack_trace", "exception.stacktrace", "error.stack_trace"),
    "code": ("code", "error.code"),
}


def decode(messages: DataFrame) -> DataFrame:
    """Add ``doc``, the payload as a VARIANT object, and ``is_text`` for plain text.

    Blank payloads, plain text and JSON that is not an object keep ``doc`` NULL
    and are read as text; a literal JSON ``null`` is a processing failure.
    """
    parsed = messages.withColumn("doc", F.try_parse_json("value"))
    return parsed.withColumn(
        "failure", F.when(F.is_variant_null("doc"), F.lit("payload_is_null"))
    ).withColumn("doc", F.when(F.col("value").rlike(r"^\s*\{"), F.col("doc"))).withColumn(
        "is_text", F.col("doc").isNull() & has_text(F.col("value"))
    )


def extract_record(decoded: DataFrame, records: str = "first") -> DataFrame:
    """Add ``rec``, the log record, and ``resource``, the map of resource attributes.

    OTLP payloads nest resource logs, scope logs and log records.  ``first`` keeps
    one record per message; ``all`` emits each record with its ``record_ordinal``.
    """
    top = members("doc", ("resourceLogs", "resource"), resourceLogs="array<variant>")
    opened = decoded.withColumn("top", sql(top))
    parts = {
        "names": ("resource", "scopeLogs"),
        "scopeLogs": "array<struct<logRecords:array<variant>>>",
    }
    if records == "first":
        filled = "filter(parts.scopeLogs, s -> size(s.logRecords) > 0)"
        nested = (
            opened.withColumn("bundle", sql("get(top.resourceLogs, 0)"))
            .withColumn("parts", sql(members("bundle", **parts)))
            .withColumn("rec", sql(f"get(get({filled}, 0).logRecords, 0)"))
        )
    else:
        scopes = members("b", **parts) + ".scopeLogs"
        found = f"flatten(transform({scopes}, s -> coalesce(s.logRecords, array())))"
        pairs = f"transform({found}, r -> named_struct('bundle', b, 'rec', r))"
        every = f"flatten(filter(transform(top.resourceLogs, b -> {pairs}), p -> p IS NOT NULL))"
        nested = (
            opened.select("*", F.posexplode_outer(sql(every)).alias("record_ordinal", "pair"))
            .withColumn("bundle", sql("coalesce(pair.bundle, get(top.resourceLogs, 0))"))
            .withColumn("parts", sql(members("bundle", **parts)))
            .withColumn("rec", F.col("pair.rec"))
            .drop("pair")
        )
    own = members("top.resource", ("attributes",)) + ".attributes"
    bundled = members("parts.resource", ("attributes",)) + ".attributes"
    found = (
        nested.withColumn("rec", F.coalesce("rec", "bundle", "doc"))
        .withColumn("own", sql(own))
        .withColumn(
            "res",
            F.when(F.col("bundle").isNotNull(), sql(bundled))
            .when(sql(has_entries("own")), F.col("own"))
            .otherwise(F.col("top.resource")),
        )
        .drop("doc", "top", "bundle", "parts", "own")
    )
    # records with wrappers that nest are rewritten, all others pass a null
    deep = may_nest(F.col("value"))
    names = _distinct([*_RECORD_FIELDS.values(), *ERROR_RECORD_KEYS.values()])
    texts = (F.when(deep, F.to_json(c)) for c in ("rec", "res"))
    return (
        found.withColumn("plain", settled(*texts, names, "exception", "attributes"))
        .withColumn("rec", F.coalesce(F.try_parse_json("plain.rec"), "rec"))
        .withColumn("res", F.coalesce(F.try_parse_json("plain.res"), "res"))
        .drop("plain")
        .withColumn("res_opened", sql(wrapper("res")))
        .withColumn("resource", sql(text_map("res", "res_opened")))
        .drop("res", "res_opened")
    )


def _lookup(mapping: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[mapping[key] for key in keys])


def _document_id(topic: Column, partition: Column, offset: Column, value: Column) -> Column:
    keyed = F.concat_ws("-", topic, partition.cast("string"), offset.cast("string"))
    hashed = F.concat_ws("-", topic, sha256_hex(F.coalesce(value, F.lit(""))))
    return F.when(offset >= 0, keyed).otherwise(hashed)


# What is read from a record: column name, then the keys it may have.
_RECORD_FIELDS = {
    "time": TIME_KEYS,
    "body": MESSAGE_KEYS,
    "level": LEVEL_KEYS,
    "severity": SEVERITY_NUMBER_KEYS,
    "logger": LOGGER_KEYS,
    "trace": TRACE_KEYS,
    "span": SPAN_KEYS,
    "svc": SERVICE_KEYS,
} | {f"label_{i}": (key,) for i, key in enumerate(LABEL_KEYS)}
_ERROR_FIELDS = {f"error_{part}": keys for part, keys in ERROR_RECORD_KEYS.items()}


def _distinct(groups) -> list[str]:
    return list(dict.fromkeys(key for keys in groups for key in keys))


def _with_fields(extracted: DataFrame) -> DataFrame:
    """Read all fields of a record as text in one cast, then open wrapped values.

    Separate projections on purpose: each refers several times to what the one
    before computed, and Catalyst keeps them apart for that reason.
    """
    names = [*_distinct(_RECORD_FIELDS.values()), "attributes", "exception"]
    inner = ",".join(f"`{k}`:string" for k in _distinct(ERROR_RECORD_KEYS.values()))
    types = dict.fromkeys(names, "string")
    types |= {"attributes": "variant", "exception": f"struct<{inner}>"}
    plain = {f"txt_{n}": first_text("fields", keys) for n, keys in _RECORD_FIELDS.items()}
    plain |= {f"txt_{n}": first_text("fields.exception", k) for n, k in _ERROR_FIELDS.items()}
    plain |= {
        "raw_attributes": "fields.attributes",
        "open_attributes": wrapper("fields.attributes"),
    }
    texts = {
        f"txt_{n}": unwrapped(f"txt_{n}", lookup("rec", keys))
        for n, keys in _RECORD_FIELDS.items()
    }
    texts |= {
        f"txt_{n}": unwrapped(f"txt_{n}", lookup("rec", keys, "exception"))
        for n, keys in _ERROR_FIELDS.items()
    }
    # a payload that is not a JSON object is its own message
    texts["txt_body"] = f"coalesce(CASE WHEN is_text THEN value END, {texts['txt_body']}, '')"
    texts["attributes"] = text_map("raw_attributes", "open_attributes")
    return (
        extracted.withColumn("fields", sql(members("rec", names, **types)))
        .withColumns({name: sql(text) for name, text in plain.items()})
        .drop("fields")
        .withColumns({name: sql(text) for name, text in texts.items()})
        .drop("is_text", "raw_attributes", "open_attributes")
    )


def _timed(fields: DataFrame, arrival: Column) -> DataFrame:
    raw = sql(lookup("rec", TIME_KEYS))
    resolved, time_failure = resolve_event_time(raw, F.col("txt_time"))
    return fields.withColumns({"event_time": resolved, "time_failure": time_failure}).withColumns(
        {
            "failure": F.coalesce("failure", "time_failure"),
            "event_time": F.when(
                F.col("time_failure").isNull(), F.coalesce("event_time", arrival)
            ),
        }
    )


def _error() -> Column:
    parts = {}
    for part, keys in ERROR_ATTRIBUTE_KEYS.items():
        parts[part] = F.coalesce(
            text_or_null(_lookup(F.col("attributes"), keys)), F.col(f"txt_error_{part}")
        )
    anything = F.lit(False)
    for value in parts.values():
        anything = anything | has_text(value)
    return F.when(anything, F.struct(*[v.alias(k) for k, v in parts.items()]))


def _labels() -> Column:
    keys = F.array(*[F.lit(key) for key in LABEL_KEYS])
    values = F.array(
        *[
            F.coalesce(F.col(f"txt_label_{i}"), F.col("resource")[key])
            for i, key in enumerate(LABEL_KEYS)
        ]
    )
    return F.map_filter(F.map_from_arrays(keys, values), lambda _, v: v.isNotNull())


def _service_name(cfg: PipelineConfig) -> Column:
    named = F.coalesce(_lookup(F.col("resource"), SERVICE_KEYS), F.col("txt_svc"))
    return text_or(named, cfg.fallback_service)


def _arrival(messages: DataFrame) -> Column:
    if "timestamp" in messages.columns:
        return F.coalesce(F.col("timestamp").cast("timestamp"), F.current_timestamp())
    return F.current_timestamp()


def large_message(message: Column, limit: int | None) -> dict[str, Column]:
    """Message cut to ``limit`` characters plus what was lost; the digest covers the full text.

    ``None`` cuts nothing.
    """
    length = F.char_length(message)
    cut = F.lit(False) if limit is None else length > limit
    head = message if limit is None else F.substring(message, 1, limit)
    return {
        "message": F.when(cut, head).otherwise(message),
        "truncated": cut,
        "original_length": length,
        "message_preview": F.when(cut, head),
        "message_hash": F.when(cut, sha256_hex(message)),
        "policy": F.when(cut, F.lit("truncate-message")).otherwise(F.lit("normal")),
    }


def raw_payload(value: Column, cfg: PipelineConfig) -> Column:
    if not cfg.include_raw_payload:
        return F.lit(None).cast("string")
    if cfg.max_raw_payload_length is None:
        return value
    return F.when(F.char_length(value) <= cfg.max_raw_payload_length, value)


def long_payloads(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(id, payload) of the messages too long for a limit, whole: a side table of the documents.

    The documents keep the digest and the beginning; joined by id this table gives back
    what the limits cut.  One map-side pass; without limits it is empty.
    """
    limits = [n for n in (cfg.max_message_length, cfg.max_raw_payload_length) if n is not None]
    length = F.char_length("value")
    long = F.lit(False) if not limits else length > min(limits)
    key = _document_id(F.col("topic"), F.col("partition"), F.col("offset"), F.col("value"))
    return messages.where(long).select(key.alias("id"), F.col("value").alias("payload"))


def normalize(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Messages ``(topic, partition, offset, key, value, timestamp)`` to documents.

    Besides the document columns the result has ``arrived_at``, ``payload`` and
    ``failure`` (NULL when the message was understood).
    """
    base = messages.withColumn("arrived_at", _arrival(messages))
    extracted = extract_record(decode(base), cfg.otlp_records)
    fields = _timed(_with_fields(extracted), F.col("arrived_at"))
    doc_id = _document_id(F.col("topic"), F.col("partition"), F.col("offset"), F.col("value"))
    if cfg.otlp_records == "all":
        doc_id = F.concat(
            doc_id, F.when(F.col("record_ordinal") > 0, F.concat(F.lit("-"), F.col("record_ordinal")))
            .otherwise(F.lit(""))
        )
    body = large_message(F.col("txt_body"), cfg.max_message_length)
    attributes = F.col("attributes")
    return filter_barrier(fields.select(
        doc_id.alias("id"),
        F.col("event_time"),
        body["message"].alias("message"),
        F.struct(F.col("txt_level").alias("level"), F.col("txt_logger").alias("logger")).alias("log"),
        F.struct(
            _service_name(cfg).alias("name"),
            _lookup(F.col("resource"), VERSION_KEYS).alias("version"),
            text_or(_lookup(F.col("resource"), ENVIRONMENT_KEYS), cfg.default_environment).alias(
                "environment"
            ),
        ).alias("service"),
        F.struct(
            F.lit(cfg.default_dataset).alias("dataset"),
            F.lit("event").alias("kind"),
            F.array(F.lit("application")).alias("category"),
            F.array(F.lit("info")).alias("type"),
            F.lit(None).cast("string").alias("hash"),
        ).alias("event"),
        F.struct(F.col("txt_trace").alias("id")).alias("trace"),
        F.struct(F.col("txt_span").alias("id")).alias("span"),
        F.struct(
            _lookup(attributes, TENANT_ID_KEYS).alias("id"),
            _lookup(attributes, TENANT_NAME_KEYS).alias("name"),
        ).alias("tenant"),
        _error().alias("error"),
        _labels().alias("labels"),
        attributes,
        F.struct(
            F.current_timestamp().alias("ingested_at"),
            F.lit(True).alias("sampled"),
            *[
                body[name].alias(name)
                for name in (
                    "truncated",
                    "original_length",
                    "message_preview",
                    "message_hash",
                    "policy",
                )
            ],
            raw_payload(F.col("value"), cfg).alias("raw_payload"),
        ).alias("ingest"),
        F.struct(
            "topic",
            F.col("partition").cast("int").alias("partition"),
            F.col("offset").cast("bigint").alias("offset"),
            F.col("key").alias("message_key"),
        ).alias("source"),
        "arrived_at",
        F.col("value").alias("payload"),
        "failure",
    ))


def normalize_flat(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Messages to the flat document form: one row, scalar columns and two maps.

    An unreadable severity number fails the message, like an unreadable time.
    """
    base = messages.withColumn("arrived_at", _arrival(messages))
    fields = _timed(_with_fields(extract_record(decode(base))), F.col("arrived_at"))
    text = F.col("txt_severity")
    kind = F.schema_of_variant(sql(lookup("rec", SEVERITY_NUMBER_KEYS)))
    as_number = F.coalesce(
        text.try_cast("int"),
        F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double").try_cast("int")),
    )
    bad_number = kind.rlike("^(STRING|OBJECT)") & has_text(text) & as_number.isNull()
    raw = F.col("value") if cfg.include_raw_payload else F.lit(None).cast("string")
    return filter_barrier(fields.select(
        _document_id(F.col("topic"), F.col("partition"), F.col("offset"), F.col("value")).alias("id"),
        bucket_name(F.col("event_time"), cfg).alias("bucket"),
        "event_time",
        F.current_timestamp().alias("ingested_at"),
        F.col("txt_level").alias("severity_text"),
        as_number.alias("severity_number"),
        F.col("txt_trace").alias("trace_id"),
        F.col("txt_span").alias("span_id"),
        _service_name(cfg).alias("service_name"),
        F.col("txt_body").alias("body"),
        F.col("key").alias("message_key"),
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "attributes",
        "resource",
        raw.alias("raw_payload"),
        F.coalesce(
            F.col("failure"), F.when(bad_number, F.lit("severity_number_unparseable"))
        ).alias("failure"),
    ))


def bucket_name(event_time: Column, cfg: PipelineConfig = PipelineConfig()) -> Column:
    """Daily bucket ``prefix-yyyy.MM.dd`` in the configured zone."""
    local = F.from_utc_timestamp(event_time, cfg.zone)
    return F.concat(F.lit(f"{cfg.bucket_prefix}-"), F.date_format(local, "yyyy.MM.dd"))


def to_source_json(documents: DataFrame, column: str = "source_json") -> DataFrame:
    """Serialise documents: instants as ISO text, members without a value left out."""
    only_with_id = lambda name: F.when(F.col(f"{name}.id").isNotNull(), F.col(name))
    body = F.struct(
        iso_instant(F.col("event_time")).alias("@timestamp"),
        "message",
        "log",
        "service",
        "event",
        only_with_id("trace").alias("trace"),
        only_with_id("span").alias("span"),
        "tenant",
        "error",
        F.coalesce("labels", F.create_map().cast("map<string,string>")).alias("labels"),
        F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
        F.col("ingest")
        .withField("ingested_at", iso_instant(F.col("ingest.ingested_at")))
        .alias("ingest"),
        "source",
    )
    return documents.withColumn(column, F.to_json(body, {"ignoreNullFields": "true"}))


def flat_to_source_json(documents: DataFrame, column: str = "source_json") -> DataFrame:
    """Serialise flat documents; NULLs are written, except an absent raw payload."""
    names = (
        "severity_text",
        "severity_number",
        "trace_id",
        "span_id",
        "service_name",
        "body",
        "message_key",
        "topic",
        "partition",
        "offset",
        "attributes",
        "resource",
    )
    head = [
        iso_instant(F.col("event_time")).alias("@timestamp"),
        iso_instant(F.col("ingested_at")).alias("ingested_at"),
    ]
    options = {"ignoreNullFields": "false"}
    bare = F.to_json(F.struct(*head, *names), options)
    full = F.to_json(F.struct(*head, *names, "raw_payload"), options)
    return documents.withColumn(
        column, F.when(F.col("raw_payload").isNull(), bare).otherwise(full)
    )
