"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import iso_instant, stream_part, template
from ..functions.times import resolve_event_time
from ..operators import classify as C
from ..operators import filters as FI
from ..operators import keywords as K
from ..operators import merge as M
from ..operators import metrics as P
from ..operators import normalize as N
from ..operators import offsets as O
from ..operators import outcomes as E
from ..operators import replay as R
from ..operators import retention as RT
from ..operators import search as S
from ..operators.fingerprint import fingerprint
from ..plans.ingest import dry_run, finish, prepare
from ..plans.jobs import compact_partition, ingest_batch, replay_job, write_both
from ..session import configure, scratch_path, spread, staged, tasks_for
from ..sources.messages import ad_hoc, file_stream
from ..sources.tables import latest_per_id, read_table, upsert_by_day, upsert_by_id, write_routed
from ..streaming.ingest import finish_routed, read_tumbling, start_ingest, start_routed, start_tumbling
from . import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# events lie minutes apart, so duplicates are looked for over hours
MERGE_CFG = PipelineConfig(merge_window_millis=6 * 3600 * 1000, debug_sample_rate=1.0)
KEEP_ALL = PipelineConfig(debug_sample_rate=1.0, drop_health_checks=False)

_cache: dict[tuple, tuple] = {}


def _once(spark: SparkSession, *key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Build a plan once per session."""
    held = _cache.get(key)
    if held is None or held[0] is not spark:
        _cache[key] = held = (spark, make())
    return held[1]


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def micros(column: Column | str) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def documents(spark, sf_dir) -> DataFrame:
    return _once(
        spark, "documents", sf_dir, make=lambda: N.normalize(X.messages(spark, sf_dir), KEEP_ALL)
    )


def prepared(spark, sf_dir, cfg=MERGE_CFG) -> DataFrame:
    return _once(
        spark, f"prepared{cfg}", sf_dir, make=lambda: prepare(X.messages(spark, sf_dir), cfg)
    )


def stored(spark, sf_dir) -> DataFrame:
    """The prepared documents as a table of the lake, written once per session."""
    return _once(
        spark, "stored", sf_dir, make=lambda: staged(prepared(spark, sf_dir), "documents")
    )


def understood(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir).where("failure IS NULL")


def placed(spark, sf_dir) -> DataFrame:
    """Documents with their place in the duplicate window, staged once."""
    return _once(
        spark,
        "placed",
        sf_dir,
        make=lambda: M.with_positions(stored(spark, sf_dir), MERGE_CFG),
    )


# ---- parse and normalise -------------------------------------------------------------


@query
def decode_json_or_text(spark, sf_dir):
    rows = N.decode(X.messages(spark, sf_dir))
    kind = (
        F.when(F.col("doc").isNotNull(), "object").when(F.col("is_text"), "text").otherwise("blank")
    )
    return rows.select("offset", kind.alias("kind"))


@query
def normalize_documents(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "id",
        micros("event_time").alias("event_us"),
        "message",
        F.col("log.level").alias("level"),
        F.col("service.name").alias("service"),
        F.col("service.environment").alias("environment"),
        F.col("trace.id").alias("trace_id"),
        F.col("tenant.id").alias("tenant_id"),
        F.col("attributes")["n"].alias("attr_n"),
        "failure",
    )


@query
def nested_values(spark, sf_dir):
    """Values wrapped one to eight levels deep, in every field of a record."""
    rows = N.normalize(X.nested_messages(spark, sf_dir), KEEP_ALL)
    return rows.select(
        "id",
        "message",
        F.col("log.level").alias("level"),
        F.col("service.name").alias("service"),
        F.col("labels")["region"].alias("region"),
        F.col("labels")["az"].alias("az"),
        F.col("error.type").alias("error_type"),
        F.col("error.message").alias("error_message"),
        F.col("attributes")["deep"].alias("deep"),
        F.col("attributes")["plain"].alias("plain"),
        F.col("attributes")["stringValue"].alias("object"),
        "failure",
    )


@query
def normalize_flat(spark, sf_dir):
    rows = N.normalize_flat(X.messages(spark, sf_dir))
    return rows.select(
        "id",
        "bucket",
        micros("event_time").alias("event_us"),
        "severity_text",
        big("severity_number").alias("severity_number"),
        "trace_id",
        "service_name",
        "body",
        "message_key",
        F.col("resource")["region"].alias("region"),
        F.col("raw_payload"),
        "failure",
    )


@query
def normalize_otlp(spark, sf_dir):
    rows = documents(spark, sf_dir).where(F.map_contains_key("attributes", "n"))
    return rows.select(
        "id",
        micros("event_time").alias("event_us"),
        "message",
        F.col("service.name").alias("service"),
        F.col("error.type").alias("error_type"),
        F.col("labels")["region"].alias("region"),
    )


@query
def otlp_all_records(spark, sf_dir):
    cfg = KEEP_ALL.with_(otlp_records="all")
    return N.normalize(X.messages(spark, sf_dir), cfg).select("id", "message")


@query
def event_time_epochs(spark, sf_dir):
    """The same instant in four units; microseconds fall in the millisecond branch."""
    us = F.unix_micros("at")
    units = F.array(
        F.struct(F.lit("s").alias("unit"), F.floor(us / 1_000_000).alias("n")),
        F.struct(F.lit("ms").alias("unit"), F.floor(us / 1000).alias("n")),
        F.struct(F.lit("us").alias("unit"), us.alias("n")),
        F.struct(F.lit("ns").alias("unit"), (us * 1000).alias("n")),
    )
    rows = X.events(spark, sf_dir).select("event_id", F.explode(units).alias("u"))
    text = F.col("u.n").cast("string")
    at, failure = resolve_event_time(F.try_parse_json(text), text)
    return rows.select("event_id", F.col("u.unit").alias("unit"), micros(at).alias("event_us"), failure.alias("failure"))


@query
def event_time_iso(spark, sf_dir):
    text = iso_instant(F.col("at"))
    at, failure = resolve_event_time(F.try_parse_json(F.concat(F.lit('"'), text, F.lit('"'))), text)
    return X.events(spark, sf_dir).select(
        "event_id", text.alias("iso"), micros(at).alias("event_us"), failure.alias("failure")
    )


@query
def large_message(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = N.large_message(F.col("text"), 2_000)
    return texts.select(
        "doc_id",
        F.sha2("text", 256).alias("full_hash"),
        F.sha2(parts["message"], 256).alias("kept_hash"),
        parts["truncated"].alias("truncated"),
        big(parts["original_length"]).alias("original_length"),
        F.char_length(parts["message_preview"]).cast("bigint").alias("preview_length"),
        parts["message_hash"].alias("message_hash"),
        parts["policy"].alias("policy"),
    )


@query
def raw_payload(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = N.raw_payload(F.col("text"), PipelineConfig(max_raw_payload_length=3_000))
    return texts.select("doc_id", F.sha2(kept, 256).alias("payload_hash"))


@query
def long_messages(spark, sf_dir):
    """What the limits cut off long texts, given back by the side table; and without limits."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit("texts").alias("topic"), F.lit(0).alias("partition"), F.col("doc_id").alias("offset"),
        F.lit(None).cast("string").alias("key"), F.col("text").alias("value"), F.lit("2026-01-01").cast("timestamp").alias("timestamp"),
    )
    short = KEEP_ALL.with_(max_message_length=1_000, max_raw_payload_length=2_000)
    cut = N.normalize(texts, short).select("id", "message", "ingest")
    joined = cut.join(N.long_payloads(texts, short), "id", "left")
    whole = N.normalize(texts, KEEP_ALL.with_(max_message_length=None, max_raw_payload_length=None))
    return joined.select("id", F.sha2(F.coalesce("payload", "message"), 256).alias("text_hash"), F.col("ingest.truncated").alias("truncated")).join(
        whole.select("id", F.sha2("message", 256).alias("whole_hash"), F.sha2("ingest.raw_payload", 256).alias("raw_hash")), "id"
    )


@query
def document_id(spark, sf_dir):
    half = F.col("offset") - 100
    rows = X.messages(spark, sf_dir).withColumn("offset", half)
    return N.normalize(rows, KEEP_ALL).select("id", F.col("source.offset").alias("offset"))


@query
def labels_merge(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "id",
        F.col("labels")["region"].alias("region"),
        big(F.size("labels")).alias("n_labels"),
    )


@query
def error_extract(spark, sf_dir):
    return documents(spark, sf_dir).where("error IS NOT NULL").select(
        "id",
        F.col("error.type").alias("type"),
        F.col("error.message").alias("error_message"),
        F.col("error.stack_trace").alias("stack_trace"),
        F.col("error.code").alias("code"),
    )


@query
def daily_bucket(spark, sf_dir):
    cfg = PipelineConfig(zone="Asia/Tokyo")
    return (
        X.events(spark, sf_dir)
        .groupBy(N.bucket_name(F.col("at"), cfg).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


@query
def serialize_document(spark, sf_dir):
    json = N.to_source_json(documents(spark, sf_dir))
    pick = {
        "at": "$['@timestamp']",
        "service": "$.service.name",
        "level": "$.log.level",
        "trace_id": "$.trace.id",
        "error_type": "$.error.type",
        "error_code": "$.error.code",
        "kind": "$.event.kind",
        "partition": "$.source.partition",
    }
    return json.select(
        "id", *[F.get_json_object("source_json", p).alias(n) for n, p in pick.items()]
    )


@query
def serialize_flat(spark, sf_dir):
    json = N.flat_to_source_json(N.normalize_flat(X.messages(spark, sf_dir)))
    return json.select(
        "id",
        F.get_json_object("source_json", "$.service_name").alias("service_name"),
        F.col("source_json").contains('"span_id":null').alias("writes_null"),
        F.get_json_object("source_json", "$.offset").alias("offset_text"),
    )


# ---- filters -------------------------------------------------------------------------


@query
def drop_health_checks(spark, sf_dir):
    cfg = PipelineConfig(debug_sample_rate=1.0)
    kept = documents(spark, sf_dir).where(FI.should_keep(cfg))
    return kept.groupBy(F.col("service.name").alias("service")).agg(F.count("*").alias("n"))


@query
def debug_sample_zero(spark, sf_dir):
    cfg = PipelineConfig(debug_sample_rate=0.0)
    kept = documents(spark, sf_dir).where(FI.should_keep(cfg))
    return kept.groupBy(F.col("log.level").alias("level")).agg(F.count("*").alias("n"))


@query
def debug_sample_rate(spark, sf_dir):
    kept = documents(spark, sf_dir).where(FI.should_keep(PipelineConfig()))
    return kept.where("log.level = 'DEBUG'").select("id")


@query
def redact_attributes(spark, sf_dir):
    rows = FI.redact(documents(spark, sf_dir))
    return rows.select(
        "id",
        F.col("attributes")["userPassword"].alias("user_password"),
        F.col("attributes")["tenant.id"].alias("tenant_id"),
    )


@query
def validate_required(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL).withColumn(
        "data_stream", F.when(F.col("category") != "DEBUG", F.col("data_stream"))
    )
    return FI.validate(rows.withColumn("failure", F.lit(None).cast("string"))).select("id", "failure")


# ---- classification ------------------------------------------------------------------


@query
def classify_category(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL)
    return rows.select("id", "category", F.col("event.type")[0].alias("event_type"), "retention")


@query
def route_stream_name(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL)
    return rows.groupBy("data_stream", "category").agg(F.count("*").alias("n"))


@query
def sanitize_names(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", stream_part(F.col("url"), "application").alias("name"))


@query
def retention_by_category(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL)
    return (
        rows.groupBy("category", "retention")
        .agg(F.count("*").alias("n"))
        .select("category", "retention", C.retention_policy(F.col("retention")).alias("policy"),
                F.array_join(C.class_patterns(F.col("retention")), ",").alias("patterns"), "n")
    )


@query
def retention_by_pattern(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL)
    return rows.groupBy(RT.rule_column(F.col("data_stream")).alias("policy")).agg(
        F.count("*").alias("n")
    )


@query
def retention_many_patterns(spark, sf_dir):
    """A rule per order and more beside a few broad ones: as many patterns as stream names."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    part = {"k": F.col("o_orderkey"), "c": F.col("o_custkey")}
    name = F.concat(F.lit("logs-c"), part["c"], F.lit("-"), part["k"], F.lit("-prod"))
    glob = (
        F.when(part["k"] % 4 == 0, F.concat(F.lit("logs-*-"), part["k"], F.lit("-*")))
        .when(part["k"] % 4 == 1, F.concat(F.lit("logs-c"), part["c"], F.lit("-*")))
        .when(part["k"] % 4 == 2, name)
        .otherwise(F.concat(F.lit("*-"), part["k"] + 1, F.lit("-prod")))
    )
    rank = F.element_at(F.array(*[F.lit(p) for p in (600, 550, 700, 650)]), (part["k"] % 4 + 1).cast("int"))
    own = orders.select(glob.alias("pattern"), rank.alias("priority"), F.concat(F.lit("keep-"), rank).alias("policy"), F.lit(3).alias("warm_days"), F.lit(9).alias("delete_days"))
    broad = spark.createDataFrame([("logs-*-*", 500, "broad", 3, 30), ("logs-*9-prod", 560, "nines", 1, 2), ("audit-*", 900, "never", 1, 1)], own.schema)
    # the stars of a glob are the only signs in it that mean something in a regular expression
    rules = own.unionByName(broad).withColumn("regex", F.concat(F.lit("^"), F.regexp_replace("pattern", r"\*", ".*"), F.lit("$")))
    rows = RT.match_rules(orders.select(name.alias("data_stream")), rules)
    return rows.select("data_stream", big("priority").alias("priority"), "policy", big("delete_days").alias("delete_days"))


@query
def retention_by_table(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL)
    rules = RT.rules_table(spark, PipelineConfig().retention_rules)
    return RT.match_rules(rows, rules).select(
        "data_stream", "policy", big("priority").alias("priority"), big("delete_days").alias("delete_days")
    )


@query
def lifecycle_phase(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL).where("failure IS NULL")
    parts = rows.select("data_stream", F.to_date("event_time").alias("dt"))
    phases = RT.partition_lifecycle(parts, "2024-02-01")
    return phases.groupBy("policy", "phase").agg(F.count("*").alias("partitions"))


@query
def rollover_buckets(spark, sf_dir):
    rows = C.classify(documents(spark, sf_dir), KEEP_ALL).where("failure IS NULL")
    bucket = RT.rollover_bucket(F.col("event_time"), F.col("data_stream"))
    return rows.groupBy("data_stream", micros(bucket).alias("bucket_us")).agg(F.count("*").alias("n"))


@query
def route_dry_run(spark, sf_dir):
    rows = dry_run(X.messages(spark, sf_dir), KEEP_ALL)
    return rows.select("id", "data_stream", "failure")


# ---- fingerprint and merge -----------------------------------------------------------


@query
def template_text(spark, sf_dir):
    texts = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return texts.select("doc_id", F.sha2(template(F.col("text")), 256).alias("template_hash"))


@query
def fingerprints(spark, sf_dir):
    rows = fingerprint(documents(spark, sf_dir))
    return rows.select("id", F.col("event.hash").alias("hash"))


@query
def fingerprints_tenant(spark, sf_dir):
    rows = fingerprint(documents(spark, sf_dir), PipelineConfig(fingerprint_tenant=True))
    return rows.select("id", F.col("event.hash").alias("hash"))


@query
def merge_anchored(spark, sf_dir):
    rows = placed(spark, sf_dir).where("failure IS NULL")
    return rows.select("id", micros("window_start").alias("window_us"), "ordinal", "action")


@query
def merge_emission(spark, sf_dir):
    rows = placed(spark, sf_dir).where("failure IS NULL")
    return rows.groupBy(F.col("event.hash").alias("hash"), "action").agg(F.count("*").alias("n"))


@query
def merge_aggregate_rows(spark, sf_dir):
    kept = placed(spark, sf_dir).where("action = 'aggregate'")
    rows = finish(M.aggregate_rows(kept), MERGE_CFG)
    attributes = F.col("attributes")
    return rows.select(
        "id",
        "message",
        "data_stream",
        F.col("event.kind").alias("kind"),
        F.col("event.dataset").alias("dataset"),
        attributes["merge.occurrence_count"].alias("occurrence_count"),
        attributes["merge.window_start"].alias("window_start"),
        attributes["merge.window_end"].alias("window_end"),
        attributes["merge.sample_message"].alias("sample_message"),
        F.col("ingest.policy").alias("policy"),
    )


@query
def merge_tumbling(spark, sf_dir):
    rows = M.merge_tumbling(understood(spark, sf_dir), MERGE_CFG)
    return rows.select(
        "hash",
        micros("window_start").alias("window_us"),
        "occurrence_count",
        micros("first_seen").alias("first_us"),
        micros("last_seen").alias("last_us"),
        "first_message",
        "last_message",
    )


# ---- write outcomes ------------------------------------------------------------------


@query
def failure_classes(spark, sf_dir):
    rows = X.attempts(spark, sf_dir).where("status >= 300")
    kind = E.failure_class(F.col("status"), F.col("error_type"))
    return rows.groupBy(big("status").alias("status"), "error_type", kind.alias("class")).agg(
        F.count("*").alias("n")
    )


@query
def failure_summaries(spark, sf_dir):
    rows = X.first_failures(spark, sf_dir)
    return rows.select("document_id", E.failure_summary().alias("summary"))


@query
def response_failures(spark, sf_dir):
    sent = X.written(spark, sf_dir).drop("at")
    answers = X.attempts(spark, sf_dir).where("attempt = 0")
    error = F.when(F.col("status") >= 300, F.struct(F.col("error_type").alias("type"), "reason"))
    item = F.struct("item_index", F.lit("ix").alias("index"), F.lit("id").alias("id"), "status", error.alias("error"))
    responses = (
        answers.groupBy("batch_id")
        .agg(
            F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("item_index")).alias("items"),
            F.bool_or(F.col("status") >= 300).alias("errors"),
        )
    )
    rows = E.response_failures(sent, responses)
    return rows.select("batch_id", big("item_index").alias("item_index"), "document_id", "failure_class", "reason")


@query
def batch_failed(spark, sf_dir):
    rows = E.batch_failed(X.written(spark, sf_dir), "connection lost")
    return rows.groupBy("batch_id", "error_type", "failure_class", "reason").agg(F.count("*").alias("n"))


@query
def complete_failures(spark, sf_dir):
    """Batches whose last document is a click or a view report no item detail."""
    sent = X.written(spark, sf_dir)
    last = sent.groupBy("batch_id").agg(F.max_by("data_stream", "item_index").alias("last"))
    detailed = last.where("last NOT IN ('logs-click-prod', 'logs-view-prod')")
    failures = X.first_failures(spark, sf_dir).join(detailed, "batch_id", "left_semi")
    results = sent.groupBy("batch_id").agg(
        F.count("*").alias("failure_count"),
        F.when(F.col("batch_id") % 4 == 1, "quota").alias("first_reason"),
    )
    rows = E.complete_failures(sent, results, failures)
    return rows.groupBy("batch_id", "error_type", "failure_class").agg(
        F.count("*").alias("n"), F.min("reason").alias("reason")
    )


@query
def failure_attach(spark, sf_dir):
    sent = X.written(spark, sf_dir)
    failures = X.attempts(spark, sf_dir).where("attempt = 0 AND status >= 300").withColumn(
        "failure_class", E.failure_class(F.col("status"), F.col("error_type"))
    )
    rows = E.attach_failures(sent, failures, "RETRYABLE")
    return rows.select("document_id", big("status").alias("status"), "error_type")


@query
def retry_disposition(spark, sf_dir):
    rows = E.retry_disposition(X.attempts(spark, sf_dir))
    return rows.select("batch_id", big("item_index").alias("item_index"), big("retries").alias("retries"), "disposition")


@query
def deadletter_rows(spark, sf_dir):
    rows = E.dead_letter_rows(X.first_failures(spark, sf_dir), X.available_messages(spark, sf_dir))
    return rows.select("offset", "message_key", "payload", "reason", "failed_document_id")


@query
def unresolved_sources(spark, sf_dir):
    rows = E.unresolved_sources(X.first_failures(spark, sf_dir), X.available_messages(spark, sf_dir))
    return rows.select("topic", big("partition").alias("partition"), "offset")


@query
def deadletter_documents(spark, sf_dir):
    rows = X.dead_letters(spark, sf_dir)
    attributes = F.col("attributes")
    return rows.select(
        "id",
        "data_stream",
        attributes["deadletter.stage"].alias("stage"),
        attributes["deadletter.status"].alias("status"),
        attributes["deadletter.payload"].alias("payload"),
        big(F.size(attributes)).alias("n_attributes"),
    )


@query
def processing_failures(spark, sf_dir):
    rows = E.processing_failures(prepared(spark, sf_dir))
    return rows.select("offset", "stage", "reason", "payload")


def _summary(spark, sf_dir) -> DataFrame:
    fates = E.retry_disposition(X.attempts(spark, sf_dir))
    dead = fates.where("disposition = 'dead_letter'").join(
        X.written(spark, sf_dir), ["batch_id", "item_index"]
    )
    unresolved = E.unresolved_sources(dead, X.available_messages(spark, sf_dir))
    broken = dead.where("at < TIMESTAMP '2024-01-08 00:00:00' AND data_stream = 'logs-signup-prod'")
    return E.handling_summary(fates, unresolved, broken)


@query
def handling_summary(spark, sf_dir):
    return _summary(spark, sf_dir).select(
        "batch_id",
        *[big(c).alias(c) for c in ("initial_failures", "retried", "retry_success", "dead_letters", "dead_letter_failures", "unresolved")],
        "fully_handled",
    )


@query
def ingest_status(spark, sf_dir):
    counts = X.batch_counts(spark, sf_dir).select("batch_id", "documents")
    rows = _summary(spark, sf_dir).join(counts, "batch_id")
    return rows.select("batch_id", E.ingest_status().alias("status"), E.may_commit().alias("may_commit"))


# ---- offsets -------------------------------------------------------------------------


@query
def offset_plan(spark, sf_dir):
    return O.next_offsets(X.messages(spark, sf_dir)).select(
        "topic", big("partition").alias("partition"), "next_offset"
    )


def _marks(spark, sf_dir) -> DataFrame:
    sent = X.written(spark, sf_dir)
    failed = X.first_failures(spark, sf_dir).where("failure_class = 'DEAD_LETTER'")
    open_rows = E.unresolved_sources(failed, X.available_messages(spark, sf_dir))
    handled = sent.select("batch_id").distinct().withColumn("may_commit", F.expr("batch_id % 4 < 2"))
    return O.mark_offsets(sent, open_rows, handled)


@query
def offset_marks(spark, sf_dir):
    rows = O.offset_outcomes(_marks(spark, sf_dir))
    return rows.select("topic", big("partition").alias("partition"), "offset", "handled")


@query
def handled_prefix(spark, sf_dir):
    outcomes = X.events(spark, sf_dir).select(
        F.lit("app.logs").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr("NOT (event_id % 11 = 1 AND event_id > 500 + 100 * (user_id % 4))").alias("handled"),
    )
    return O.handled_prefix(outcomes).select("topic", big("partition").alias("partition"), "next_offset")


@query
def partition_order(spark, sf_dir):
    rows = O.in_partition_order(X.messages(spark, sf_dir).drop("value"))
    return rows.select("topic", big("partition").alias("partition"), "offset", "key")


# ---- replay --------------------------------------------------------------------------

REPLAY = R.ReplayRequest(
    since="2024-01-05 00:00:00", until="2024-01-20 00:00:00", error_type="parsing_exception", topic="app.logs", limit=200, dry_run=False
)


@query
def replay_select(spark, sf_dir):
    rows = R.select_for_replay(X.dead_letters(spark, sf_dir), REPLAY)
    return rows.select("id", micros("event_time").alias("event_us"))


@query
def replay_messages(spark, sf_dir):
    rows = R.rebuild_messages(X.dead_letters(spark, sf_dir))
    return rows.select("topic", "key", "value", "offset")


@query
def replay_account(spark, sf_dir):
    selected = R.select_for_replay(X.dead_letters(spark, sf_dir), REPLAY)
    processed = N.normalize(R.rebuild_messages(selected), KEEP_ALL)
    return R.replay_counts(selected, processed, dry_run=False)


@query
def replay_dry_run(spark, sf_dir):
    selected = R.select_for_replay(X.dead_letters(spark, sf_dir), REPLAY)
    return R.replay_counts(selected, selected, dry_run=True)


# ---- sources, sinks, metrics ---------------------------------------------------------


@query
def ad_hoc_messages(spark, sf_dir):
    texts = X.events(spark, sf_dir).select(
        F.expr("CASE event_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'other.logs' END").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN '  ' ELSE concat('line ', event_id) END").alias("payload"),
    )
    return N.normalize(ad_hoc(texts)).select("id", "message", F.col("source.topic").alias("topic"))


@query
def routed_write(spark, sf_dir):
    """Write documents and dead letters as a batch job does and read both back."""
    routed = FI.validate(stored(spark, sf_dir).drop("row_id"))
    table, dead = scratch_path(spark, "routed"), scratch_path(spark, "dead")
    write_both(routed, table, dead, MERGE_CFG, "job-7")
    rows = read_table(spark, table).groupBy("data_stream").agg(F.count("*").alias("n"))
    open_rows = read_table(spark, dead).groupBy("data_stream").agg(F.count("*").alias("n"))
    return rows.unionByName(open_rows)


@query
def latest_per_key(spark, sf_dir):
    rows = X.events(spark, sf_dir).select(
        F.concat(F.lit("user-"), "user_id").alias("id"),
        F.struct("at", "event_id").alias("ingested_at"),
        "event_type",
        "event_id",
    )
    return latest_per_id(rows).select("id", "event_type", "event_id")


@query
def keyed_write(spark, sf_dir):
    """Two keyed writes of the flat documents; the second replaces rows of the first."""
    target = scratch_path(spark, "keyed")
    base = X.events(spark, sf_dir).select(
        F.concat(F.lit("doc-"), F.expr("event_id div 3")).alias("id"),
        F.date_trunc("month", "at").alias("event_time"),
        F.col("event_id").alias("ingested_at"),
        "event_type",
    )
    upsert_by_day(spark, base.where("event_type <> 'error'"), target)
    upsert_by_day(spark, base.where("event_type = 'error'"), target)
    rows = read_table(spark, target)
    return rows.select("id", micros("event_time").alias("event_us"), F.col("ingested_at").alias("version"), "event_type")


@query
def keyed_write_moved(spark, sf_dir):
    """Three keyed writes; ids move between months, and some rows of the last write come too late."""
    target = scratch_path(spark, "keyed-moved")
    base = X.events(spark, sf_dir).select(
        F.concat(F.lit("doc-"), F.expr("event_id % 997")).alias("id"),
        F.date_trunc("month", "at").alias("event_time"),
        F.col("event_id").alias("ingested_at"),
        "event_type",
    )
    for part in (1, 2, 0):
        upsert_by_id(spark, base.where(F.expr(f"event_id div 997 % 3 = {part}")), target)
    rows = read_table(spark, target)
    return rows.select("id", micros("event_time").alias("event_us"), F.col("ingested_at").alias("version"), "event_type")


@query
def write_totals(spark, sf_dir):
    rows = P.write_totals(X.batch_counts(spark, sf_dir))
    return rows.select(*[big(c).alias(c) for c in rows.columns])


@query
def progress_windows(spark, sf_dir):
    rows = P.write_progress(X.batch_counts(spark, sf_dir), 86_400)
    plain = [c for c in rows.columns if c not in ("interval_start", "last_partition")]
    return rows.select(
        micros("interval_start").alias("interval_us"), big("last_partition").alias("last_partition"), *plain
    )


@query
def outcome_counters(spark, sf_dir):
    fates = E.retry_disposition(X.attempts(spark, sf_dir))
    failures = X.first_failures(spark, sf_dir).select(
        F.col("at").alias("failed_at"), E.failure_summary().alias("summary")
    )
    rows = P.outcome_counters(fates, failures)
    counts = [c for c in rows.columns if c not in ("last_failure_at", "last_failure")]
    return rows.select(*[big(c).alias(c) for c in counts], micros("last_failure_at").alias("last_failure_us"), "last_failure")


@query
def consumer_counters(spark, sf_dir):
    rows = X.events(spark, sf_dir).select(
        F.lit("app.logs").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr("event_id % 11 <> 1").alias("handled"),
        F.expr("event_id % 20 = 4").alias("filtered"),
    )
    return P.consumer_counters(rows).withColumn("partition", big("partition"))


def _handled_events(spark, sf_dir):
    return X.events(spark, sf_dir).select(
        F.lit("app.logs").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr("event_id % 3001 <> 2999").alias("handled"),
    )


@query
def partition_lag(spark, sf_dir):
    rows = _handled_events(spark, sf_dir)
    return O.partition_lag(rows, rows).withColumn("partition", big("partition"))


@query
def bounded_scan(spark, sf_dir):
    """What is still to be read, between the commit points and 100 short of the end, by offset JSON."""
    rows = _handled_events(spark, sf_dir)
    ends = O.log_range(rows).withColumn("end_offset", F.col("end_offset") - 100)
    found = O.in_offset_range(rows, O.offsets_json(O.handled_prefix(rows)), O.offsets_json(ends, "end_offset"))
    return found.select(big("partition").alias("partition"), "offset", "handled")


# ---- streams -------------------------------------------------------------------------


def _arriving_log(spark, sf_dir, steps: int = 4) -> tuple[str, int]:
    """The message log as files that arrive in the order of its times, and how many arrive in each of ``steps`` steps."""
    folder = scratch_path(spark, "log")
    log = X.messages(spark, sf_dir)
    files = max(8, tasks_for(X.events(spark, sf_dir).count()) // steps)
    cuts = log.agg(F.percentile_approx("timestamp", [i / steps for i in range(1, steps)]).alias("cuts")).first()["cuts"] or []
    step = sum((F.col("timestamp") > F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    for i in range(len(cuts) + 1):
        log.where(step == i).repartition(files).write.mode("append").parquet(folder)
    return folder, files


def _ingested(spark, sf_dir, cfg) -> DataFrame:
    """Rows of a stream over several micro-batches and of the windows open at its end."""
    target, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    folder, files = _arriving_log(spark, sf_dir)
    source = file_stream(spark, folder, max_files=files)
    running = start_routed(source, sink, state, cfg, {"availableNow": True})
    running.awaitTermination()
    if cfg.merge_flush == "final":
        finish_routed(spark, sink, state, 1_000_000, cfg)
    return spark.read.parquet(target).drop("batch")


@query
def stream_ingest(spark, sf_dir):
    """The document path with the duplicate windows going on from batch to batch."""
    rows = _ingested(spark, sf_dir, MERGE_CFG)
    return rows.select("id", "data_stream", F.col("event.kind").alias("kind"), "failure")


FINAL_CFG = MERGE_CFG.with_(merge_flush="final")


def _window_rows(rows: DataFrame) -> DataFrame:
    found = F.when(F.col("action") == "aggregate", F.col("attributes"))
    return rows.where("failure IS NULL").select(
        "id",
        "data_stream",
        "action",
        found["merge.occurrence_count"].alias("occurrence_count"),
        found["merge.window_end"].alias("window_end"),
        found["merge.sample_message"].alias("sample_message"),
        found["merge.sample_stack_trace"].alias("sample_stack_trace"),
    )


@query
def merge_final(spark, sf_dir):
    """One summary per window with its true count, beside the raw rows up to the threshold."""
    return _window_rows(finish(M.merge_anchored(stored(spark, sf_dir), FINAL_CFG), FINAL_CFG))


@query
def stream_final(spark, sf_dir):
    """The same over a stream: windows are summed up when they close, the rest at its end."""
    return _window_rows(_ingested(spark, sf_dir, FINAL_CFG))


@query
def shared_table(spark, sf_dir):
    """Two streams with checkpoints of their own, a job, a replay and a compaction on one table."""
    cfg = MERGE_CFG.with_(merge_enabled=False)
    table, dead = scratch_path(spark, "shared"), scratch_path(spark, "dead")
    log, turn = X.messages(spark, sf_dir), F.col("offset") % 4
    for part in (0, 1):
        folder, state = scratch_path(spark, "log"), scratch_path(spark, "state")
        log.where(turn == part).write.parquet(folder)
        source = file_stream(spark, folder)
        start_ingest(source, table, dead, state, cfg, {"availableNow": True}).awaitTermination()
    ingest_batch(log.where(turn == 2), table, dead, cfg)
    letters, again, done = (scratch_path(spark, n) for n in ("letters", "again", "done"))
    log.where(turn == 3).select(
        F.concat(F.lit("lost-"), "offset").alias("id"), F.col("timestamp").alias("event_time"), "topic",
        F.col("key").alias("message_key"), F.col("value").alias("payload"), F.lit("lost").alias("error_type"),
    ).write.parquet(letters)
    request = R.ReplayRequest(limit=None, dry_run=False)
    for _ in range(2):  # the second run finds nothing left
        replay_job(spark, letters, table, again, request, cfg, done)
    busy = read_table(spark, table).groupBy("data_stream", "dt").count().orderBy(F.desc("count"), "data_stream", "dt").first()
    compact_partition(spark, table, busy.data_stream, str(busy.dt))
    return read_table(spark, table).groupBy("data_stream", F.col("dt").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query
def stream_tumbling(spark, sf_dir):
    """Counts over several micro-batches, each of which holds rows of all days."""
    folder, table, state = (scratch_path(spark, n) for n in ("log", "tumbling", "state"))
    files = max(1, tasks_for(X.events(spark, sf_dir).count()) // 3)
    X.messages(spark, sf_dir).repartition(3 * files).write.parquet(folder)
    source = file_stream(spark, folder, max_files=files)
    start_tumbling(source, table, state, MERGE_CFG, {"availableNow": True}).awaitTermination()
    return read_tumbling(spark, table).select("hash", micros("window_start").alias("window_us"), "occurrence_count")


# ---- search --------------------------------------------------------------------------


@query
def search_newest(spark, sf_dir):
    rows = S.search(
        understood(spark, sf_dir), since="2024-01-03 00:00:00", until="2024-01-28 00:00:00",
        level="ERROR", service="svc-error", limit=50,
    )
    return rows.select("id", micros("event_time").alias("event_us"))


@query
def keyword_search(spark, sf_dir):
    return understood(spark, sf_dir).where(S.keyword("purchase")).select("id")


@query
def keyword_index(spark, sf_dir):
    """Words and a phrase looked up through the word index of a table written in two parts, the second not indexed."""
    table, index = scratch_path(spark, "searched"), scratch_path(spark, "words")
    # a folder a month and stream
    rows = understood(spark, sf_dir).drop("row_id", "payload").withColumn("event_time", F.date_trunc("month", "event_time"))
    write_routed(rows.where("source.offset % 5 <> 0"), table, "job-1")
    K.index_words(spark, table, index, "words-1")
    write_routed(rows.where("source.offset % 5 = 0"), table, "job-2")
    found = [
        K.search_words(spark, table, index, word).select(F.lit(word).alias("word"), "id")
        for word in ("purchase", "cart", "OFF at cart")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def top_terms(spark, sf_dir):
    return S.top_terms(understood(spark, sf_dir), F.col("service.name"), 4)


@query
def top_fingerprints(spark, sf_dir):
    return S.top_terms(understood(spark, sf_dir), F.col("event.hash"), 5)


@query
def storm_summary(spark, sf_dir):
    rows = S.storm_summary(understood(spark, sf_dir), MERGE_CFG, 3)
    return rows.select(
        "hash", micros("window_start").alias("window_us"), "occurrence_count",
        F.array_join("trace_ids", ",").alias("trace_ids"),
    )


@query
def tenant_volume(spark, sf_dir):
    rows = S.stream_inventory(understood(spark, sf_dir))
    return rows.select(
        "data_stream", "tenant_id", "documents", "characters",
        micros("oldest").alias("oldest_us"), micros("newest").alias("newest_us"),
    )
