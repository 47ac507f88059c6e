"""Category, dataset, namespace, stream name and retention class of documents."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY_RETENTION, RETENTION_POLICY, PipelineConfig
from ..functions.text import has_text, same_word, stream_part, text_or


def category() -> Column:
    """AUDIT over ACCESS over ERROR over DEBUG over APPLICATION."""
    attributes = F.col("attributes")

    def given(key: str) -> Column:
        return has_text(attributes[key])

    level = F.col("log.level")
    return (
        F.when(given("audit.action") | given("audit.type"), F.lit("AUDIT"))
        .when(given("http.request.method") | given("url.path"), F.lit("ACCESS"))
        .when(F.col("error").isNotNull() | same_word(level, "ERROR", "FATAL"), F.lit("ERROR"))
        .when(same_word(level, "DEBUG", "TRACE"), F.lit("DEBUG"))
        .otherwise(F.lit("APPLICATION"))
    )


def dataset(category_name: Column, cfg: PipelineConfig = PipelineConfig()) -> Column:
    base = stream_part(
        text_or(F.col("service.name"), cfg.default_dataset), cfg.default_dataset
    )
    suffix = (
        F.when(category_name == "ERROR", F.lit(cfg.error_suffix))
        .when(category_name == "ACCESS", F.lit(cfg.access_suffix))
        .when(category_name == "DEBUG", F.lit(cfg.debug_suffix))
    )
    # concat_ws leaves out a missing suffix
    return (
        F.when(category_name == "AUDIT", F.lit(cfg.audit_dataset))
        .when(category_name == "AGGREGATE", F.lit(cfg.aggregate_dataset))
        .otherwise(F.concat_ws("-", base, suffix))
    )


def namespace(cfg: PipelineConfig = PipelineConfig()) -> Column:
    tenant = F.col("tenant.id")
    environment = text_or(F.col("service.environment"), cfg.default_namespace)
    return stream_part(F.when(has_text(tenant), tenant).otherwise(environment), cfg.default_dataset)


def stream_name(
    dataset_name: Column, namespace_name: Column, cfg: PipelineConfig = PipelineConfig()
) -> Column:
    return F.concat_ws("-", F.lit(cfg.stream_type), dataset_name, namespace_name)


def _constant_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def retention_class(category_name: Column) -> Column:
    """Retention class of a category; an unknown or missing one is DEFAULT."""
    return F.coalesce(_constant_map(CATEGORY_RETENTION)[category_name], F.lit("DEFAULT"))


def retention_policy(class_name: Column) -> Column:
    known = F.coalesce(class_name, F.lit("DEFAULT"))
    return _constant_map(RETENTION_POLICY)[known]


def class_patterns(class_name: Column, cfg: PipelineConfig = PipelineConfig()) -> Column:
    """Stream-name globs that belong to a retention class."""
    by_policy = {rule.policy: rule.patterns for rule in cfg.retention_rules}
    pairs = []
    for name, policy in RETENTION_POLICY.items():
        globs = F.array(*[F.lit(p) for p in by_policy.get(policy, ())]).cast("array<string>")
        pairs += [F.lit(name), globs]
    return F.create_map(*pairs)[F.coalesce(class_name, F.lit("DEFAULT"))]


def classify(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Add ``category``, ``namespace``, ``retention`` and ``data_stream``; fill ``event``."""
    named = documents.withColumns({"category": category(), "namespace": namespace(cfg)})
    placed = named.withColumn("dataset", dataset(F.col("category"), cfg))
    event = (
        F.col("event")
        .withField("dataset", F.col("dataset"))
        .withField("kind", F.coalesce(F.col("event.kind"), F.lit("event")))
        .withField("type", F.array(F.lower(F.col("category"))))
    )
    fresh = F.struct(
        F.col("dataset").alias("dataset"),
        F.lit("event").alias("kind"),
        F.array(F.lit("application")).alias("category"),
        F.array(F.lower(F.col("category"))).alias("type"),
        F.lit(None).cast("string").alias("hash"),
    )
    return placed.withColumns(
        {
            "event": F.when(F.col("event").isNotNull(), event).otherwise(fresh),
            "retention": retention_class(F.col("category")),
            "data_stream": stream_name(F.col("dataset"), F.col("namespace"), cfg),
        }
    ).drop("dataset")


def reroute_aggregates(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Send rows of kind ``metric`` to the aggregate stream of their namespace."""
    metric = F.coalesce(F.col("event.kind") == "metric", F.lit(False))
    target = F.lit(cfg.aggregate_dataset)
    return documents.withColumns(
        {
            "data_stream": F.when(metric, stream_name(target, namespace(cfg), cfg)).otherwise(
                F.col("data_stream")
            ),
            "event": F.when(metric, F.col("event").withField("dataset", target)).otherwise(
                F.col("event")
            ),
            "category": F.when(metric, F.lit("AGGREGATE")).otherwise(F.col("category")),
            "retention": F.when(metric, F.lit("AGGREGATE")).otherwise(F.col("retention")),
        }
    )
