"""The document path from raw messages to routed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.plan import filter_barrier
from ..operators.classify import classify, reroute_aggregates
from ..operators.filters import redact, should_keep, validate
from ..operators.fingerprint import fingerprint
from ..operators.merge import merge_anchored
from ..operators.normalize import normalize
from ..session import staged


def prepare(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Everything that needs no other row: parse, filter, redact, classify, fingerprint.

    One map-side stage.  Rows with a ``failure`` are kept for the dead letters.
    """
    documents = normalize(messages, cfg)
    kept = documents.where(F.col("failure").isNotNull() | should_keep(cfg))
    return filter_barrier(fingerprint(classify(redact(kept, cfg), cfg), cfg))


def finish(merged: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Route window summaries to their stream and check the required fields."""
    return validate(reroute_aggregates(merged, cfg))


def process(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Static messages to routed rows, repeated documents merged.

    Rows to write have no ``failure``; the others belong to the dead letters.  The
    parsed documents are staged once in the shared folder, so both kinds and all
    passes of the merge read them from there.
    """
    prepared = prepare(messages, cfg)
    if cfg.merge_enabled:
        prepared = staged(prepared, "documents")
    return finish(merge_anchored(prepared, cfg), cfg)


def dry_run(messages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Where each message would go, without state and without a sink."""
    return validate(prepare(messages, cfg)).select(
        "source", "id", "category", "namespace", "retention", "data_stream", "event", "failure"
    )
