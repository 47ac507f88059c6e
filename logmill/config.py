"""Settings that change results, gathered in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class RetentionRule:
    """One row of the stream-name retention dimension.

    ``patterns`` are globs over stream names; among matching rules the highest
    ``priority`` wins.  Ages are in days since the partition was closed.
    """

    policy: str
    patterns: tuple[str, ...]
    priority: int
    warm_days: int | None
    delete_days: int
    rollover_hours: int
    rollover_gb: int


# Names, ages and priorities that decide where a stream ends up.
RETENTION_RULES: tuple[RetentionRule, ...] = (
    RetentionRule("audit-policy", ("logs-audit-*",), 900, 30, 365, 24, 50),
    RetentionRule("error-policy", ("logs-*-error-*",), 800, 7, 90, 24, 50),
    RetentionRule("aggregate-policy", ("logs-aggregate-metrics-*",), 750, 14, 180, 24, 30),
    RetentionRule("short-policy", ("logs-*-access-*", "logs-*-debug-*"), 700, None, 7, 12, 30),
    RetentionRule("default-policy", ("logs-*-*",), 500, 3, 30, 24, 50),
)

# Retention class of each category, and the policy of each class.
CATEGORY_RETENTION: dict[str, str] = {
    "APPLICATION": "DEFAULT",
    "ERROR": "ERROR",
    "ACCESS": "SHORT",
    "AUDIT": "AUDIT",
    "DEBUG": "SHORT",
    "SLOW_LOG": "DEFAULT",
    "SECURITY": "AUDIT",
    "AGGREGATE": "AGGREGATE",
}
RETENTION_POLICY: dict[str, str] = {
    "SHORT": "short-policy",
    "DEFAULT": "default-policy",
    "ERROR": "error-policy",
    "AUDIT": "audit-policy",
    "AGGREGATE": "aggregate-policy",
}


@dataclass(frozen=True)
class PipelineConfig:
    # naming
    bucket_prefix: str = "logs-flat"
    zone: str = "UTC"
    stream_type: str = "logs"
    default_dataset: str = "application"
    default_namespace: str = "prod"
    default_environment: str = "prod"
    fallback_service: str = "unknown-service"
    default_topic: str = "app.logs"
    access_suffix: str = "access"
    error_suffix: str = "error"
    debug_suffix: str = "debug"
    audit_dataset: str = "audit"
    aggregate_dataset: str = "aggregate-metrics"
    # payload limits, in characters; None: no limit
    max_message_length: int | None = 16_384
    include_raw_payload: bool = True
    max_raw_payload_length: int | None = 65_536
    # filter and redaction
    drop_health_checks: bool = True
    health_paths: tuple[str, ...] = ("/health", "/actuator/health")
    debug_sample_rate: float = 0.1
    sensitive_names: tuple[str, ...] = ("password", "authorization", "token", "secret")
    redact_raw_payload: bool = False
    # duplicate merge
    merge_enabled: bool = True
    merge_window_millis: int = 60_000
    merge_threshold: int = 3
    # when a window is summed up: "threshold" (at its multiples) or "final" (once, at its end)
    merge_flush: str = "threshold"
    fingerprint_tenant: bool = False
    # OTLP payloads: only the first record of a message, or every record
    otlp_records: str = "first"
    # write outcomes
    max_retries: int = 2
    commit_after_dead_letter: bool = True
    dead_letter_dataset: str = "deadletter"
    dead_letter_service: str = "log-ingest"
    # retention dimension
    retention_rules: tuple[RetentionRule, ...] = field(default=RETENTION_RULES)

    def __post_init__(self) -> None:
        if self.merge_threshold < 1:
            raise ValueError("merge_threshold must be at least 1")
        if self.merge_flush not in ("threshold", "final"):
            raise ValueError("merge_flush must be 'threshold' or 'final'")
        if self.merge_window_millis < 1:
            raise ValueError("merge_window_millis must be at least 1")
        shortest = 1 if self.max_message_length is None else self.max_message_length
        if shortest < 1 or (self.max_raw_payload_length or 0) < 0:
            raise ValueError("payload limits must be positive")
        if self.otlp_records not in ("first", "all"):
            raise ValueError("otlp_records must be 'first' or 'all'")
        if self.max_retries < 0:
            raise ValueError("max_retries must not be negative")
        if not self.fallback_service.strip() or not self.default_dataset.strip():
            raise ValueError("fallback_service and default_dataset must not be blank")
        ZoneInfo(self.zone)

    @property
    def dead_letter_stream(self) -> str:
        return f"{self.stream_type}-{self.dead_letter_dataset}-{self.default_namespace}"

    def with_(self, **changes) -> "PipelineConfig":
        return replace(self, **changes)
