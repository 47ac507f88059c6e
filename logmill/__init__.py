"""Log-lake ingestion and analytics as Spark DataFrame jobs."""

from .config import PipelineConfig, RetentionRule
from .session import configure

__all__ = ["PipelineConfig", "RetentionRule", "configure"]
