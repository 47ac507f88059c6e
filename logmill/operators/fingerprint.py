"""Fingerprint of a document: what repeats stays, what varies is templated away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import first_line, or_null_word, sha256_hex, template


def fingerprint_text(cfg: PipelineConfig = PipelineConfig()) -> Column:
    """The text that is hashed, fields joined by ``|``."""

    def part(struct: str, member: str) -> Column:
        present = F.col(struct).isNotNull()
        return F.when(present, or_null_word(F.col(f"{struct}.{member}"))).otherwise(F.lit(""))

    fields = [part("service", "name"), part("log", "level"), part("error", "type")]
    if cfg.fingerprint_tenant:
        fields = [part("tenant", "id"), part("service", "environment"), *fields]
    fields += [template(F.col("message")), template(first_line(F.col("error.stack_trace")))]
    return F.concat_ws("|", *fields)


def fingerprint(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    digest = sha256_hex(fingerprint_text(cfg))
    return documents.withColumn("event", F.col("event").withField("hash", digest))
