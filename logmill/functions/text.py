"""Text expressions: blank tests, stream-name parts, templates and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacement patterns, applied in this order.  Look-arounds instead
# of \b keep the word boundary ASCII-only on every Java version.
TEMPLATE_PATTERNS: tuple[tuple[str, str], ...] = (
    (r"[0-9a-fA-F]{8}-[0-9a-fA-F-]{27,}", "<uuid>"),
    (r"(?<![A-Za-z0-9_])[0-9]{2,}(?![A-Za-z0-9_])", "<num>"),
    (r"(?<![A-Za-z0-9_])[0-9a-fA-F]{16,}(?![A-Za-z0-9_])", "<hex>"),
)


def has_text(value: Column) -> Column:
    """True when there is at least one character that is not white space."""
    return F.coalesce(value.rlike(r"[^\s\p{Z}]"), F.lit(False))


def text_or(value: Column, fallback: Column | str) -> Column:
    default = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(has_text(value), value).otherwise(default)


def text_or_null(value: Column) -> Column:
    return F.when(has_text(value), value)


def same_word(value: Column, *words: str) -> Column:
    """Case-insensitive equality with any of ``words``; NULL counts as no match."""
    return F.coalesce(F.upper(value).isin(*words), F.lit(False))


def stream_part(value: Column, default: str) -> Column:
    """Make a text usable as one part of a stream name."""
    dashed = F.regexp_replace(F.lower(value), r"[^a-z0-9_]+", "-")
    trimmed = F.regexp_replace(dashed, r"^-|-$", "")
    return F.when(trimmed == "", F.lit(default)).otherwise(trimmed)


def template(value: Column) -> Column:
    """Replace ids and numbers by place holders; NULL gives an empty text."""
    result = F.coalesce(value, F.lit(""))
    for pattern, mark in TEMPLATE_PATTERNS:
        result = F.regexp_replace(result, pattern, mark)
    return result


def first_line(value: Column) -> Column:
    return F.coalesce(F.get(F.split(value, r"\R", 2), F.lit(0)), F.lit(""))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def or_null_word(value: Column) -> Column:
    """The value, or the word ``null`` where there is none."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def iso_instant(value: Column) -> Column:
    """ISO-8601 in UTC with as many fraction digits (0, 3 or 6) as are needed."""
    micros = F.unix_micros(value)
    base = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = (
        F.when(F.pmod(micros, F.lit(1_000_000)) == 0, F.lit(""))
        .when(F.pmod(micros, F.lit(1_000)) == 0, F.date_format(value, ".SSS"))
        .otherwise(F.date_format(value, ".SSSSSS"))
    )
    return F.concat(base, fraction, F.lit("Z"))
