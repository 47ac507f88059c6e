"""Telemetry values that nest: array and key/value wrappers at any depth.

Spark expressions cannot recurse, so records with such a wrapper are rewritten in Python,
a batch at a time: afterwards they hold plain texts, which the expressions of
:mod:`logmill.functions.variants` read like those of any other record.  Rows without one
hand over a null and stay in the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .variants import SCALAR_WRAPPERS

# Wrappers around lists of values and lists of entries
ARRAY_WRAPPER = "arrayValue"
KV_WRAPPER = "kvlistValue"


def may_nest(payload: Column) -> Column:
    """Whether a JSON text can hold such a wrapper: a test of its text alone."""
    return F.coalesce(payload.contains(f'"{ARRAY_WRAPPER}"') | payload.contains(f'"{KV_WRAPPER}"'), F.lit(False))


def _values(wrapper) -> object:
    return wrapper.get("values") if isinstance(wrapper, dict) else None


def opened(value):
    """A value without its wrapper, and without those of the values it holds."""
    if not isinstance(value, dict):
        return value
    for key in SCALAR_WRAPPERS:
        if key in value:
            return value[key]
    if ARRAY_WRAPPER in value:
        items = _values(value[ARRAY_WRAPPER])
        return [opened(item) for item in items] if isinstance(items, list) else []
    if KV_WRAPPER in value:
        return entries(_values(value[KV_WRAPPER]))
    return value


def entries(value) -> dict:
    """Members of an object, or of a list of ``{key, value}``, opened; a later key replaces an earlier one."""
    value = opened(value)
    if isinstance(value, dict):
        return {key: opened(item) for key, item in value.items()}
    if isinstance(value, list):
        pairs = [item for item in value if isinstance(item, dict) and item.get("key") is not None]
        return {text_of(pair["key"]): opened(pair.get("value")) for pair in pairs}
    return {}


def text_of(value) -> str | None:
    """Strings as they are, null as null, anything else as JSON text with sorted keys."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def nests(value) -> bool:
    """Whether opening a value takes more than a look at its scalar wrappers."""
    if not isinstance(value, dict) or any(key in value for key in SCALAR_WRAPPERS):
        return False
    return ARRAY_WRAPPER in value or KV_WRAPPER in value


def _listed(value) -> list[dict]:
    # texts in scalar wrappers: no key of an entry can be taken for a wrapper
    return [{"key": k, "value": None if v is None else {SCALAR_WRAPPERS[0]: text_of(v)}} for k, v in entries(value).items()]


def settled_record(record: str, fields: Sequence[str], inner: str, attributes: str) -> str:
    """A record with its text ``fields``, those of its member ``inner`` and its ``attributes`` opened."""
    found = json.loads(record)
    if not isinstance(found, dict):
        return record
    for holder in (found, found.get(inner)):
        if isinstance(holder, dict):
            for name in fields:
                if nests(holder.get(name)):
                    holder[name] = text_of(opened(holder[name]))
    if attributes in found:
        found[attributes] = _listed(found[attributes])
    return json.dumps(found, ensure_ascii=False)


def settled_attributes(attributes: str) -> str:
    return json.dumps(_listed(json.loads(attributes)), ensure_ascii=False)


def settled(record: Column, resource: Column, fields: Sequence[str], inner: str, attributes: str) -> Column:
    """Struct of the JSON texts of a record and of its resource attributes, rewritten; null stays null."""
    names = tuple(fields)

    def each(texts: pd.Series, rewrite: Callable[[str], str]) -> pd.Series:
        return pd.Series([None if t is None else rewrite(t) for t in texts], dtype=object)

    @F.pandas_udf("rec string, res string")
    def rewrite(records: pd.Series, resources: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"rec": each(records, lambda t: settled_record(t, names, inner, attributes)), "res": each(resources, settled_attributes)})

    return rewrite(record, resource)
