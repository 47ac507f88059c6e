"""Access to schema-less JSON held in VARIANT columns.

Three notions matter here: a key can be absent (SQL NULL), present with a JSON
``null`` (a variant null), or present with a value.  Telemetry values may be
wrapped as ``{"stringValue": ...}`` and the like; :func:`opened_text` removes
such wrappers and renders the content as text.  Wrappers around lists, which nest, are
the matter of :mod:`logmill.functions.nested`.

All members of interest are read by one cast of an object to a struct of
variants, which walks the object once; path look-ups would search it per key.
Expressions are composed as SQL text (arguments are SQL too, mostly column
names): nested lambdas built node by node from Python cost seconds per plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wrapper keys in order of precedence.
SCALAR_WRAPPERS: tuple[str, ...] = (
    "stringValue",
    "intValue",
    "doubleValue",
    "boolValue",
    "bytesValue",
)

_WRAPPER_STRUCT = "struct<{}>".format(",".join(f"{key}:variant" for key in SCALAR_WRAPPERS))


def cast_variant(value: str, target: str) -> str:
    return f"try_variant_get({value}, '$', '{target}')"


def members(value: str, names: Iterable[str], **typed: str) -> str:
    """Struct with the named members of a JSON object, NULL if it is no object.

    Names are literal keys: dots belong to the key.  Members are variants unless
    a type is given by keyword.
    """
    fields = ",".join(f"`{name}`:{typed.get(name, 'variant')}" for name in names)
    return cast_variant(value, f"struct<{fields}>")


def lookup(value: str, names: Iterable[str], *parents: str) -> str:
    """Value under the first literal key that is there and not JSON null.

    Searches the object once per key: for values wanted from few rows only.
    """
    options = []
    for name in names:
        path = "$" + "".join(f"[\"{key}\"]" for key in (*parents, name))
        found = f"try_variant_get({value}, '{path}', 'variant')"
        options.append(f"if(is_variant_null({found}), NULL, {found})")
    return f"coalesce({', '.join(options)})"


def first_text(struct: str, names: Iterable[str]) -> str:
    """Text of the first member that is not JSON null, of a struct of strings."""
    return f"coalesce({', '.join(f'{struct}.`{name}`' for name in names)})"


def unwrapped(text: str, value: str) -> str:
    """``text`` of ``value``, without a telemetry wrapper.

    Only text that looks like an object can hide one; ``value`` is evaluated for
    such rows alone.
    """
    bound = f"transform(array({value}), y -> named_struct('value', y, 'opened', {wrapper('y')}))"
    exact = f"get(transform({bound}, z -> {opened_text('z.value', 'z.opened')}), 0)"
    return f"CASE WHEN startswith({text}, '{{') THEN {exact} ELSE {text} END"


def wrapper(value: str) -> str:
    """The wrapper members of a value, NULL when it is no object."""
    return cast_variant(value, _WRAPPER_STRUCT)


def opened_text(value: str, opened: str) -> str:
    """Text of ``value``, whose :func:`wrapper` is ``opened``, without that wrapper.

    Scalars come as text, objects and arrays as JSON text, JSON null as NULL.  Wrappers
    that nest have been opened before (:mod:`logmill.functions.nested`).
    """
    return cast_variant(f"coalesce({_scalar(opened)}, {value})", "string")


def _scalar(opened: str) -> str:
    return f"coalesce({', '.join(f'{opened}.{key}' for key in SCALAR_WRAPPERS)})"


def _entries(body: str) -> str:
    """Entries of a ``{key, value}`` list or of an object as ``ARRAY<STRUCT<key, value>>``."""
    listed = cast_variant(body, "array<struct<key:string,value:variant>>")
    keyed = cast_variant(body, "map<string,variant>")
    return f"coalesce(filter({listed}, k -> k.key IS NOT NULL), map_entries({keyed}))"


def _opened_entries(body: str, var: str) -> str:
    return (
        f"transform({_entries(body)}, {var} -> named_struct('key', {var}.key,"
        f" 'value', {var}.value, 'opened', {wrapper(f'{var}.value')}))"
    )


def has_entries(value: str) -> str:
    """Whether :func:`text_map` of an attribute list or object gives any entry."""
    return f"coalesce(size({_entries(value)}) > 0, false)"


def text_map(value: str, opened: str) -> str:
    """Attribute list or object to ``MAP<STRING, STRING>``; other values give an empty map.

    ``opened`` is the :func:`wrapper` of ``value``.  A later entry replaces an earlier one
    with the same key.
    """
    text = opened_text("m.value", "m.opened")
    entries = f"transform({_opened_entries(value, 'n')}, m -> struct(m.key, {text}))"
    return (
        f"coalesce(CASE WHEN {_scalar(opened)} IS NULL THEN map_from_entries({entries}) END,"
        " CAST(map() AS MAP<STRING, STRING>))"
    )


def sql(expression: str) -> Column:
    return F.expr(expression)
