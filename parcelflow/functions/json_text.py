"""JSON text as SQL expressions.

A parsed message is a VARIANT: one parse per message, typed members, and the
parser is strict (no single quotes, no NaN). VARIANT sorts object keys, so text
that must keep its key order is always taken from the text itself.

The functions here take and return SQL text. A step of a job is then a few
`selectExpr` lists instead of hundreds of column objects, which counts because
every micro-batch builds its plan anew.
"""

from __future__ import annotations

# Type names as `schema_of_variant` prints them.
STRING, INTEGER, NULL = "STRING", "BIGINT", "VOID"


def exact_text(value: str) -> str:
    """Bytes as text, every character of it; NULL when they are not UTF-8."""
    return f"try_validate_utf8(CAST({value} AS STRING))"


def utf8_text(value: str) -> str:
    """Bytes as text without blanks or a byte order mark in front; NULL when they are not UTF-8."""
    return rf"trim(LEADING ' \t\n\r﻿' FROM {exact_text(value)})"


def parse_object(text: str) -> str:
    """Text starting with a JSON object as VARIANT; anything else is NULL."""
    return f"CASE WHEN startswith({text}, '{{') THEN try_parse_json({text}) END"


def member(parsed: str, name: str, read_as: str = "variant") -> str:
    """A member; NULL when absent. Read as text, a member of another type is converted."""
    return f"try_variant_get({parsed}, '$.{name}', '{read_as}')"


def members(parsed: str, names: tuple[str, ...]) -> str:
    """Several members as a struct of VARIANTs: one walk instead of one per member."""
    fields = ",".join(f"{name}:variant" for name in names)
    return f"try_variant_get({parsed}, '$', 'struct<{fields}>')"


def missing(kind: str) -> str:
    """Absent and JSON null count alike."""
    return f"({kind} IS NULL OR {kind} = '{NULL}')"


def compact(text: str, ordered: str, plain: str) -> str:
    """A parsed message as JSON text without blanks, keys in their order; 1.0 stays 1.0.

    `ordered` is ``get_json_object(text, '$')``, `plain` the parsed message as
    JSON. Only an object that repeats a key says more than the parsed message:
    the parsed form (last value) is used for it.
    """
    return (
        f"CASE WHEN size(json_object_keys({text})) > size(array_distinct(json_object_keys({text})))"
        f" THEN {plain} ELSE {ordered} END"
    )


def json_of_member(text: str, value: str, kind: str, name: str) -> str:
    """A member written back as JSON: objects compact and in key order, 21.0 as 21.0, strings quoted, absent or null ''.

    `text` is the object's own text, `value` and `kind` the member as VARIANT and its type.
    """
    raw = f"from_json({text}, '`{name}` string').`{name}`"
    return f"CASE WHEN {missing(kind)} THEN '' WHEN {kind} IN ('{STRING}', 'BOOLEAN') THEN to_json({value}) ELSE {raw} END"
