"""Finding a key anywhere in a nested payload.

Depth is unbounded, which column expressions cannot follow, so the walk itself
is a small Arrow function. Spark rejects what is not a JSON object and skips
texts that cannot hold the key before any row leaves the JVM; nothing is
shuffled.
"""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import json_text as J
from ..session import configure

FOUND = "value string, type string"
_ARROW = pa.struct([("value", pa.string()), ("type", pa.string())])

# The functions travel with the task, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_hit(tree: dict, matches) -> object:
    """Depth-first, in key order: a matching key ends its level, even when its value is null.

    A null found below lets the level above go on. Matching values and arrays
    are not entered.
    """
    levels = [iter(tree.items())]
    while levels:
        for key, value in levels[-1]:
            if matches(key):
                if value is not None:
                    return value
                levels.pop()
                break
            if isinstance(value, dict):
                levels.append(iter(value.items()))
                break
        else:
            levels.pop()
    return None


def _described(value: object) -> dict | None:
    if value is None:
        return None
    if isinstance(value, str):
        return {"value": _encodable(value), "type": "string"}
    kind = "boolean" if isinstance(value, bool) else {dict: "object", list: "array"}.get(type(value), "number")
    return {"value": _encodable(json.dumps(value, ensure_ascii=False, separators=(",", ":"))), "type": kind}


def _encodable(text: str) -> str:
    """Half of a character pair cannot be encoded and becomes ``?``, as elsewhere in Spark."""
    return text.encode("utf-8", "replace").decode("utf-8")


def _found(text: str, matches: Callable[[str], bool]) -> dict | None:
    """The hit in one text; what goes wrong with it is that text's own result."""
    try:
        return _described(first_hit(json.JSONDecoder().raw_decode(text)[0], matches))  # text after the object does not matter
    except (ValueError, RecursionError) as failure:
        return {"value": str(failure), "type": "error"}


def _search(text: Column, key: str, exact: bool) -> Column:
    matches = (lambda name: name == key) if exact else (lambda name: key in name)

    @F.arrow_udf(FOUND)
    def walk(texts: pa.Array) -> pa.Array:
        found = [None if t is None else _found(t, matches) for t in texts.to_pylist()]
        return pa.array(found, type=_ARROW)

    # A key written with an escape does not appear literally: keep texts that hold a backslash.
    holds_key = F.contains(text, F.lit(key)) | F.contains(text, F.lit("\\"))
    return walk(F.when(holds_key, text))


def _with_hit(df: DataFrame, json_col: str, key: str, name: str, exact: bool) -> DataFrame:
    configure(df.sparkSession)
    text = J.utf8_text(json_col)
    whole = df.selectExpr("*", f"CASE WHEN ({J.parse_object(text)}) IS NOT NULL THEN {text} END AS _text")
    return whole.withColumn(name, _search(F.col("_text"), key, exact))


def search_map(df: DataFrame, json_col: str, key: str, name: str = "found") -> DataFrame:
    """Adds `found` (value as text, type) of the first member named `key`; NULL when there is none."""
    return _with_hit(df, json_col, key, name, exact=True).drop("_text")


def search_map_first_subkey(df: DataFrame, json_col: str, text: str, name: str = "found") -> DataFrame:
    """As `search_map` for the first member whose name contains `text`."""
    return _with_hit(df, json_col, text, name, exact=False).drop("_text")


def search_json(df: DataFrame, json_col: str, key: str, name: str = "found") -> DataFrame:
    """As `search_map`, but text that is not a JSON object gives a message of type ``error``."""
    message = F.concat(
        F.lit(f"Error retrieving key: '{key}' in '"), F.coalesce(F.col(json_col).cast("string"), F.lit("null")),
        F.lit("' ; cause by : not a JSON object"),
    )
    failed = F.struct(message.alias("value"), F.lit("error").alias("type"))
    hit = _with_hit(df, json_col, key, name, exact=True)
    return hit.withColumn(name, F.when(F.col("_text").isNull(), failed).otherwise(F.col(name))).drop("_text")
