"""Messages to parsed records and back to text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import base64_text, json_text as J
from ..session import configure
from .outcome import problem


# What Spark's JSON parser takes.
MOST_BYTES, MOST_LEVELS = 16 * 1024 * 1024, 1000


def parse_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Adds `text`, `msg` (VARIANT of a JSON object) and `error` for everything else.

    Spark's parser takes values below 16 MiB and 1000 levels. What it refuses
    and may be beyond that is set aside under a stage of its own, LIMIT.
    """
    configure(df.sparkSession)
    bad = problem("PARSE", "message is not a JSON object", "malformed input", "parse_json")
    beyond = problem("LIMIT", "message may be larger or deeper than the parser takes", "beyond the limits", "parse_json")
    opened = "octet_length(text) - octet_length(replace(replace(text, '{', ''), '[', ''))"
    return (
        df.selectExpr("*", f"{J.utf8_text(col)} AS text")
        .selectExpr("*", f"{J.parse_object('text')} AS msg")
        .selectExpr("*", f"""CASE WHEN msg IS NOT NULL THEN NULL
            WHEN startswith(text, '{{') AND (octet_length(text) >= {MOST_BYTES} OR {opened} >= {MOST_LEVELS}) THEN {beyond}
            ELSE {bad} END AS error""")
    )


def to_json_text(df: DataFrame, cols: list[str] | None = None, name: str = "json") -> DataFrame:
    """Adds a row's columns (all by default) as one JSON object; NULL columns stay, as JSON null."""
    chosen = cols or df.columns
    return df.withColumn(name, F.to_json(F.struct(*chosen), {"ignoreNullFields": "false"}))


def message_text(df: DataFrame, name: str = "json") -> DataFrame:
    """Adds a parsed message as compact JSON text; NULL where it did not parse."""
    texts = df.selectExpr("*", "get_json_object(text, '$') AS _ordered", "to_json(msg) AS _plain")
    return texts.selectExpr(*df.columns, f"CASE WHEN msg IS NOT NULL THEN {J.compact('text', '_ordered', '_plain')} END AS {name}")


def decode_payload(df: DataFrame, text: str, name: str = "inner") -> DataFrame:
    """Base64 text to `<name>_text`, exactly as encoded, and, when that is a JSON object, `<name>` as VARIANT."""
    configure(df.sparkSession)
    return df.selectExpr("*", f"{J.exact_text(base64_text.decode(text))} AS {name}_text").selectExpr(
        "*", f"{J.parse_object(J.utf8_text(f'{name}_text'))} AS {name}"
    )


def payload_text(df: DataFrame, text: str, member: str = "payload", name: str = "payload_text") -> DataFrame:
    """Adds one member of a JSON object written back as JSON ('' when absent or null)."""
    configure(df.sparkSession)
    value = df.selectExpr("*", f"{J.member(f'({J.parse_object(text)})', member)} AS _value").selectExpr(
        "*", "schema_of_variant(_value) AS _kind"
    )
    return value.selectExpr("*", f"{J.json_of_member(text, '_value', '_kind', member)} AS {name}").drop("_value", "_kind")


# What a strict record accepts per field type: the JSON types, read as that type.
_STRICT_KINDS = {
    "string": ("STRING",),
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "boolean": ("BOOLEAN",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
}


def strict_record(df: DataFrame, schema: T.StructType, msg: str = "msg", name: str = "record") -> DataFrame:
    """Adds `record` when every field of `schema` is present with its type, else fills `error`.

    JSON null counts as missing, members the schema does not name are ignored.
    """
    reads, tests = [], []
    for field in schema:
        read_as = field.dataType.simpleString()
        kind, value = f"_{field.name}_kind", f"_{field.name}"
        typed = " OR ".join(f"startswith({kind}, '{accepted}')" for accepted in _STRICT_KINDS[read_as])
        reads += [f"schema_of_variant({J.member(msg, field.name)}) AS {kind}", f"{J.member(msg, field.name, read_as)} AS {value}"]
        tests.append(
            f"WHEN {J.missing(kind)} THEN '{field.name} is missing' "
            f"WHEN NOT ({typed}) OR {value} IS NULL THEN '{field.name} has the wrong type'"
        )
    record = "named_struct(" + ", ".join(f"'{f.name}', _{f.name}" for f in schema) + ")"
    bad = problem("RECORD", "_problem", "message does not fit the record", "strict_record", quoted=False)
    others = [column for column in df.columns if column != "error"]
    return (
        df.selectExpr("*", *reads)
        .selectExpr("*", f"CASE WHEN error IS NULL THEN CASE {' '.join(tests)} END END AS _problem")
        .selectExpr(
            *others,
            f"CASE WHEN error IS NULL AND _problem IS NULL THEN {record} END AS {name}",
            f"coalesce(error, CASE WHEN _problem IS NOT NULL THEN {bad} END) AS error",
        )
    )
