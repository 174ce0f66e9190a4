"""Table shapes shared by every job."""

from __future__ import annotations

import json

from pyspark.sql import types as T

S, I, L, TS, B = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.BinaryType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# The columns a topic delivers (the message-bus source has the same names).
MESSAGE = _struct(
    ("topic", S), ("partition", I), ("offset", L), ("timestamp", TS), ("key", S), ("value", B)
)

# Request to or answer from a device registry.
REMOTE_REQUEST = _struct(
    ("path", S), ("verb", S), ("statusCode", I), ("payload", S),
    ("txId", S), ("deviceId", S), ("header", S),
)

# The standard wrapper every accepted message ends up in.
ENVELOPE = _struct(
    ("messageid", S), ("sourceid", S), ("payload", S), ("registrypayload", REMOTE_REQUEST),
    ("createdate", S), ("messagetype", S),
)

# Why a message was set aside.
ERROR = _struct(("stage", S), ("exception", S), ("cause", S), ("trace", S))

DEAD_LETTER = _struct(
    ("topic", S), ("partition", I), ("offset", L), ("key", S), ("value", B),
    ("stage", S), ("exception", S), ("cause", S), ("trace", S), ("ts", TS),
)

# One rule: `when_sql` is a predicate over the envelope columns.
RULE = T.StructType([
    T.StructField("ruleset", S),
    T.StructField("rule_id", S),
    T.StructField("salience", I),
    T.StructField("when_sql", S),
    T.StructField("action", S),
    T.StructField("channel", S),
    T.StructField("target", S),
    T.StructField("params", T.MapType(S, S)),
])

# Where the rule text of a source is stored; the highest `load_seq` is current.
RULE_LOCATION = _struct(("sourceid", S), ("file_uri", S), ("load_seq", L))

# One prepared request.
OUTBOX = T.StructType([
    T.StructField("messageid", S),
    T.StructField("ruleset", S),
    T.StructField("rule_id", S),
    T.StructField("channel", S),
    T.StructField("method", S),
    T.StructField("uri", S),
    T.StructField("path", S),
    T.StructField("headers", T.MapType(S, S)),
    T.StructField("body", S),
    T.StructField("schema_ref", S),
    T.StructField("salience", I),
])

_NULLABLE = {"payload", "registrypayload"}


def avro_schema(struct: T.StructType, name: str) -> str:
    """Avro schema text for a table shape; only ENVELOPE's two optional fields are unions."""

    def record(shape: T.StructType, record_name: str) -> dict:
        return {
            "type": "record",
            "name": record_name,
            "fields": [{"name": f.name, "type": field_type(f, record_name)} for f in shape],
        }

    def field_type(field: T.StructField, owner: str):
        if isinstance(field.dataType, T.StructType):
            base = record(field.dataType, "RemoteRequest")
        else:
            base = {"string": "string", "int": "int"}[field.dataType.simpleString()]
        return ["null", base] if owner == "Envelope" and field.name in _NULLABLE else base

    return json.dumps(record(struct, name))


ENVELOPE_AVRO = avro_schema(ENVELOPE, "Envelope")
REMOTE_REQUEST_AVRO = avro_schema(REMOTE_REQUEST, "RemoteRequest")
