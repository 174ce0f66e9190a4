"""Envelope and registry-request fields, mostly as SQL text (see `json_text`)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import json_text as J

# Clock formats of the envelope's createdate.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
TWELVE_HOUR = "yyyy-MM-dd hh:mm:ss"

# Message types.
TELEMETRY = "TELEMETRY"
REGISTRY_PUT = "REGISTRY_PUT"
REGISTRY_POST = "REGISTRY_POST"
REGISTRY_RESPONSE = "REGISTRY_RESPONSE"
DEVICE_ONBOARDING = "DEVICE_ONBOARDING"

# The request's fields; all are text but the status code.
REQUEST_FIELDS = ("path", "verb", "statusCode", "payload", "txId", "deviceId", "header")


def message_key() -> Column:
    """UUID-shaped id of a message's position on its topic, so that a replay repeats it."""
    return F.expr(
        "regexp_replace(md5(concat_ws('/', topic, partition, offset)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
    )


def create_date(clock: Column, pattern: str = ISO_MILLIS) -> Column:
    """UTC clock text whatever the session's time zone, also in the hours its clock skips or repeats."""
    text = F.to_csv(F.struct(clock.cast("timestamp")), {"timeZone": "UTC", "timestampFormat": pattern})
    return F.when(clock.isNotNull(), text)


def request_members(record: str) -> str:
    """The request fields of a parsed record as VARIANTs, taken out in one step."""
    return J.members(record, REQUEST_FIELDS)


def request_values(members: str) -> list[str]:
    """Type and value of every request field, as columns ``req_*``.

    These must become columns of their own, not one struct: Catalyst sees
    through a struct and would read each field again wherever it is used.
    """
    values = []
    for name in REQUEST_FIELDS:
        read_as = "int" if name == "statusCode" else "string"
        values.append(f"schema_of_variant({members}.{name}) AS req_{name}_kind")
        values.append(f"try_variant_get({members}.{name}, '$', '{read_as}') AS req_{name}")
    return values


VALUE_COLUMNS = tuple(column for name in REQUEST_FIELDS for column in (f"req_{name}_kind", f"req_{name}"))


def _request(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {fields[name]}" for name in REQUEST_FIELDS) + ")"


def _defaults() -> dict[str, str]:
    return {name: "0" if name == "statusCode" else "''" for name in REQUEST_FIELDS}


def remote_request(payload: str) -> str:
    """Request from the value columns, '' or 0 for what the sender left out; `payload` is the re-serialised payload."""
    fields = {name: f"coalesce(req_{name}, {default})" for name, default in _defaults().items()}
    return _request({**fields, "payload": payload})


def remote_request_raw(payload: str) -> str:
    """Request of a payload that is not JSON: defaults, and the payload as it came."""
    return _request({**_defaults(), "payload": payload})


def remote_request_onboard(path: str, payload: str) -> str:
    """Request of a device that announces itself: path from the outer message, decoded payload."""
    return _request({**_defaults(), "path": f"coalesce({path}, '')", "payload": f"coalesce({payload}, '')"})


def strict_request() -> str:
    """Request from the value columns exactly as sent; see `strict_problem` for what makes it invalid."""
    return _request({name: f"req_{name}" for name in REQUEST_FIELDS})


def _ill_typed(name: str) -> str:
    """For a field that is not missing."""
    if name == "statusCode":
        return f"(req_statusCode_kind <> '{J.INTEGER}' OR req_statusCode IS NULL)"
    return f"req_{name}_kind <> '{J.STRING}'"


def type_problem() -> str:
    """First ill-typed field of a request built with defaults, or NULL; its payload may be anything."""
    tests = [
        f"WHEN NOT {J.missing(f'req_{name}_kind')} AND {_ill_typed(name)} THEN '{name} has the wrong type'"
        for name in REQUEST_FIELDS if name != "payload"
    ]
    return f"CASE {' '.join(tests)} END"


def strict_problem() -> str:
    """First missing or ill-typed field of a strict request, or NULL. Extra fields do not matter."""
    tests = [
        f"WHEN {J.missing(f'req_{name}_kind')} THEN '{name} is missing' WHEN {_ill_typed(name)} THEN '{name} has the wrong type'"
        for name in REQUEST_FIELDS
    ]
    return f"CASE {' '.join(tests)} END"
