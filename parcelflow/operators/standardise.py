"""Messages to envelopes.

One chain of projections: parse once, read each member once, then one CASE per
output field picks the shape of the message's topic. No branch-and-union, no
shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import base64_text, envelope as E, json_text as J
from ..schemas import ENVELOPE, REMOTE_REQUEST
from .outcome import evaluated_once, no_problem, problem
from .parse import message_text, parse_json


@dataclass(frozen=True)
class Route:
    """Topics starting with `prefix` take `shape`; `messagetype` is fixed unless the shape keeps the sender's."""

    name: str
    prefix: str
    shape: str  # device | onboard | strict | passthrough
    messagetype: str | None = None
    default_source: str = "default"


# Topic prefixes, in the order they are tried, with their default source and message type.
ROUTES = (
    Route("device_event", "device.event", "device", E.REGISTRY_PUT),
    Route("device_out", "device.out", "device", E.REGISTRY_POST),
    Route("device_onboard", "device.onboard", "onboard", E.DEVICE_ONBOARDING),
    Route("registry_response", "out.registry.topic", "strict", E.REGISTRY_RESPONSE),
    Route("oneid", "in.topic.oneid", "passthrough", default_source="oneid"),
    Route("other", "", "passthrough"),
)


def _case(routes: tuple[Route, ...], pick) -> str:
    """CASE over the route name; `pick(route)` gives each branch's SQL."""
    branches = [f"WHEN '{r.name}' THEN {pick(r)}" for r in routes]
    return f"CASE route {' '.join(branches)} END"


def route(df: DataFrame, routes: tuple[Route, ...] = ROUTES, subscription: str | None = None) -> DataFrame:
    """Adds `route`, the first whose prefix the topic starts with.

    With `subscription` every row is routed by that topic list instead of its own topic.
    """
    topic = F.lit(subscription) if subscription is not None else F.col("topic")
    expression = None
    for r in routes:
        test = topic.startswith(r.prefix)
        expression = F.when(test, r.name) if expression is None else expression.when(test, r.name)
    return df.withColumn("route", expression)


def envelope_defaults(
    df: DataFrame,
    default_source: str = "'default'",
    id_col: Column | None = None,
    clock_col: Column | None = None,
    createdate_format: str = E.ISO_MILLIS,
    source: str = J.member("msg", "sourceid", "string"),
) -> DataFrame:
    """Adds `sourceid` (the message's, else the default), `messageid` and `createdate`.

    `default_source` and `source` are SQL. `id_col` defaults to the message's
    position, so a replayed message keeps its id; pass ``F.uuid()`` for random
    ones. `clock_col` defaults to now.
    """
    identity = id_col if id_col is not None else E.message_key()
    clock = clock_col if clock_col is not None else F.current_timestamp()
    return df.withColumn("sourceid", F.expr(f"coalesce({source}, {default_source})")).withColumns({
        "messageid": F.concat(identity, F.col("sourceid")),
        "createdate": E.create_date(clock, createdate_format),
    })


def remote_request(df: DataFrame, record: str = "inner", text: str = "inner_text", name: str = "request") -> DataFrame:
    """Adds the registry request of a decoded payload, '' or 0 for what it leaves out."""
    payload = J.json_of_member(text, "_members.payload", "req_payload_kind", "payload")
    return (
        df.selectExpr("*", f"{E.request_members(record)} AS _members")
        .selectExpr("*", *E.request_values("_members"))
        .selectExpr("*", f"{E.remote_request(payload)} AS {name}")
        .drop("_members", *E.VALUE_COLUMNS)
    )


def remote_request_raw(df: DataFrame, payload: str = "payload", name: str = "request") -> DataFrame:
    """Adds the registry request of a payload kept as it came."""
    return df.selectExpr("*", f"{E.remote_request_raw(payload)} AS {name}")


def remote_request_onboard(df: DataFrame, path: str = "path", payload: str = "payload", name: str = "request") -> DataFrame:
    """Adds the registry request of an onboarding message: outer path, Base64-decoded payload text."""
    return df.selectExpr("*", f"{E.remote_request_onboard(path, _as_text(base64_text.decode(payload)))} AS {name}")


def _as_text(data: str) -> str:
    return f"make_valid_utf8(CAST({data} AS STRING))"


# Outer members any shape may need; only text values are valid.
_OUTER = ("sourceid", "payload", "messagetype", "path")
# Columns the second half no longer needs.
_READ = {"text", "msg", "outer", "error", *[f"{name}_kind" for name in _OUTER]}


def standardise(
    parsed: DataFrame,
    routes: tuple[Route, ...] = ROUTES,
    subscription: str | None = None,
    id_col: Column | None = None,
    clock_col: Column | None = None,
    createdate_format: str = E.ISO_MILLIS,
) -> DataFrame:
    """Adds `route` and `envelope` to parsed messages and fills `error` where none can be built.

    `parsed` comes from `parse_json`, optionally through `security_check`.
    Message columns stay, so that the error report can show the message.
    """
    kept = [name for name in parsed.columns if name not in ("text", "msg", "error")]
    shape = _case(routes, lambda r: f"'{r.shape}'")
    default_source = _case(routes, lambda r: f"'{r.default_source}'")

    # What comes before, parsing at least, is a stage of its own: see `evaluated_once` on the size of generated code.
    outer = route(evaluated_once(parsed), routes, subscription).selectExpr(
        "*", f"{shape} AS shape", f"{J.members('msg', _OUTER)} AS outer"
    )
    read = envelope_defaults(
        outer, default_source, id_col, clock_col, createdate_format,
        source="try_variant_get(outer.sourceid, '$', 'string')",
    ).selectExpr(
        "*",
        *[f"schema_of_variant(outer.{name}) AS {name}_kind" for name in _OUTER],
        *[f"try_variant_get(outer.{name}, '$', 'string') AS outer_{name}" for name in _OUTER[1:]],
    )

    # Device and onboarding payloads are Base64; a device payload holds the request as JSON.
    decoded = (
        read.selectExpr(
            "*",
            f"CASE WHEN shape IN ('device', 'onboard') AND payload_kind = '{J.STRING}' "
            f"THEN {base64_text.decode('outer_payload')} END AS bytes",
        )
        .selectExpr("*", f"CASE WHEN shape = 'device' THEN {J.utf8_text('bytes')} END AS inner_text")
        .selectExpr("*", f"CASE shape WHEN 'device' THEN {J.parse_object('inner_text')} WHEN 'strict' THEN msg END AS record")
    )
    carried = [name for name in decoded.columns if name not in _READ]
    # First half ends here: see `evaluated_once` on the size of generated code.
    first = evaluated_once(decoded.selectExpr(*carried, f"coalesce(error, {_outer_problem()}) AS error"))

    values = (
        first.selectExpr("*", f"{E.request_members('record')} AS members")
        .selectExpr("*", *E.request_values("members"))
        .selectExpr(
            "*", f"CASE shape WHEN 'device' THEN {E.type_problem()} WHEN 'strict' THEN {E.strict_problem()} END AS type_problem"
        )
    )
    ill_typed = (
        f"CASE WHEN type_problem IS NULL THEN NULL "
        f"WHEN shape = 'device' THEN {_problem('ENCODE', 'type_problem', 'request field type', quoted=False)} "
        f"ELSE {_problem('RECORD', 'type_problem', 'message does not fit the record', quoted=False)} END"
    )
    others = [name for name in values.columns if name != "error"]
    checked = values.selectExpr(*others, f"coalesce(error, {ill_typed}) AS error")

    payload_json = J.json_of_member("inner_text", "members.payload", "req_payload_kind", "payload")
    request = (
        f"CASE shape WHEN 'device' THEN {E.remote_request(payload_json)} WHEN 'strict' THEN {E.strict_request()} "
        f"WHEN 'onboard' THEN {E.remote_request_onboard('outer_path', _as_text('bytes'))} END"
    )
    kept_type = f"CASE WHEN outer_messagetype = '' THEN '{E.TELEMETRY}' ELSE outer_messagetype END"
    messagetype = _case(routes, lambda r: kept_type if r.messagetype is None else f"'{r.messagetype}'")
    envelope = (
        "named_struct('messageid', messageid, 'sourceid', sourceid, "
        "'payload', CASE shape WHEN 'passthrough' THEN outer_payload WHEN 'strict' THEN '' END, "
        f"'registrypayload', {request}, 'createdate', createdate, 'messagetype', {messagetype})"
    )
    return evaluated_once(
        checked.selectExpr(*kept, "route", "error", f"CASE WHEN error IS NULL THEN {envelope} END AS envelope")
    )


def _problem(stage: str, exception: str, cause: str, quoted: bool = True) -> str:
    return problem(stage, exception, cause, f"standardise/{stage.lower()}", quoted)


def _outer_problem() -> str:
    """SQL of the first step that fails before the request is read, in the order the steps run."""

    def absent(name: str) -> str:
        return J.missing(f"{name}_kind")

    def not_text(name: str) -> str:
        """Present, not null and not text; false when absent."""
        return f"({name}_kind IS NOT NULL AND {name}_kind NOT IN ('{J.STRING}', '{J.NULL}'))"

    return f"""CASE
      WHEN {not_text('sourceid')} THEN {_problem('SOURCEID', 'sourceid is not text', 'wrong type')}
      WHEN shape IN ('device', 'onboard') THEN CASE
        WHEN {not_text('payload')} THEN {_problem('PAYLOAD', 'payload is not text', 'wrong type')}
        WHEN shape = 'device' AND {absent('payload')} THEN {_problem('PAYLOAD', 'payload is missing', 'missing value')}
        WHEN NOT {absent('payload')} AND bytes IS NULL THEN {_problem('PAYLOAD', 'payload is not Base64', 'malformed input')}
        WHEN shape = 'device' AND record IS NULL THEN {_problem('PAYLOAD', 'decoded payload is not a JSON object', 'malformed input')}
        WHEN shape = 'onboard' AND {not_text('path')} THEN {_problem('ENCODE', 'path has the wrong type', 'request field is text')}
      END
      WHEN shape = 'passthrough' THEN CASE
        WHEN {absent('messagetype')} THEN {_problem('MESSAGETYPE', 'messagetype is missing', 'missing value')}
        WHEN {not_text('messagetype')} THEN {_problem('ENCODE', 'messagetype has the wrong type', 'envelope field is text')}
        WHEN {not_text('payload')} THEN {_problem('ENCODE', 'payload has the wrong type', 'envelope field is text')}
      END
    END"""


def of_route(messages: DataFrame, *names: str, routes: tuple[Route, ...] = ROUTES) -> DataFrame:
    """The messages the named routes will handle, by tests of the topic that reach the scan."""
    chosen = F.lit(False)
    for at, r in enumerate(routes):
        if r.name in names:
            taken = [e.prefix for e in routes[:at] if e.prefix.startswith(r.prefix) or r.prefix.startswith(e.prefix)]
            test = F.col("topic").startswith(r.prefix)
            for prefix in taken:
                test = test & ~F.col("topic").startswith(prefix)
            chosen = chosen | test
    return messages.where(chosen)


def registry_whole_message(
    parsed: DataFrame,
    id_col: Column | None = None,
    clock_col: Column | None = None,
    sourceid: str = "default",
    messagetype: str = E.REGISTRY_RESPONSE,
) -> DataFrame:
    """Adds `envelope` with the whole message as payload text, under one fixed source and type."""
    whole = message_text(parsed, "_whole")
    return _wrapped(whole, F.col("_whole"), id_col, clock_col, sourceid, messagetype, E.ISO_MILLIS)


def simple_wrap(
    messages: DataFrame,
    sourceid: str,
    id_col: Column | None = None,
    clock_col: Column | None = None,
    messagetype: str = E.REGISTRY_POST,
    createdate_format: str = E.ISO_MILLIS,
) -> DataFrame:
    """Adds `envelope` with the message bytes as text, whatever they hold; bytes that are not UTF-8 become U+FFFD.

    Pass ``createdate_format=TWELVE_HOUR`` for the shorter clock text without millis.
    """
    return _wrapped(messages.withColumn("error", no_problem()), F.expr(_as_text("value")), id_col, clock_col, sourceid, messagetype, createdate_format)


def _wrapped(df, payload, id_col, clock_col, sourceid, messagetype, createdate_format) -> DataFrame:
    identity = id_col if id_col is not None else E.message_key()
    clock = clock_col if clock_col is not None else F.current_timestamp()
    envelope = F.struct(
        F.concat(identity, F.lit(sourceid)).alias("messageid"),
        F.lit(sourceid).alias("sourceid"),
        payload.alias("payload"),
        F.lit(None).cast(REMOTE_REQUEST).alias("registrypayload"),
        E.create_date(clock, createdate_format).alias("createdate"),
        F.lit(messagetype).alias("messagetype"),
    )
    kept = [name for name in df.columns if name not in ("text", "msg", "_whole")]
    return evaluated_once(df.select(*kept, F.when(F.col("error").isNull(), envelope).cast(ENVELOPE).alias("envelope")))


__all__ = [
    "ROUTES", "Route", "envelope_defaults", "of_route", "parse_json", "registry_whole_message",
    "remote_request", "remote_request_onboard", "remote_request_raw", "route", "simple_wrap", "standardise",
]
