"""The whole jobs, as steps over one batch of messages; a stream runs them per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.envelope import TWELVE_HOUR
from ..operators import avro, outbox as O, outcome, parse, rules as R, standardise as S
from ..schemas import ENVELOPE, ENVELOPE_AVRO, MESSAGE
from ..sinks import files, tables, topics


@dataclass(frozen=True)
class Target:
    """Where a job writes: one folder tree, or the bus for the output topic when `bus` is given.

    Envelopes are published in `encoding`, Avro or JSON text.
    """

    root: str
    app: str
    topic: str = "envelopes"
    bus: dict | None = None
    encoding: str = "avro"

    def publish(self, df: DataFrame, batch_id: int | str | None) -> None:
        if self.bus is None:
            topics.publish(df, self.topic, f"{self.root}/{self.app}/TOPIC", batch_id)
        else:
            topics.publish(df, self.topic, **self.bus)


def pack(envelopes: DataFrame, encoding: str) -> DataFrame:
    """Adds `value`, the struct `envelope` as bytes in ``avro`` or ``json``."""
    if encoding == "json":
        return envelopes.withColumn("value", F.to_json("envelope", {"ignoreNullFields": "false"}).cast("binary"))
    if encoding == "avro":
        return avro.encode_avro(envelopes, "envelope", ENVELOPE_AVRO)
    raise ValueError(f"encoding is avro or json, not {encoding!r}")


def unpack(messages: DataFrame, encoding: str) -> DataFrame:
    """Adds `envelope`, read from `value`; NULL where the bytes are no envelope."""
    if encoding == "json":
        read = messages.withColumn("envelope", F.from_json(F.make_valid_utf8(F.col("value").cast("string")), ENVELOPE))
        return read.withColumn("envelope", F.when(F.col("envelope.messageid").isNotNull(), F.col("envelope")))
    if encoding == "avro":
        return avro.decode_avro(messages, "value", ENVELOPE_AVRO)
    raise ValueError(f"encoding is avro or json, not {encoding!r}")


def _checked(messages: DataFrame, check: Column | None, tokens: DataFrame | None) -> DataFrame:
    """Parsed messages after the security check, by a predicate, a token table or both, with their JSON text."""
    checked = outcome.security_check(parse.parse_json(messages), check)
    return parse.message_text(checked if tokens is None else outcome.security_check_by_token(checked, tokens))


def _write(messages: DataFrame, built: DataFrame, target: Target, batch_id: int | str | None, keep: bool) -> None:
    """Archive, publish and set aside. `built` carries `envelope`, `error` and, when parsed, `json`.

    The built frame holds every message and is computed once for all writes, so
    that the source is read once; `keep=False` computes it per write instead
    and needs no room for it.
    """
    shared = built.persist(StorageLevel.MEMORY_AND_DISK) if keep else built
    try:
        files.archive_raw(shared if keep else messages, target.root, target.app, batch_id)
        if "json" in built.columns:
            files.archive_parsed(shared, target.root, target.app, batch_id)
        good, bad = outcome.split_errors(shared)
        target.publish(pack(good.select(F.struct(*ENVELOPE.names).alias("envelope")), target.encoding), batch_id)
        files.write_errors(bad, f"{target.root}/{target.app}/ERRORS", batch_id)
    finally:
        if keep:
            shared.unpersist()


def security_job(
    messages: DataFrame, target: Target, batch_id: int | str | None = None, check: Column | None = None, keep: bool = True,
    tokens: DataFrame | None = None, **options,
) -> None:
    """JSON topics to envelopes, the shape by topic."""
    _write(messages, S.standardise(_checked(messages, check, tokens), **options), target, batch_id, keep)


def registry_job(
    messages: DataFrame, target: Target, batch_id: int | str | None = None, check: Column | None = None, keep: bool = True,
    tokens: DataFrame | None = None, **options,
) -> None:
    """Registry answers, each whole message as payload."""
    _write(messages, S.registry_whole_message(_checked(messages, check, tokens), **options), target, batch_id, keep)


def simple_job(
    messages: DataFrame, target: Target, sourceid: str, batch_id: int | str | None = None, partitions: int | None = None, keep: bool = True, **options
) -> None:
    """Any text, one shape; over `partitions` tasks when given, else as it was read."""
    built = S.simple_wrap(messages, sourceid, **{"createdate_format": TWELVE_HOUR, **options})
    _write(messages, built.repartition(partitions) if partitions else built, target, batch_id, keep)


def business_job(
    messages: DataFrame,
    rules: DataFrame | Callable[[], DataFrame],
    send: Callable[[dict], str],
    target: Target,
    batch_id: int | str | None = None,
    jdbc: dict | None = None,
    error_uri: str | None = None,
    encoding: str = "avro",
) -> None:
    """Envelopes to rules to requests. Results are written once per batch, and a batch run again sends only what has none.

    `encoding` is that of the messages, Avro or JSON text. `rules` may be a function, which reads them anew for every batch of a
    stream. SQL rows go to `jdbc`, the options of `insert_sql`, under the
    message's own time, so that a batch run again repeats their keys. Rows that
    have nowhere to go, for want of `jdbc` or a channel, become errors. With
    `error_uri` every error is also sent to the exception index.
    """
    rules = rules() if callable(rules) else rules
    decoded = unpack(messages, encoding).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [decoded]
    try:
        files.archive_raw(decoded, target.root, target.app, batch_id)
        bad = outcome.problem("DECODE", "message is not an envelope", "malformed input", "business_job")
        read = decoded.where("envelope IS NOT NULL")
        files.archive_parsed(read.withColumn("json", F.to_json("envelope")), target.root, target.app, batch_id)
        received = [name for name in MESSAGE.names if name in messages.columns]
        # Kept for the errors, the requests, their reports and the SQL rows, which all read it.
        fired = R.evaluate_rules(R.select_ruleset(read.select(*received, "envelope.*"), rules), rules).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(fired)
        lost = "channel IS NULL" if jdbc is not None else "channel IS NULL OR channel = 'SQL'"
        nowhere = outcome.problem(
            "DELIVER", "concat('rule ', coalesce(rule_id, ''), ' has no channel or store to go to')", "not delivered", "business_job", quoted=False)
        failed = decoded.where("envelope IS NULL").select(*received, F.expr(bad).alias("error"))
        unplaced = fired.where(lost).select(*received, F.expr(nowhere).alias("error"))
        letters = outcome.dead_letters(failed.unionByName(unplaced))
        files.write_errors(letters, f"{target.root}/{target.app}/ERRORS", batch_id)
        requests = O.build_outbox(fired.where("channel != 'SQL'"))
        if error_uri is not None:
            requests = requests.unionByName(O.error_outbox(letters, error_uri))
        O.deliver_once(requests, send, f"{target.root}/{target.app}/RESULTS", batch_id)
        if jdbc is not None:
            tables.insert_sql(tables.sql_rows(fired.where("channel = 'SQL'"), F.col("timestamp")), **jdbc)
    finally:
        for frame in kept:
            frame.unpersist()
