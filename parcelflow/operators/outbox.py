"""Fired rules to prepared requests, their delivery, and look-ups answered by requests."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.envelope import create_date
from ..schemas import OUTBOX
from ..sinks.files import run_name, write_batch
from .lookup import left_lookup
from .outcome import error_reports

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: what a failed call's result starts with.
EXCEPTION = "EXCEPTION_"


def _headers(text: Column) -> Column:
    """Header text as a map: a JSON object's members, else the text itself under `header`."""
    parsed = F.from_json(text, "map<string,string>")
    nothing = F.from_json(F.lit("{}"), "map<string,string>")
    return F.when(F.coalesce(text, F.lit("")) == "", nothing).otherwise(
        F.coalesce(parsed, F.create_map(F.lit("header"), text))
    )


def build_outbox(fired: DataFrame) -> DataFrame:
    """One request per fired rule, from the envelope and the rule's action, target and params.

    A rule's own `path` and `header` win over the message's. GET asks for the
    payload as path and has no body; a rule with schema ``registry`` sends the
    registry request alone, every other the whole envelope. MQTT requests carry
    `clientId` and `qos` as headers. A request keeps its rule's salience, so
    that a receiver can keep the order in which the rules of a message rank.
    """
    request, params = F.col("registrypayload"), F.col("params")
    path = F.coalesce(
        params["path"], F.when(F.col("action") == "GET", F.col("payload")), request["path"], F.lit("")
    )
    mqtt = F.create_map(
        F.lit("clientId"), F.coalesce(params["clientId"], F.lit("")), F.lit("qos"), F.coalesce(params["qos"], F.lit("0"))
    )
    envelope = F.to_json(
        F.struct("messageid", "sourceid", "payload", "registrypayload", "createdate", "messagetype"),
        {"ignoreNullFields": "false"},
    )
    schema_ref = F.coalesce(params["schema"], F.lit("envelope"))
    body = F.when(F.col("action") == "GET", None).when(
        schema_ref == "registry", F.coalesce(F.to_json(request, {"ignoreNullFields": "false"}), F.col("payload"))
    ).otherwise(envelope)
    return fired.select(
        "messageid", "ruleset", "rule_id", "channel", F.col("action").alias("method"), F.col("target").alias("uri"),
        path.alias("path"),
        F.when(F.col("channel") == "MQTT", mqtt)
        .otherwise(_headers(F.coalesce(params["header"], request["header"])))
        .alias("headers"),
        body.alias("body"), schema_ref.alias("schema_ref"), "salience",
    ).select(*OUTBOX.names)


def error_outbox(letters: DataFrame, uri: str, path: str = "exceptions") -> DataFrame:
    """Dead letters as requests to the exception index.

    A request's id is a hash of the message's position and what is wrong with
    it, so equal messages have different ids and a replay has the same.
    """
    told = F.to_json(F.struct("topic", "partition", "offset", "key", F.base64("value").alias("value"), F.unix_micros("ts").alias("ts"), "stage", "exception"))
    return error_reports(letters).select(
        F.md5(told).alias("messageid"), F.lit("errors").alias("ruleset"), F.lit("exception_index").alias("rule_id"),
        F.lit("ES").alias("channel"), F.lit("POST").alias("method"), F.lit(uri).alias("uri"),
        F.lit(path).alias("path"), _headers(F.lit("")).alias("headers"), "body", F.lit("none").alias("schema_ref"),
        F.lit(0).alias("salience"),
    ).select(*OUTBOX.names)


# What one request of a batch is known by.
_REQUEST = ("messageid", "ruleset", "rule_id", "channel")
_RESULT = "messageid string, ruleset string, rule_id string, channel string, result string"


def deliver(outbox: DataFrame, send: Callable[[dict], str], partitions: int | None = None) -> DataFrame:
    """Adds `result`: what `send(request)` returned, or EXCEPTION_ and the failure's text.

    `send` runs in the tasks, once per request and attempt; a failing call never
    stops the others. The frame is lazy: write the results once and read them
    from there (`sinks.write_batch`), or each use sends again. A task that is
    run again sends again, so receivers should treat (messageid, rule_id) as
    the request's identity.
    """
    spread = outbox.repartition(partitions, "messageid", "rule_id") if partitions else outbox

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = []
            for request in batch.to_dict("records"):
                try:
                    results.append(send(request))
                except Exception as failure:  # noqa: BLE001 - any failure is a result
                    results.append(f"{EXCEPTION}{failure}")
            kept = batch[list(_REQUEST)]
            yield kept.assign(result=pd.Series(results, index=kept.index, dtype=object))

    return spread.mapInPandas(run, _RESULT)


def _stored_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A stored frame, or None where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def deliver_once(
    outbox: DataFrame, send: Callable[[dict], str], path: str, batch_id: int | str | None = None, partitions: int | None = None,
    run: str | None = None,
) -> None:
    """Delivers a batch and writes its results to `path`; what the batch has results for is not sent again.

    The results are the record: a batch that is run again, after a crash between
    its results and the stream's checkpoint, reads those of its own number and
    run (one folder, whatever the history), sends the requests that have none
    and adds theirs. A failed call has a result too. Requests lost with a
    task before the results were written are sent again. Requests that agree
    in messageid, ruleset, rule_id and channel, nulls included, are the same
    request, and each of them is sent when none has a result.
    """
    run, number = run or run_name(outbox.sparkSession, batch_id), str(batch_id or 0)
    for name in (run, number):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"a run and a batch are named by letters, digits, '_', '.' and '-', not {name!r}")
    known = _stored_or_none(outbox.sparkSession, f"{path}/batch={number}/run={run}", _RESULT)
    if known is not None:
        known = known.select(*(F.col(name).alias(f"_{name}") for name in _REQUEST))
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in _REQUEST]
        outbox = outbox.join(known, same, "left_anti")
    write_batch(deliver(outbox, send, partitions), path, batch_id, run=run, add=known is not None)


def request_key(url: Column, data: Column, attr: Column) -> Column:
    """One text per distinct request; `attr`, a map, counts regardless of its order."""
    return F.to_json(
        F.struct(url.alias("url"), data.alias("data"), F.array_sort(F.map_entries(attr)).alias("attr")),
        {"ignoreNullFields": "false"},
    )


def request_hash(request: Column) -> Column:
    """128 bits that stand for a request's text where it is grouped and joined."""
    return F.unhex(F.md5(request.cast("binary")))


_ANSWER = "request binary, answer string, ok boolean, fetched_at timestamp, hour string"


def _hour(clock: Column) -> Column:
    return create_date(clock, "yyyyMMddHH")


def _recent(spark: SparkSession, cache: str, now: Column, ttl: str) -> DataFrame:
    """Stored answers younger than `ttl`; the hour they were fetched in prunes the rest of the folder."""
    oldest = now - F.expr(f"INTERVAL {ttl}")
    stored = _stored_or_none(spark, cache, _ANSWER)
    if stored is None:
        stored = spark.createDataFrame([], _ANSWER)
    return stored.where(F.col("hour") >= _hour(oldest)).where(F.col("fetched_at") > oldest)


def enrich_cached(
    df: DataFrame,
    lookup: Callable[[dict], str],
    url: Column,
    data: Column,
    attr: Column,
    cache: str,
    ttl: str = "1 HOUR",
    now: Column | None = None,
    name: str = "answer",
    partitions: int | None = None,
) -> DataFrame:
    """Adds `answer`, asking once per distinct (url, data, attr).

    Answers younger than `ttl` are taken from `cache`, a folder every executor
    can reach; the rest are asked in the tasks, appended to it, and read from
    there, so that no later use and no lost executor asks again. A failed call
    gives EXCEPTION_ and its text and is asked again next time. `partitions`
    sets how many tasks ask at the same time.
    """
    # One instant for the whole call, also where its result is computed later.
    clock = now if now is not None else F.current_timestamp()
    now = F.timestamp_micros(F.lit(df.sparkSession.range(1).select(F.unix_micros(clock)).first()[0]))
    asked = df.withColumn("request", request_hash(request_key(url, data, attr)))
    # Repeats go by hash, where `first` of a text would sort every row that a task reads; `first` then meets the distinct ones.
    several = asked.select("request", url.alias("url"), data.alias("data"), F.array_sort(F.map_entries(attr)).alias("attr")).distinct()
    distinct = several.groupBy("request").agg(F.first("url").alias("url"), F.first("data").alias("data"), F.first("attr").alias("attr"))
    kept = _recent(df.sparkSession, cache, now, ttl).where("ok").select("request").distinct()
    missing = distinct.join(kept, "request", "left_anti")
    if partitions:
        missing = missing.repartition(partitions)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, good = [], []
            for row in batch.to_dict("records"):
                attributes = {entry["key"]: entry["value"] for entry in (row["attr"] if row["attr"] is not None else [])}
                try:
                    answers.append(lookup({"url": row["url"], "data": row["data"], "attr": attributes}))
                    good.append(True)
                except Exception as failure:  # noqa: BLE001
                    answers.append(f"{EXCEPTION}{failure}")
                    good.append(False)
            yield pd.DataFrame({"request": batch["request"], "answer": answers, "ok": good})

    fetched = missing.mapInPandas(ask, "request binary, answer string, ok boolean")
    # Failures are stored for this call's read-back; `ok` keeps them from being reused.
    fetched.select("*", now.alias("fetched_at"), _hour(now).alias("hour")).write.mode("append").partitionBy("hour").parquet(cache)
    stored = _recent(df.sparkSession, cache, now, ttl)
    best = stored.groupBy("request").agg(F.max_by("answer", F.struct("ok", "fetched_at")).alias(name))
    return left_lookup(asked, best, ["request"]).drop("request")
