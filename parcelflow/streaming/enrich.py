"""Look-ups of a stream, answered from keyed state that forgets after a time."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructType

from ..operators.outbox import EXCEPTION, request_hash, request_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# State that can expire needs this store. Empty batches would go on for ever, since time alone is a
# reason for one; an expired answer is passed over when it is read, so none is needed.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class _Answers(StatefulProcessor):
    """One answer per request, kept for `ttl_ms` after it was given."""

    def __init__(self, lookup: Callable[[dict], str], ttl_ms: int) -> None:
        self.lookup, self.ttl_ms = lookup, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("answer", "answer string", self.ttl_ms)

    def _ask(self, asked: Row) -> str | None:
        """The answer, kept when the call succeeds; a failure is told to this batch's rows only."""
        try:
            answer = self.lookup({"url": asked["url"], "data": asked["data"], "attr": dict(asked["attr"] or {})})
        except Exception as failure:  # noqa: BLE001 - any failure is an answer
            return f"{EXCEPTION}{failure}"
        self.kept.update((answer,))
        return answer

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # None where there is none: asking `exists` first would be a second call to the store for each request.
        known = self.kept.get()
        answer, asked = (known[0], True) if known is not None else (None, False)
        for row in rows:
            if not asked:
                answer, asked = self._ask(row["asked"]), True
            yield Row(row=row["row"], answer=answer)

    def close(self) -> None:
        pass


def start_keyed(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """`start()`, under the settings keyed state with a time limit needs; a query keeps those it was started with.

    The session has its own back afterwards, so that other streams keep their stores and empty batches.
    """
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def enrich_stream(
    stream: DataFrame,
    lookup: Callable[[dict], str],
    url: Column,
    data: Column,
    attr: Column,
    ttl_seconds: float = 3600,
    name: str = "answer",
    spread: int = 1,
) -> DataFrame:
    """Adds `answer` to a stream, asking once per distinct (url, data, attr) and `ttl_seconds`.

    Answers are keyed state in the stream's checkpoint: later batches, and a stream
    started again from there, take them from it until they expire, without a folder
    to read. A batch that failed before its state was committed asks again.
    A failed call gives EXCEPTION_ and its text to the rows of its batch and is asked again by
    the next. A null url, data or attr is a value like others.

    Rows of a request meet in one task, where they pass one by one and none is held. With
    `spread`, those of one request are dealt to so many tasks by a hash of the row, each of
    which asks for itself: for requests that hold much of the stream.

    The frame is for streams; start its query with `start_keyed`.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns]).alias("row")
    asked = F.struct(url.cast("string").alias("url"), data.cast("string").alias("data"), attr.alias("attr")).alias("asked")
    dealt = F.pmod(F.xxhash64(F.to_json(F.struct("row"))), F.lit(spread)) if spread > 1 else F.lit(0)
    keyed = stream.select(row, asked, F.hex(request_hash(request_key(url, data, attr))).alias("request"))
    keyed = keyed.withColumn("part", dealt.cast("int"))
    shape = StructType([keyed.schema["row"]]).add("answer", StringType())
    answered = keyed.groupBy("request", "part").transformWithState(
        statefulProcessor=_Answers(lookup, int(ttl_seconds * 1000)), outputStructType=shape, outputMode="Append", timeMode="ProcessingTime"
    )
    return answered.select("row.*", F.col("answer").alias(name))
