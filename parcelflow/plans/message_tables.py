"""Messages derived from the test tables, one message per row of the table.

The tables hold no device messages, so each row is dressed as one: topics,
sources and types follow the row's id, the content is the row's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import MESSAGE
from ..session import configure
from ..sources.messages import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def utc_instant(df: DataFrame, column: str) -> Column:
    """A wall-clock column as an instant, read as UTC whatever the session's zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column)).cast("timestamp")
    return F.col(column)


def _choice(index: Column, *values: str | None) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# Fixed values of the derived messages.
TOPICS = ("device.event", "device.out", "device.onboard", "out.registry.topic", "in.topic.oneid", "jsonexternaltopic")
SOURCES = ("default", "kaniu", "yaima", "oneid", "customer2", "device1", None)


def event_message_rows(events: DataFrame) -> DataFrame:
    """MESSAGE rows of an `events` frame, batch or stream."""
    event_id = F.col("event_id")
    tenth = F.floor(event_id / 6) % 10
    status = F.floor(event_id / 6) % 3
    messagetype = F.when(tenth == 0, F.lit(None)).when(tenth == 1, "").otherwise("TELEMETRY")
    source = _choice(F.col("user_id") % 7, *SOURCES)
    path = F.concat(F.lit("/a/"), F.col("event_type"))

    inner = F.concat(
        F.lit('{"path":"'), path, F.lit('","verb":"POST","statusCode":'), status.cast("string"),
        F.lit(',"payload":'), F.col("props"), F.lit(',"txId":"'), event_id.cast("string"), F.lit('"}'),
    )
    device = F.to_json(F.struct(
        path.alias("path"), F.base64(inner.cast("binary")).alias("payload"),
        source.alias("sourceid"), messagetype.alias("messagetype"),
    ))
    registry = F.to_json(F.struct(
        path.alias("path"), F.lit("POST").alias("verb"),
        F.when(event_id % 50 != 3, status.cast("int")).alias("statusCode"),
        F.col("props").alias("payload"), event_id.cast("string").alias("txId"),
        F.col("user_id").cast("string").alias("deviceId"), F.lit("hub-request").alias("header"),
        source.alias("sourceid"), messagetype.alias("messagetype"),
    ))
    plain = F.to_json(F.struct(
        F.col("props").alias("payload"), source.alias("sourceid"), messagetype.alias("messagetype"),
    ))
    topic_index = event_id % 6
    value = (
        F.when(event_id % 97 == 0, F.concat(F.lit("not json "), event_id.cast("string")))
        .when(topic_index < 3, device)
        .when(topic_index == 3, registry)
        .otherwise(plain)
    )
    return events.select(
        _choice(topic_index, *TOPICS).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        event_id.alias("offset"),
        utc_instant(events, "ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        value.cast("binary").alias("value"),
    ).to(MESSAGE)


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    return event_message_rows(spread(table(spark, folder, "events"), per_core=3))


def conversation_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Long multilingual text as telemetry: JSON with the turn as payload."""
    turns = spread(table(spark, folder, "conversations"))
    body = F.to_json(F.struct(
        F.when(F.col("role") != "system", F.concat(F.lit("conv"), F.col("conv_id") % 5)).alias("sourceid"),
        F.col("text").alias("payload"),
        F.when(F.col("role") == "assistant", "").otherwise(F.upper("role")).alias("messagetype"),
    ))
    return turns.select(
        F.lit("in.topic.oneid").alias("topic"),
        (F.col("conv_id") % 4).cast("int").alias("partition"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("conv_id").cast("string").alias("key"),
        body.cast("binary").alias("value"),
    ).to(MESSAGE)


def document_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as plain-text messages."""
    documents = spread(table(spark, folder, "documents"))
    return documents.select(
        F.lit("text.documents").alias("topic"),
        (F.col("doc_id") % 4).cast("int").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("source").alias("key"),
        F.col("text").cast("binary").alias("value"),
    ).to(MESSAGE)


def customer_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A message per customer, with the customer's token, another's, or none."""
    customers = spread(table(spark, folder, "customer"))
    token = _choice(F.col("c_custkey") % 3, "own", "other", None)
    own = F.concat(F.lit("t-"), F.col("c_custkey"))
    members = F.struct(
        F.col("c_name").alias("sourceid"), F.col("c_mktsegment").alias("payload"), F.lit("TELEMETRY").alias("messagetype"),
        F.when(token == "own", own).when(token == "other", F.concat(own, F.lit("0"))).alias("authentication"),
    )
    return customers.select(
        F.lit("jsonexternaltopic").alias("topic"),
        (F.col("c_custkey") % 4).cast("int").alias("partition"),
        F.col("c_custkey").cast("bigint").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("c_custkey").cast("string").alias("key"),
        F.to_json(members).cast("binary").alias("value"),
    ).to(MESSAGE)
