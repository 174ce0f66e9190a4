"""Publishing to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .files import write_batch


def publish(
    df: DataFrame, topic: str, path: str | None = None, batch_id: int | str | None = None, value: str = "value", **options: str
) -> None:
    """Value bytes to one topic, without a key.

    Without `path` the message bus is written (format ``kafka``, `options` name
    its servers); with `path` a parquet topic folder takes its place.
    """
    messages = df.select(F.lit(topic).alias("topic"), F.col(value).cast("binary").alias("value"))
    if path is None:
        messages.write.format("kafka").options(**options).save()
    else:
        write_batch(messages, path, batch_id, ("topic",))
