"""Messages of a list of topics, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import MESSAGE
from ..session import configure


def read_messages(
    spark: SparkSession,
    topics: str,
    mode: str = "stream",
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Rows of the MESSAGE shape for a comma-separated topic list.

    Without `path` the message bus is read (format ``kafka``; the connector
    package has to be on the class path and `options` name its servers). With
    `path` the topics are read from a parquet folder of MESSAGE rows; the topic
    test reaches the scan.
    """
    configure(spark)
    names = [name.strip() for name in topics.split(",") if name.strip()]
    reader = spark.readStream if mode == "stream" else spark.read
    if path is None:
        bus = reader.format("kafka").options(**options).option("subscribe", ",".join(names)).load()
        return bus.withColumn("key", F.col("key").cast("string")).select(*MESSAGE.names)
    return reader.schema(MESSAGE).options(**options).parquet(path).where(F.col("topic").isin(names))


def spread(df: DataFrame, per_core: int = 1) -> DataFrame:
    """Input in fewer splits than there are cores, spread over all of them.

    Parsing costs far more per row than moving it, so a batch of a few small
    files is worth one shuffle of its raw rows. Input with enough splits, the
    usual case, is returned as it is. Splits need not hold equal shares of the
    rows (a file's row groups stay whole): for narrow rows, `per_core` asks for
    so many parts per core.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism * per_core
    if df.isStreaming or df.rdd.getNumPartitions() >= parts:
        return df
    return df.repartition(parts)
