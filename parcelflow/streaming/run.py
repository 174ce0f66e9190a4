"""Starting streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.files import write_batch

Step = Callable[[DataFrame, int], None]

#: What `observed_counts` names the messages of all topics it was not told of.
OTHER = "(other)"


def run_stream(
    stream: DataFrame, step: Step, checkpoint: str, interval: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Run a step on each micro-batch; without an interval all available input is taken once.

    `checkpoint` is a folder every executor can reach. A batch counts as done
    when its step has returned, and one that was interrupted is run again with
    the same number and rows: steps write through `write_batch`.
    """
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def foreach_batch(*steps: Step, keep: bool = True) -> Step:
    """Several steps over one micro-batch, computed once.

    The batch is persisted while its steps run; a lost part of it is computed
    again from the source. `keep=False` reads the source again for each step,
    which suits a backfill larger than the executors' disks.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        shared = batch.persist(StorageLevel.MEMORY_AND_DISK) if keep and len(steps) > 1 else batch
        try:
            for step in steps:
                step(shared, batch_id)
        finally:
            if shared is not batch or shared.is_cached:
                shared.unpersist()

    return run


def repartition(df: DataFrame, partitions: int = 6) -> DataFrame:
    """A fixed number of partitions before publishing, spread evenly whatever the keys."""
    return df.repartition(partitions)


def count_batch(path: str, by: tuple[str, ...] = ("topic",)) -> Step:
    """A step that writes how many messages each batch held."""

    def step(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("messages"))
        write_batch(counts, path, batch_id)

    return step


def observed_counts(step: Step, topics: Sequence[str], report: Callable[[int, dict[str, int]], None]) -> Step:
    """`step`, with the messages per topic counted while it reads its batch: no job of its own.

    After the step, `report` is told the batch's number and its messages by
    topic; those of topics not listed, or of none, count under `OTHER`. A batch
    run again is reported again under the same number, so a report that
    keeps one entry per number adds up after a restart. The counts are those of
    the first action of the step, which has to read the whole batch; a stage
    run again after a lost executor may count its messages twice, where
    `count_batch` does not.
    """
    names = list(dict.fromkeys(topics))

    def counting(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        hits = [F.count_if(F.col("topic") == name).alias(f"n{k}") for k, name in enumerate(names)]
        step(batch.observe(seen, F.count(F.lit(1)).alias("all"), *hits), batch_id)
        got = seen.get
        counts = {name: got.get(f"n{k}", 0) for k, name in enumerate(names)}
        counts[OTHER] = got.get("all", 0) - sum(counts.values())
        report(batch_id, {name: n for name, n in counts.items() if n})

    return counting
