"""Everything written to files.

Each write goes to partitions that carry the name of its run and replaces only
them. A micro-batch is named by its stream's id, which the checkpoint keeps, and
its number: run again it leaves one copy, and a new stream adds to what is
there. A batch job is named by its caller, or else by a new name each time. A
caller that wants a replay from a new checkpoint to replace the old rows names
the run itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.envelope import create_date

_REPLACE = {"partitionOverwriteMode": "dynamic"}


def run_name(spark: SparkSession, batch_id: int | str | None) -> str:
    """The run a write belongs to: the stream's id, a new name, or the caller's name (its batch)."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return stream or (uuid.uuid4().hex if batch_id is None else "named")


def write_batch(
    df: DataFrame, path: str, batch_id: int | str | None = None, partition_by: tuple[str, ...] = (), fmt: str = "parquet",
    run: str | None = None, add: bool = False,
) -> None:
    """Write one batch's rows, replacing what an earlier attempt of the same batch wrote.

    `partition_by` columns come first, so that a filter on them prunes files.
    With `add` the rows join those of earlier attempts.
    """
    columns = [*partition_by, "batch", "run"]
    numbered = df.withColumns({"batch": F.lit(str(batch_id or 0)), "run": F.lit(run or run_name(df.sparkSession, batch_id))})
    mode = "append" if add else "overwrite"
    numbered.write.format(fmt).mode(mode).options(**_REPLACE).partitionBy(*columns).save(path)


def _day():
    return create_date(F.col("timestamp"), "yyyyMMdd")


def _one_line(text):
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def archive_raw(df: DataFrame, root: str, app: str, batch_id: int | str | None = None, fmt: str = "parquet", run: str | None = None) -> str:
    """Messages as received below ``root/app/RAW``, by the UTC day of each message. Returns the folder.

    With ``fmt="text"`` a row is ``received | key | value`` on one line per
    message; line breaks in it are written as \\n and \\r.
    """
    path = f"{root}/{app}/RAW"
    dated = df.withColumn("day", _day())
    if fmt == "text":
        text = F.concat_ws(
            " | ", F.col("timestamp").cast("string"), F.coalesce("key", F.lit("")),
            F.make_valid_utf8(F.col("value").cast("string")),
        )
        write_batch(dated.select(_one_line(text).alias("line"), "day"), path, batch_id, ("day",), "text", run)
    else:
        position = [name for name in ("partition", "offset") if name in df.columns]
        write_batch(dated.select("timestamp", "topic", *position, "key", "value", "day"), path, batch_id, ("day",), run=run)
    return path


def compact(spark: SparkSession, path: str, into: str, day: str, fmt: str = "parquet") -> str:
    """Copy one finished day of an archive to the folder `into`, in few files. Returns that folder.

    A short interval leaves a folder per batch and run; the copy has one folder
    per day, with files of the session's advisory size. Run again it replaces
    the day, so it can be repeated before the day's batch folders are removed.
    """
    rows = spark.read.format(fmt).option("basePath", path).load(f"{path}/day={day}").drop("batch", "run")
    balanced = rows.withColumn("day", F.lit(day)).hint("rebalance")
    balanced.write.format(fmt).mode("overwrite").options(**_REPLACE).partitionBy("day").save(into)
    return into


def archive_parsed(df: DataFrame, root: str, app: str, batch_id: int | str | None = None, json_col: str = "json") -> str:
    """Parsed messages as JSON lines below ``root/app/PARSED``; rows without JSON text are left out."""
    path = f"{root}/{app}/PARSED"
    lines = df.withColumn("day", _day()).select(F.col(json_col).alias("line"), "day").where("line IS NOT NULL")
    write_batch(lines, path, batch_id, ("day",), "text")
    return path


def write_errors(letters: DataFrame, path: str, batch_id: int | str | None = None) -> str:
    """Dead letters as a table, by the step that set them aside."""
    write_batch(letters, path, batch_id, ("stage",))
    return path


def overwrite_text(df: DataFrame, path: str, col: str = "value") -> str:
    """Replace a text file (a folder of parts) by one line per row; line breaks are written as \\n and \\r."""
    df.select(_one_line(F.col(col).cast("string")).alias("value")).write.mode("overwrite").text(path)
    return path
