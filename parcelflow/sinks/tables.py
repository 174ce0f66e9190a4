"""Rows for a SQL store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sql_rows(envelopes: DataFrame, clock: Column | None = None) -> DataFrame:
    """One row per message: CREATED_TIME, then id and the plain envelope columns; key (CREATED_TIME, id)."""
    created = clock if clock is not None else F.current_timestamp()
    return envelopes.select(
        created.alias("CREATED_TIME"), F.col("messageid").alias("id"), "sourceid", "payload", "messagetype", "createdate"
    )


def insert_sql(
    rows: DataFrame, url: str, table: str, connections: int = 8, stored: DataFrame | None = None, **options: str
) -> None:
    """Append rows to a table through JDBC, over a bounded number of connections.

    `stored`, the table's (CREATED_TIME, id) of the batch's time range, leaves
    out what an earlier attempt of the batch already inserted.
    """
    unsent = rows if stored is None else rows.join(stored, ["CREATED_TIME", "id"], "left_anti")
    (
        # Dealt out last: the writer would run all that comes before in so few tasks.
        unsent.repartition(connections).write.format("jdbc")
        .options(url=url, dbtable=table, numPartitions=str(connections), **options)
        .mode("append")
        .save()
    )
