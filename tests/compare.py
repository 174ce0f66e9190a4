"""Run a query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES.split():
        path = os.path.join(folder, f"{name}.parquet")
        if glob.glob(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of_sql(connection, sql: str):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, connection, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    names, rows = rows_of_sql(connection, sql)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    mine = ordered(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = ordered(names, rows)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a!r:.600} != {b!r:.600}"
    return None
