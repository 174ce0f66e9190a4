"""Byte-balanced shards for indivisible groups by Karmarkar-Karp differencing.

A partial partition is a list of shard totals. Differencing starts with one
partial partition per group, (size, 0, ..., 0), and combines the two with the
largest spread, the largest total of one with the smallest of the other, until
one is left. Blocks of groups are differenced side by side; a block's partial
partition then goes into the next level like a group's, until one task can
take the rest. Large groups skip the first levels, so that they are still
placed when everything else can even them out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import running_total, stored

SHARDS = 40
#: Groups a task combines, and partial partitions a task combines.
GROUPS, PARTIALS = 10_000, 2_000
OVERHEAD = 16


def difference(partials: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (one per row). Returns the totals, and per row the shard of each of its parts."""
    n, k = partials.shape
    order = np.argsort(-partials, axis=1, kind="stable")
    # A node of the combination tree: totals in descending order, and the two nodes it came from.
    totals = [row for row in np.take_along_axis(partials, order, axis=1)]
    heap = [(int(t[-1] - t[0]), i) for i, t in enumerate(totals)]
    heapq.heapify(heap)
    came: list[tuple[int, int, np.ndarray] | None] = [None] * n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = totals[a] + totals[b][::-1]
        sort = np.argsort(-both, kind="stable")
        came.append((a, b, sort))
        totals.append(both[sort])
        heapq.heappush(heap, (int(totals[-1][-1] - totals[-1][0]), len(totals) - 1))
    root = heap[0][1]
    place: list[np.ndarray | None] = [None] * len(totals)
    place[root] = np.arange(k)
    for node in range(len(totals) - 1, n - 1, -1):
        a, b, sort = came[node]
        into = np.empty(k, np.int64)
        into[sort] = place[node]
        place[a], place[b] = into, into[::-1]
    shards = np.empty((n, k), np.int64)
    for i in range(n):
        shards[i, order[i]] = place[i]
    return totals[root], shards


def _combine(level: DataFrame, block: str, shards: int) -> DataFrame:
    """A row per input row: its place (shard per part) in its block, and on one of them the block's totals."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        parts = np.zeros((len(frame), shards), np.int64)
        for i, t in enumerate(frame["totals"]):
            parts[i, : len(t)] = t
        total, placed = difference(parts)
        first = np.zeros(shards, np.int64)
        first[:] = np.sort(total)[::-1]
        # Totals are given by shard, so that a place points into them.
        rest = [None] * (len(frame) - 1)
        return pd.DataFrame({"id": frame["id"].to_numpy(), "block": frame["block"].to_numpy(), "places": list(placed), "block_totals": [first, *rest]})

    named = level.withColumnRenamed(block, "block") if block != "block" else level
    return named.groupBy("block").applyInPandas(run, "id long, block long, places array<long>, block_totals array<long>")


def place_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(id, bytes) -> (id, shard). Totals are near equal; a group larger than its share fills a shard alone.

    A group above half a shard's mean is taken to the last level as it is:
    there are at most ``2 * shards`` of these.
    """
    stats = groups.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    large = F.col("bytes") * (2 * shards) > F.lit(stats.bytes)
    start = groups.withColumn("totals", F.array("bytes"))
    level, sizes, keep = start.where(~large).select("id", "totals"), GROUPS, start.where(large).select("id", "totals")
    count, placed = stats.n, []
    while count > sizes:
        blocks = -(-count // sizes)
        level = level.withColumn("block", F.pmod(F.xxhash64("id", F.lit(len(placed))), F.lit(blocks)))
        done = stored(_combine(level, "block", shards), "blocks")
        placed.append(done.select("id", "block", "places"))
        level = done.where("block_totals IS NOT NULL").select(F.col("block").alias("id"), F.col("block_totals").alias("totals"))
        count, sizes = blocks, PARTIALS
    top = level.withColumn("big", F.lit(False)).unionByName(keep.withColumn("big", F.lit(True)))
    numbered = top.withColumn("group", F.col("id")).withColumn("id", F.xxhash64("id", "big")).withColumn("block", F.lit(0).cast("long"))
    last = stored(numbered, "blocks")
    done = _combine(last.select("id", "totals", "block"), "block", shards).select("id", "places").join(last.select("id", "group", "big"), "id")
    done = stored(done, "blocks")
    big = done.where("big").select(F.col("group").alias("id"), F.col("places")[0].alias("shard"))
    above = done.where("NOT big").select(F.col("group").alias("id"), "places")
    for below in reversed(placed):
        up = above.select(F.col("id").alias("block"), F.col("places").alias("up"))
        above = below.join(up, "block").select("id", F.transform("places", lambda p: F.col("up")[p.cast("int")]).alias("places"))
    return above.select("id", F.col("places")[0].alias("shard")).unionByName(big)


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Equal texts form a group, told by their SHA-256, and share a shard; a null
    text is empty. Shards are balanced by bytes (law ``bytes``), so one more
    shard means a new partition and grown_shard is null. Slots number a shard's
    rows from 0 without gaps, in an order of their own. Repeated rows get slots
    of their own. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    rows = stored(rows, "rows")
    # A group's number is part of its digest; should two digests share it, their groups share a shard.
    rows = rows.withColumn("id", F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")).drop("digest")
    groups = stored(rows.groupBy("id").agg(F.sum("size").alias("bytes")), "groups")
    placed = place_groups(groups, shards)
    spread = max(1, -(-rows.count() // (shards * 50_000)))
    found = rows.join(placed, "id").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(spread))).withColumn("one", F.lit(1))
    found = stored(found.select("doc_id", "size", "text_crc32", "shard", "bucket", "one"), "placed")
    slots = running_total(found, ["shard"], "bucket", ["doc_id", "text_crc32"], "one", "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
