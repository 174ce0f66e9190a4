"""The prefix trie of conversations, by sorted shards and a skeleton of splitter paths.

A conversation is the path of its turns' digests. Paths are cut by range into
shards at splitters, which are paths of a sample. The members of a trie node
are neighbours in the order of paths, so a node whose members stand in several
shards is a beginning of a splitter. The trie of all such beginnings, the
skeleton, is broadcast: at most splitters times turns of the longest
conversation. A shard reads its paths in order and finishes all its other
nodes with the open nodes of one path in memory; of skeleton nodes it gives
what it has seen, and these parts are reduced by node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD, stored

#: Conversations looked at per shard to place the splitters; any splitters give the same nodes.
SAMPLE = 16
#: Characters of conversation ids handed on together, and rows of a batch.
CHUNK, BATCH = 1 << 15, 4096

SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "parent int, skeleton int, words long, shard int, place long, ids string"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_ARROW = pa.schema([(part.split()[0], _TYPES[part.split()[1]]) for part in SCHEMA.split(", ")])
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (turn, role, digest, words).

    A null turn comes first; equal turns are ordered by role, then by digest.
    Null role and text are empty. Rows without conv_id belong to no
    conversation; repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), words.alias("words")).alias("t")
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words): every conversation c with the first h turns of conversation c - c % 20 in place of its own.

    h is the CRC-32 of the decimal id, modulo 4. `path` is the turns' digests
    one after the other, 16 bytes each.
    """
    whole = stored(paths_of(conversations), "conversations")
    base = whole.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    own = whole.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), "turns")
    nothing = F.slice("turns", 1, 0)
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))).otherwise(nothing)
    turns = F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    joined = own.join(base, "base", "left").select("conv_id", turns.alias("turns"))
    return joined.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.words").alias("words"))


class _Open:
    """A trie node whose members are being read."""

    __slots__ = ("skeleton", "words", "convs", "least", "children", "leaves", "saved", "ends", "ids", "size", "place", "waiting")

    def __init__(self, skeleton: int, words: int):
        self.skeleton, self.words, self.convs, self.least, self.children, self.leaves, self.saved = skeleton, words, 0, None, 0, 0, 0
        self.ends, self.ids, self.size, self.place, self.waiting = None, [], 0, 0, []


def skeleton_of(splitters: list[tuple[bytes, int]]) -> dict[tuple[int, bytes], int]:
    """The trie of all beginnings of the splitters: (parent, digest) to node; the root is 0."""
    nodes: dict[tuple[int, bytes], int] = {}
    for path, _ in splitters:
        at = 0
        for k in range(0, len(path), 16):
            at = nodes.setdefault((at, path[k : k + 16]), len(nodes) + 1)
    return nodes


def _shard_nodes(shard: int, rows: Iterator[tuple[bytes, int, list[int]]], skeleton: dict) -> Iterator[tuple]:
    """The nodes that end in a shard, the parts of skeleton nodes, and the ids that end at them; `rows` in order of path and id."""
    stack, before = [_Open(0, 0)], b""

    def close(node: _Open, depth: int, parent: _Open | None) -> Iterator[tuple]:
        if node.skeleton >= 0:
            if node.ids:
                yield (*[None] * 9, node.skeleton, None, shard, node.place, ",".join(node.ids))
            yield (node.least, depth, None, node.convs, node.children, node.leaves, node.saved, None, None, node.skeleton, node.words, None, None, None)
            return
        node.leaves = node.leaves or 1
        node.saved += (node.convs - 1) * node.words
        for row in node.waiting:
            yield (*row[:2], node.least, *row[3:])
        digest = (node.ends or hashlib.sha256()).hexdigest()
        row = (node.least, depth, None, node.convs, node.children, node.leaves, node.saved, digest, parent.skeleton if parent.skeleton >= 0 else None, *[None] * 5)
        parent.convs += node.convs
        parent.least = node.least if parent.least is None else min(parent.least, node.least)
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        if parent.skeleton >= 0:
            yield row
        else:
            parent.waiting.append(row)

    for path, conv, words in rows:
        shared, most = 0, min(len(path), len(before), 16 * (len(stack) - 1))
        while shared < most and path[shared : shared + 16] == before[shared : shared + 16]:
            shared += 16
        while len(stack) > shared // 16 + 1:
            node = stack.pop()
            yield from close(node, len(stack), stack[-1])
        for k in range(shared, len(path), 16):
            above = stack[-1].skeleton
            stack.append(_Open(skeleton.get((above, path[k : k + 16]), -1) if above >= 0 else -1, words[k // 16]))
        node, before = stack[-1], path
        node.convs += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton >= 0:
            node.ids.append(str(conv))
            node.size += len(node.ids[-1])
            if node.size > CHUNK:
                yield (*[None] * 9, node.skeleton, None, shard, node.place, ",".join(node.ids))
                node.ids, node.size, node.place = [], 0, node.place + 1
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(b",%d" % conv)
    while stack:
        node = stack.pop()
        yield from close(node, len(stack), stack[-1] if stack else None)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], _NAMES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], _NAMES)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each skeleton node's ids; the pieces of a node follow one another and are not held."""
    at, running = None, None
    for batch in batches:
        for node, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    yield pa.RecordBatch.from_pydict({"skeleton": pa.array([at], pa.int32()), "ends_sha256": [running.hexdigest()]})
                at, running = node, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if at is not None:
        yield pa.RecordBatch.from_pydict({"skeleton": pa.array([at], pa.int32()), "ends_sha256": [running.hexdigest()]})


def _reduced(parts: list, skeleton: dict[tuple[int, bytes], int]) -> list[tuple]:
    """Skeleton nodes as rows, children added to their parents from the deepest up."""
    total = {r["skeleton"]: r.asDict() for r in parts}
    above = {node: parent for (parent, _), node in skeleton.items()}
    for node in sorted(total, key=lambda n: -total[n]["depth"]):
        mine = total[node]
        mine["leaves"] = mine["leaves"] or 1
        mine["saved"] += (mine["convs"] - 1) * mine["words"]
        if node:
            parent = total[above[node]]
            parent["convs"] += mine["convs"]
            parent["least"] = mine["least"] if parent["least"] is None else min(parent["least"], mine["least"])
            parent["children"] += 1
            parent["leaves"] += mine["leaves"]
            parent["saved"] += mine["saved"]
    return [
        (n, t["least"], t["depth"], total[above[n]]["least"] if n else None, t["convs"], t["children"], t["leaves"], t["saved"])
        for n, t in total.items()
    ]


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, path, words), the textless root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 (of the ids that end at the node,
    ascending, comma-joined). An empty path ends at the root. Equal paths are
    one node; an empty table has no node. A conversation is one row, and a
    shard holds its open path and the finished children of its nodes; equal
    paths are cut between shards by id, so that no group of copies is one task.
    """
    spark = paths.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = stored(paths.select(F.col("conv_id").cast("long").alias("conv_id"), "path", F.col("words").cast("array<long>").alias("words")).where("conv_id IS NOT NULL"), "paths")
    sample = paths.orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLE * shards).select("path", "conv_id").collect()
    ordered = sorted((bytes(r["path"]), r["conv_id"]) for r in sample)
    weight, run = [], 0
    for path, _ in ordered:
        run += len(path) + 16
        weight.append(run)
    splitters = sorted({ordered[bisect_right(weight, run * k // shards)] for k in range(1, shards)}) if ordered else []
    skeleton = skeleton_of(splitters)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(splitters, key) for key in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words")))

        def nodes() -> Iterator[tuple]:
            source = rows()
            row = next(source, None)
            while row is not None:
                shard, following = row[0], [row]

                def same() -> Iterator[tuple]:
                    while following[0] is not None and following[0][0] == shard:
                        yield following[0][1:]
                        following[0] = next(source, None)

                yield from _shard_nodes(shard, same(), skeleton)
                row = following[0]

        yield from _batches(nodes())

    placed = paths.mapInArrow(place, "shard int, conv_id long, path binary, words array<long>")
    dealt = placed.repartitionById(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = stored(dealt.mapInArrow(finish, SCHEMA), "nodes")

    parts = found.where("skeleton IS NOT NULL AND ids IS NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), F.max("depth").alias("depth"), F.sum("n_convs").alias("convs"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"),
    )
    # A row per node of the skeleton, which the driver holds already.
    top = spark.createDataFrame(
        _reduced(parts.collect(), skeleton),
        "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long",
    )
    pieces = found.where("ids IS NOT NULL").select("skeleton", "shard", "place", "ids")
    ends = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "place").mapInArrow(_ends, "skeleton int, ends_sha256 string")
    empty = F.lit(hashlib.sha256().hexdigest())
    upper = top.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty)).select(*NODE)
    names = F.broadcast(top.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("_above")))
    lower = found.where("skeleton IS NULL").join(names, "parent", "left").withColumn("parent_conv_id", F.coalesce("_above", "parent_conv_id"))
    return lower.select(*NODE).unionByName(upper)
