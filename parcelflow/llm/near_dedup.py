"""MinHash near-duplicate detection by a multi-index Hamming join.

A document's signature holds `HASHES` minima of `BITS` bits each, and the
distance of two signatures is the number of minima that differ. Signatures are
cut into chunks of `CHUNK` minima. Two signatures that differ in at most
``chunks * (ERRORS + 1) - 1`` minima have, by pigeonhole, a chunk with at most
`ERRORS` differences, so with one key for every way to leave `ERRORS` minima
out of a chunk they share a key. All such pairs are found; a pair beyond the
distance may be found too and is judged like any other.

With 8 chunks of 4 minima and one error, the distance is 15 of 32. A pair of
documents at the similarity threshold 0.85 differs in 4.8 minima on average and
misses every key with probability 2e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import NO_ID, WordHashes, slices, stored
from .components import components

HASHES, BITS, CHUNK, ERRORS = 32, 16, 4, 1
CHUNKS = HASHES // CHUNK
RADIUS = CHUNKS * (ERRORS + 1) - 1
PERCENT = 85
WIDTH = 3
#: Rounds of comparison with a pivot before keys are joined.
ROUNDS = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_DRAW = np.random.default_rng(20).integers(0, 2**63, (2, HASHES), dtype=np.uint64)
_ODD = (_DRAW[0] << np.uint64(1)) | np.uint64(1)
_XOR = _DRAW[1]


def shingles(text: bytes | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words than `width` make one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    ids = hashes.of(words)
    n = max(1, len(words) - width + 1)
    value = np.full(n, np.uint64(min(width, len(words))))
    for k in range(min(width, len(words))):
        value = (value ^ ids[k : k + n]) * _MIX
        value ^= value >> np.uint64(29)
    value.sort()
    return value[np.r_[True, value[1:] != value[:-1]]]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per non-empty set."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.int32)
    for k in range(HASHES):
        least = np.minimum.reduceat((flat ^ _XOR[k]) * _ODD[k], starts)
        out[:, k] = ((least * _MIX) >> np.uint64(64 - BITS)).astype(np.int32)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, "text"):
        sets = [shingles(t, hashes) for t in batch.column("text").to_pylist()]
        full = [s for s in sets if len(s)]
        rows = iter(signatures(full)) if full else iter(())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32())),
            ],
            ["id", "n_shingles", "digest", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets, for the rows that have the wanted set (an id may stand on several texts)."""
    hashes = WordHashes()
    for batch in slices(batches, "text", 1 << 20):
        found = [shingles(t, hashes) for t in batch.column("text").to_pylist()]
        same = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(found, batch.column("digest").to_pylist())]
        items = [s.view(np.int64) for s, ok in zip(found, same) if ok]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").filter(pa.array(same)), pa.array(items, pa.list_(pa.int64()))], ["id", "items"]
        )


def chunk_keys(signature: str = "signature") -> F.Column:
    """All keys of a signature: a chunk's number, the minima left out, and the minima that remain."""
    keys = []
    for c in range(CHUNKS):
        for m, kept in enumerate(combinations(range(CHUNK), CHUNK - ERRORS)):
            keys.append(F.xxhash64(F.lit(c * 1000 + m), *[F.col(signature)[c * CHUNK + k] for k in kept]))
    return F.array(*keys)


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the exact sizes of their intersection and union."""
    y = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    x = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(y, "b").join(x, "a")
        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sizes"))
        .select("a", "b", "both", (F.col("sizes") - F.col("both")).alias("either"))
    )


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of (key, id, far) with the component of each id; keys whose ids are all in one are left out."""
    named = rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = named.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l != _h")
    return named.join(mixed.select("key"), "key")


def _possible(bucket: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows whose id can still have a link, with `n` shingles and `own`, those that no other id here has.

    With `own` shingles of its own, a set shares at most ``n - own`` with any
    other, and their union holds all n.
    """
    here = bucket.select("id").distinct().join(sets, "id").select("id", F.explode("items").alias("item"))
    lone = here.groupBy("item").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    own = lone.groupBy("id").agg(F.count("*").alias("own"))
    sized = bucket.join(sets.select("id", F.size("items").alias("n")), "id").join(own, "id", "left")
    return sized.withColumn("own", F.coalesce("own", F.lit(0))).where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))


def _links_within(bucket: DataFrame, sets: DataFrame, percent: int, slack: float) -> DataFrame:
    """The links (a, b) between different components of a key.

    A set is told by what it lacks of its pivot's set and what it has beyond
    it. From these short arrays the exact intersection of two sets follows, so
    that the join gives links only, not candidates.
    """
    whole = sets.select("id", F.col("items").alias("x"))
    pivot = sets.select(F.col("id").alias("a"), F.col("items").alias("c"))
    told = bucket.join(whole, "id").join(pivot, "a").select(
        "key", "id", "label", "far", "n", "own", F.size("c").alias("m"),
        F.array_except("c", "x").alias("lost"), F.array_except("x", "c").alias("more"),
    )
    x, y = told.alias("x"), told.alias("y")
    size = F.col("x.n") + F.col("y.n")
    most = F.least(F.expr("x.n - x.own"), F.expr("y.n - y.own"))
    both = F.expr(
        "x.m - size(x.lost) - size(y.lost) + size(array_intersect(x.lost, y.lost)) + size(array_intersect(x.more, y.more))"
    )
    linked = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.label") < F.col("y.label"))
        & (F.abs(F.col("x.far") - F.col("y.far")) <= slack)
        & (100 * most >= percent * (size - most))
        & (100 * both >= percent * (size - both))
    )
    return x.join(y, linked).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Texts with equal shingle sets count as one from the start. Within a key,
    every text is compared with one of them, its pivot, on the full sets; that is one comparison per row, never all pairs. Texts of a key that
    are then in different components are compared further only where the
    distances to the pivot allow a link: Jaccard distance is a metric, so two
    texts within 0.15 of each other are at distances from the pivot that differ
    by at most 0.15. A text with too many shingles that no other text here has
    can have no link and leaves. After `ROUNDS` such rounds what is left is
    joined within the key. No link between different texts is lost to a cap.

    Null and empty texts, and those without words: no shingles, linked with
    nothing. Repeated rows: each is returned, with the same result. Rows that
    share an id are one document. A null id is a document of its own that
    orders first, and its component is null. Other columns are ignored.
    """
    slack = 1 - percent / 100 + 1e-9
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    signed = stored(rows.mapInArrow(_signed, "id long, n_shingles long, digest binary, signature array<int>"), "signatures")
    full = signed.where("digest IS NOT NULL")
    classes = full.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature"))
    nodes = stored(classes, "classes")
    member = full.join(nodes.select("digest", F.col("id").alias("top")), "digest").where("id != top")
    links = member.select(F.col("top").alias("a"), F.col("id").alias("b"))

    keys = nodes.select("id", F.explode(chunk_keys()).alias("key"))
    crowded = keys.groupBy("key").agg(F.min("id").alias("_l"), F.max("id").alias("_h")).where("_l != _h")
    # The planner sizes keys by the classes' file, as if each had one key, and would broadcast all of them.
    bucket = stored(keys.join(crowded.select("key").hint("merge"), "key").distinct().withColumn("label", F.col("id")), "keys")
    wanted = bucket.select("id").distinct().join(nodes.select("id", "digest"), "id")
    sets = stored(rows.join(wanted, "id").distinct().mapInArrow(_sets, "id long, items array<long>"), "sets")
    found = links
    for _ in range(ROUNDS):
        # The pivot is the text whose keys most others share: an original rather than one of its variants.
        crowd = bucket.groupBy("key").agg(F.count("*").alias("crowd"))
        # A file of keys and ids that repeat is a small part of its rows' size.
        fame = bucket.join(crowd.hint("merge"), "key").groupBy("id").agg(F.sum("crowd").alias("fame"))
        pivots = bucket.join(fame.hint("merge"), "id").groupBy("key").agg(F.max_by("id", F.struct("fame", F.bitwise_not("id"))).alias("a"))
        against = bucket.select("key", "id").join(pivots.hint("merge"), "key").where("id != a").select("a", F.col("id").alias("b"))
        judged = stored(_similar(against.distinct(), sets), "judged")
        found = found.unionByName(judged.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b"))
        labels = stored(components(found), "labels")
        found = labels.select(F.col("label").alias("a"), F.col("id").alias("b"))
        # Bands of twice the width at two offsets: ids that may be linked share one. Keys with one pivot become one.
        placed = judged.select("a", F.col("b").alias("id"), (1 - F.col("both") / F.col("either")).alias("far")).distinct()
        bands = F.array(*[F.xxhash64("a", F.lit(k), F.floor(F.col("far") / (2 * slack) + k / 2)) for k in (0, 1)])
        placed = placed.withColumn("key", F.explode(bands))
        bucket = stored(_possible(_mixed(placed, labels), sets, percent), "keys")
        if bucket.isEmpty():
            break
    else:
        near = stored(_links_within(bucket, sets, percent, slack), "links")
        if not near.isEmpty():
            labels = components(found.unionByName(near))
    found = labels
    whole = signed.select("id", "n_shingles").join(found, "id", "left").withColumn("label", F.coalesce("label", "id"))
    plain = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return whole.select(
        plain("id").alias("doc_id"), "n_shingles", plain("label").alias("component_id"), (F.col("id") == F.col("label")).alias("kept")
    )
