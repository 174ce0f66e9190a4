"""Jaccard join of word n-grams by prefixes of token combinations.

A text's tokens are its distinct word shingles, in one order for all texts: by
how often their slot of a fixed table was counted over all documents, then by
hash. Any order gives the same links; this one puts rare tokens first. Tokens
fall into classes by that count. Those of the first class are indexed one by
one; frequent ones are dealt to groups by hash and indexed by all combinations
of two (second class) or three (third) tokens of a group, so that a passage of
many documents makes no key unless much of it stands in a prefix.

A set of n tokens lacks at most ``t = n - ceil(n * percent / 100)`` of its
tokens in a set that it is linked with. Its prefix is extended until a token
taken away from it t times in any way leaves a combination: a group of c tokens
of which k make a combination counts ``c - (k - 1)``, and these counts sum to
t + 1. Of two linked sets, take the one whose prefix ends first: what both
share of it lies in the other's prefix too, so they share a combination. The
numbers of groups depend on the set's size, by powers of two; a set near a
power is indexed for both.

A key of few sets gives all its pairs, and each pair is first held against
bitmaps: bit ``token mod size`` of a set's bitmap is the parity of its tokens
there. A bit that differs in two bitmaps needs a token that only one of the sets
has, so more differing bits than a linked pair may have different tokens rule a
link out, and no link is lost. The pairs that remain are verified on the full
sets. A key of more sets is verified there too: every set against one pivot of
the key, then by the triangle inequality, as links are confirmed for MinHash
keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import NO_ID, WordHashes, slices, stored
from .components import components
from .near_dedup import _links_within, _mixed, _possible, _similar, shingles

WIDTH, PERCENT = 4, 85
#: Slots of the table of counts, and rows it is cut into while it is summed. 16 MB in all, whatever the input.
SLOT_BITS, CHUNKS = 22, 64
SLOTS = 1 << SLOT_BITS
#: Most tokens a combination has.
MOST = 3
#: Keys of up to so many sets give all their pairs, 3.5 a set at most; sets of larger keys are compared with pivots.
FEW = 8
#: Rounds of comparison with a pivot before keys are joined.
ROUNDS = 2
#: Texts in the verification whose ids and digests are broadcast to the scan; more are joined by shuffle.
BROADCAST_IDS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _digest(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def _summed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each chunk, summed; all chunks together are one table of `SLOTS`."""
    total: dict[int, np.ndarray] = {}
    for batch in frames:
        for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            counts = np.frombuffer(zlib.decompress(packed), np.int64)
            total[chunk] = total[chunk] + counts if chunk in total else counts
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())], ["chunk", "counts"]
    )


def _read(width: int):
    """Per text its id, number of tokens and digest; at a task's end, what it counted per slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(SLOTS, np.int64)
        names = ["id", "n_shingles", "digest", "chunk", "counts"]
        for batch in slices(batches, "text"):
            sets = [shingles(t, hashes, width) for t in batch.column("text").to_pylist()]
            counts += np.bincount(_slot(np.concatenate(sets)), minlength=SLOTS)
            nothing = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()), *nothing], names)
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(counts, CHUNKS)] if counts.any() else []
        nothing = pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.binary())
        yield pa.RecordBatch.from_arrays([*nothing, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names)

    return run


def slot_counts(rows: DataFrame) -> np.ndarray:
    """The table of counts from the rows (chunk, counts) of all tasks, summed per reader first, then per chunk."""
    schema = "chunk int, counts binary"
    summed = rows.mapInArrow(_summed, schema).repartition(CHUNKS, "chunk").mapInArrow(_summed, schema)
    out = np.zeros((CHUNKS, SLOTS // CHUNKS), np.int64)
    for row in summed.collect():
        out[row.chunk] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    return np.minimum(out.ravel(), 2**32 - 1).astype(np.uint32)


@dataclass(frozen=True)
class Classes:
    """How tokens are classed and sets are indexed."""

    percent: int
    rare: int
    frequent: int

    @staticmethod
    def of(counts: np.ndarray, n_sets: int, percent: int) -> Classes:
        """Rare is what a slot of chance tokens may hold; frequent in the third class is what over 1/64 of all sets have."""
        mean = float(counts.mean())
        rare = int(2 * mean + 16 * mean**0.5 + 16)
        return Classes(percent, rare, max(4 * rare, n_sets // 64))

    def lacking(self, n: int) -> int:
        """How many of n tokens a linked set may lack."""
        return n - -(-n * self.percent // 100)

    def schemes(self, n: int) -> list[int]:
        """Powers of two whose sets a set of n tokens may be linked with; the smaller set of a pair decides."""
        own, low = n.bit_length() - 1, max(1, -(-n * self.percent // 100)).bit_length() - 1
        return list(range(low, own + 1))

    def groups(self, scheme: int) -> list[int]:
        """Groups per class, 0 for single tokens; fewer classes where small sets could not do without a token."""
        base = self.lacking(1 << scheme) + 1
        for most in range(MOST, 0, -1):
            groups = [0, *[max(1, base // k) for k in range(2, most + 1)]]
            lost = sum(g * k for k, g in enumerate(groups))
            # The sets indexed here have up to twice the size, and those linked with them.
            if all(n - lost > self.lacking(n) for n in range(1 << scheme, (1 << scheme + 1) * 100 // self.percent + 2)) if scheme < 12 else (1 << scheme) - lost > self.lacking((1 << scheme + 1) * 100 // self.percent + 1):
                return groups
        return [0]

    def keys(self, tokens: np.ndarray, counts: np.ndarray, scheme: int, groups: list[int]) -> np.ndarray:
        """The keys of a set for a scheme. `tokens` are in the common order, `counts` those of their slots."""
        kind = np.minimum(1 + (counts > self.rare) + (counts > self.frequent), len(groups))
        wanted = self.lacking(len(tokens)) + 1
        if kind[min(wanted, len(kind)) - 1] == 1:
            return _mixed_hash(tokens[:wanted], scheme)
        numbers = np.array(groups, np.uint64)[kind - 1]
        group = np.where(kind > 1, (tokens * _MIX >> np.uint64(20)) % np.maximum(numbers, 1), np.arange(len(tokens), dtype=np.uint64))
        order = np.lexsort((np.arange(len(tokens)), group, kind))
        first = np.r_[True, (kind[order][1:] != kind[order][:-1]) | (group[order][1:] != group[order][:-1])]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        counted = np.zeros(len(tokens), np.int64)
        counted[order] = rank >= kind[order] - 1
        end = np.searchsorted(np.cumsum(counted), wanted) + 1
        order = order[order < end]
        kind, group, tokens = kind[order], group[order], tokens[order]
        out = [_mixed_hash(tokens[kind == 1], scheme)]
        for size in range(2, len(groups) + 1):
            here = np.flatnonzero(kind == size)
            if len(here):
                out.append(_combinations(tokens[here], group[here], size, scheme))
        return np.concatenate(out)


def _mixed_hash(tokens: np.ndarray, seed) -> np.ndarray:
    value = (tokens ^ np.uint64((seed + 1) * int(_MIX) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ value >> np.uint64(31)


def _combinations(tokens: np.ndarray, group: np.ndarray, size: int, scheme: int) -> np.ndarray:
    """A key for every `size` tokens of a group; the tokens of a group stand together."""
    ends = np.searchsorted(group, group, "right") if (group[1:] >= group[:-1]).all() else None
    last, value = np.arange(len(tokens)), _mixed_hash(tokens, 100 * size + scheme)
    for _ in range(size - 1):
        more = ends[last] - last - 1
        start = np.repeat(last + 1 - (np.cumsum(more) - more), more)
        value, last = np.repeat(value, more), start + np.arange(more.sum())
        value = _mixed_hash(value ^ tokens[last] * _MIX, size)
    return value


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The parities of a set's tokens modulo the bitmap's size, in words of 64 bits; the size is the power of two from the number of tokens on."""
    size = max(64, 1 << (len(tokens) - 1).bit_length())
    held = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(held.astype(np.uint8), bitorder="little").view(np.int64)


def _near(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that a link is possible for by the bitmaps `maps` (id, n, bits). An id may have several."""
    x, y = (maps.select(F.col("id").alias(i), F.col("n").alias(f"n_{i}"), F.col("bits").alias(f"bits_{i}")) for i in "ab")
    met = pairs.join(x, "a").where("n_a > 0").join(y, "b").where(f"n_b > 0 AND {percent} * greatest(n_a, n_b) <= 100 * least(n_a, n_b)")

    def folded(one: str, other: str) -> F.Column:
        # Sizes of linked sets differ by a factor of two at most, so their bitmaps do.
        half = F.expr(f"size({one}) div 2")
        halves = F.zip_with(F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(one) > F.size(other), halves).otherwise(F.col(one))

    bits = F.zip_with(folded("bits_a", "bits_b"), folded("bits_b", "bits_a"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    # A linked pair shares `percent` of `100 + percent` parts of both sizes at least.
    most = F.expr(f"n_a + n_b - 2 * (({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent})")
    return met.where(differ <= most).select("a", "b").distinct()


def _indexed(table: np.ndarray, classes: Classes, width: int):
    """Per text its keys for all schemes, its number of tokens and its bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, groups = WordHashes(), {}
        for batch in slices(batches, "text"):
            found, sizes, maps = [], [], []
            for text in batch.column("text").to_pylist():
                tokens, keys = shingles(text, hashes, width), []
                sizes.append(len(tokens))
                maps.append(bitmap(tokens) if len(tokens) else None)
                if len(tokens):
                    counts = table[_slot(tokens)]
                    order = np.lexsort((tokens, counts))
                    tokens, counts = tokens[order], counts[order].astype(np.int64)
                    for scheme in classes.schemes(len(tokens)):
                        if scheme not in groups:
                            groups[scheme] = classes.groups(scheme)
                        keys.append(classes.keys(tokens, counts, scheme, groups[scheme]))
                found.append(np.unique(np.concatenate(keys)).view(np.int64) if keys else None)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, lists), pa.array(sizes, pa.int64()), pa.array(maps, lists)], ["id", "keys", "n", "bits"])

    return run


def _sets(width: int):
    """Token sets, for the rows that have the wanted set (an id may stand on several texts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", 1 << 20):
            found = [shingles(t, hashes, width) for t in batch.column("text").to_pylist()]
            same = [_digest(s) == d for s, d in zip(found, batch.column("digest").to_pylist())]
            items = [s.view(np.int64) for s, ok in zip(found, same) if ok]
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(same)), pa.array(items, pa.list_(pa.int64()))], ["id", "items"])

    return run


def _star(bucket: DataFrame) -> DataFrame:
    """(key, c, a, b): a key's number of ids, its pivot and every other id. The pivot is the set whose keys most others share."""
    crowd = bucket.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    held = bucket.select("key", "id").join(crowd, "key")
    fame = held.groupBy("id").agg(F.sum("c").alias("fame"))
    pivots = held.join(fame, "id").groupBy("key").agg(F.max_by("id", F.struct("fame", F.bitwise_not("id"))).alias("a"))
    return held.join(pivots, "key").where("id != a").select("key", "c", "a", F.col("id").alias("b"))


def _verified(against: DataFrame, pairs: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(id, label): components of the links of `found`, of `pairs` (a, b) and of all links within the keys of the pivots `against` (a, b).

    An id leaves as soon as no other id of a key can be linked with it.
    """
    slack = 1 - percent / 100 + 1e-9
    linked = 100 * F.col("both") >= percent * F.col("either")
    labels = None
    for left in reversed(range(ROUNDS)):
        judged = stored(_similar(against.unionByName(pairs).distinct(), sets), "judged")
        found = found.unionByName(judged.where(linked).select("a", "b"))
        labels = stored(components(found), "labels")
        found = labels.select(F.col("label").alias("a"), F.col("id").alias("b"))
        # Sets that may be linked are at distances from their pivot that differ by `slack` at most, and share one of two bands.
        # Keys with one pivot become one.
        placed = judged.join(against, ["a", "b"]).select("a", F.col("b").alias("id"), (1 - F.col("both") / F.col("either")).alias("far")).distinct()
        bands = F.array(*[F.xxhash64("a", F.lit(k), F.floor(F.col("far") / (2 * slack) + k / 2)) for k in (0, 1)])
        placed = placed.withColumn("key", F.explode(bands))
        bucket = stored(_possible(_mixed(placed, labels), sets, percent), "keys")
        if bucket.isEmpty():
            return labels
        if left:
            against, pairs = stored(_star(bucket).select("a", "b").distinct(), "against"), pairs.limit(0)
    near = stored(_links_within(bucket, sets, percent, slack), "links")
    return labels if near.isEmpty() else components(found.unionByName(near))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id.

    Two documents are linked when 100 * intersection >= `percent` * union of
    their distinct shingles of `width` words; `component_id` is the smallest id
    that links reach. Null and empty texts, and those without words: no
    shingles, linked with nothing. Fewer words than `width` make one shingle.
    Texts with equal sets are one node. Repeated rows: each is returned, with
    the same result. Rows that share an id are one document. A null id is a
    document of its own that orders first, and its component is null. An empty
    table gives no rows. Other columns are ignored.
    """
    if not 50 <= percent <= 100:
        raise ValueError(f"percent is 50 to 100, not {percent}")
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    seen = stored(rows.mapInArrow(_read(width), "id long, n_shingles long, digest binary, chunk int, counts binary"), "seen")
    read = seen.where("chunk IS NULL").select("id", "n_shingles", "digest")
    full = read.where("digest IS NOT NULL")
    nodes = stored(full.groupBy("digest").agg(F.min("id").alias("top"), F.min("n_shingles").alias("n")), "classes")
    links = full.join(nodes, "digest").where("id != top").select(F.col("top").alias("a"), F.col("id").alias("b"))

    table = slot_counts(seen.where("chunk IS NOT NULL").select("chunk", "counts"))
    classes = Classes.of(table, nodes.count(), percent)
    keys = stored(rows.mapInArrow(_indexed(table, classes, width), "id long, keys array<long>, n long, bits array<long>").where("keys IS NOT NULL"), "prefixes")
    held = keys.select("id", F.explode("keys").alias("key"))
    # Counted before the shuffle; written, so that the join below may split a key that very many sets have.
    crowded = stored(held.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "crowded")
    tops = nodes.select(F.col("top").alias("id")).distinct()
    shared = stored(held.join(crowded, "key").distinct().join(tops, "id"), "shared")
    # A key of few sets gives all its pairs: those with its pivot, and those of the others.
    star = stored(_star(shared), "star")
    few = star.where(f"c <= {FEW}")
    more = few.alias("x").join(few.alias("y"), F.expr("x.key = y.key AND x.b < y.b")).select(F.col("x.b").alias("a"), F.col("y.b").alias("b"))
    met = few.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(more).distinct()
    pairs = stored(_near(met, keys.select("id", "n", "bits"), percent), "pairs")
    against = stored(star.where(f"c > {FEW}").select("a", "b").distinct(), "against")
    wanted = against.unionByName(pairs).select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(wanted.join(nodes.select(F.col("top").alias("id"), "digest"), "id"), "wanted")
    small = wanted.count() <= BROADCAST_IDS
    sets = stored(rows.join(F.broadcast(wanted) if small else wanted, "id").distinct().mapInArrow(_sets(width), "id long, items array<long>"), "sets")

    labels = _verified(against, pairs, sets, links, percent)
    whole = read.select("id", "n_shingles").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    plain = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return whole.select(plain("id").alias("doc_id"), "n_shingles", plain("label").alias("component_id"))
