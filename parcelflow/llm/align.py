"""Tokens of two tokenizers over the same bytes, aligned by divide and conquer at shared cuts.

An offset at which a token of either side ends is a shared cut. A text is an
interval of tokens; near its middle token of the first side a common end is
looked for by bisection among the ends of the second, in windows that double,
and both halves are treated alike. An interval without a common end inside is
a leaf, a group of tokens that belong together. All intervals of a slice of
texts take a step at the same time, so the work is proportional to the tokens
however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored
from .encode import Encoder, PieceEncoder, PieceModel, text_slices, tokenizer_file

#: An id pair as one number: the second id takes so many bits.
BITS = 20
#: Id pairs whose counts are broadcast; more are joined by shuffle.
BROADCAST_PAIRS = 1_000_000
#: Pieces each of the two tokenizers remembers per worker, and bytes of text aligned together.
REMEMBER, SLICE = 500_000, 2 << 20
#: Groups with more links than this are counted by distinct ids.
LARGE = 1024

SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Leaf groups (a0, a1, b0, b1) of texts that start at the given tokens, in order.

    `ends_a` and `ends_b` are the ascending end offsets of all tokens of all
    texts; at the last token of each text they agree.
    """
    kind = np.int32 if not len(ends_a) or ends_a[-1] < 2**31 else np.int64
    ends_a, ends_b = ends_a.astype(kind), ends_b.astype(kind)
    state = np.stack([starts_a, np.r_[starts_a[1:], len(ends_a)], starts_b, np.r_[starts_b[1:], len(ends_b)]]).astype(kind)
    leaves = []
    while state.shape[1]:
        whole = (state[1] - state[0] == 1) | (state[3] - state[2] == 1)
        leaves.append(state[:, whole])
        state = state[:, ~whole]
        middle = (state[0] + state[1] - 1) // 2
        # The middle token alone, then wider windows for the intervals where it ends no token of the other side.
        at = np.searchsorted(ends_b, ends_a[middle]).astype(kind)
        cut, other, reach = np.where(ends_b[at] == ends_a[middle], middle, -1), at, 1
        left = np.flatnonzero(cut < 0)
        while len(left):
            center = middle[left]
            low, high = np.maximum(center - reach, state[0, left]), np.minimum(center + reach, state[1, left] - 2)
            width = high - low + 1
            first = np.cumsum(width) - width
            tried = np.repeat(low - first, width) + np.arange(width.sum())
            at = np.searchsorted(ends_b, ends_a[tried])
            away = np.where(ends_b[at] == ends_a[tried], np.abs(tried - np.repeat(center, width)) * 2 + (tried < np.repeat(center, width)), 2**62)
            nearest = np.minimum.reduceat(away, first)
            hit = nearest < 2**62
            chosen = center[hit] + np.where(nearest[hit] % 2, -1, 1) * (nearest[hit] // 2)
            cut[left[hit]], other[left[hit]] = chosen, at[first[hit] + chosen - low[hit]]
            cutless = (low == state[0, left]) & (high == state[1, left] - 2)
            left = left[~hit & ~cutless]
            reach = 4 * reach
        leaves.append(state[:, cut < 0])
        state, cut, other = state[:, cut >= 0], cut[cut >= 0] + 1, other[cut >= 0] + 1
        # Both halves stand where their interval stood, so that ends are looked up in ascending order.
        state = np.stack([state[0], cut, cut, state[1], state[2], other, other, state[3]], axis=-1).reshape(-1, 4, 2).transpose(1, 0, 2).reshape(4, -1)
    found = np.concatenate(leaves, axis=1)
    return tuple(found[:, np.argsort(found[0])].astype(np.int64))


def _same_bytes(ids: np.ndarray, counts: np.ndarray, model: PieceEncoder, pool: tuple[np.ndarray, np.ndarray], texts: pa.Array) -> np.ndarray:
    """For each text, whether its tokens' bytes joined are the text."""
    sizes = model.sizes[ids]
    ends = np.cumsum(sizes)
    total = np.diff(np.r_[0, np.r_[0, ends][np.cumsum(counts)]])
    good = total == pc.binary_length(texts).to_numpy()
    kept = np.repeat(good, counts)
    sizes, ids = sizes[kept], ids[kept]
    at = np.repeat(pool[1][ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    wanted = texts.filter(pa.array(good)).cast(pa.large_binary())
    begin, end = (np.frombuffer(wanted.buffers()[1], np.int64)[k] for k in (wanted.offset, wanted.offset + len(wanted)))
    same = pool[0][at] == np.frombuffer(wanted.buffers()[2] or b"", np.uint8)[begin:end]
    if not same.all():
        bounds = np.r_[0, np.cumsum(total[good])]
        wrong = np.r_[0, np.cumsum(~same)]
        good[np.flatnonzero(good)[wrong[bounds[1:]] > wrong[bounds[:-1]]]] = False
    return good


class Aligner:
    """Aligned slices of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder(path_a, plain=True, remember=REMEMBER), PieceModel(path_b, remember=REMEMBER)
        self._pools = [(np.frombuffer(b"".join(m.entries), np.uint8), np.cumsum(m.sizes) - m.sizes) for m in (self.a, self.b)]
        most = max(len(self.a.sizes), len(self.b.sizes))
        self._shown = [f"{i}{mark}" for i in range(most) for mark in (",", "|", ";", "")]

    def __call__(self, texts: pa.Array) -> Iterator[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, the groups as text, distinct links and how often each stands there."""
        empty_text = pa.scalar("", pa.large_string())
        texts = pc.if_else(pc.equal(texts, empty_text), empty_text, pc.binary_join_element_wise(empty_text, texts, pa.scalar(" ", pa.large_string())))
        some = np.ones(len(texts), bool)
        sides = []
        for model, pool in zip((self.a, self.b), self._pools):
            ids, counts = model(texts)
            some &= _same_bytes(ids, counts, model, pool, texts)
            sides.append((ids, counts))
        some &= pc.binary_length(texts).to_numpy() > 0
        rows = np.flatnonzero(some)
        empty = np.empty(0, np.int64)
        out = [(0, 0, 0, 0, "", empty, empty)] * len(texts)
        if not len(rows):
            return iter(out)
        (ids_a, n_a), (ids_b, n_b) = ((ids[np.repeat(some, counts)].astype(np.int64), counts[some]) for ids, counts in sides)
        start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        a0, a1, b0, b1 = shared_cuts(np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b]), start_a, start_b)
        bounds = np.r_[np.searchsorted(a0, start_a), len(a0)]
        links = (a1 - a0) * (b1 - b0)
        n_links = np.diff(np.r_[0, np.cumsum(links)][bounds])
        shown = self._texts(ids_a, ids_b, a0, a1, b0, b1, bounds)
        keys, times = self._links(ids_a, ids_b, a0, a1, b0, b1, np.repeat(np.arange(len(rows)), np.diff(bounds)))
        marks = np.searchsorted(keys >> (2 * BITS), np.arange(len(rows) + 1))
        keys &= (1 << 2 * BITS) - 1
        for k, row in enumerate(rows.tolist()):
            part = slice(marks[k], marks[k + 1])
            out[row] = (int(n_a[k]), int(n_b[k]), int(bounds[k + 1] - bounds[k]), int(n_links[k]), shown[k], keys[part], times[part])
        return iter(out)

    def _texts(self, ids_a, ids_b, a0, a1, b0, b1, bounds) -> list[str]:
        group_a, group_b = np.repeat(np.arange(len(a0)), a1 - a0), np.repeat(np.arange(len(a0)), b1 - b0)
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        code_a, code_b = ids_a * 4, ids_b * 4
        code_a[a1 - 1] += 1
        code_b[b1 - 1] += 2
        code_b[b1[bounds[1:] - 1] - 1] += 1
        out[np.arange(len(ids_a)) + b0[group_a]] = code_a
        out[np.arange(len(ids_b)) + a1[group_b]] = code_b
        ends = (a1 + b1)[bounds[1:] - 1].tolist()
        return ["".join(map(self._shown.__getitem__, out[s:e].tolist())) for s, e in zip([0, *ends[:-1]], ends)]

    def _links(self, ids_a, ids_b, a0, a1, b0, b1, text) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, id, id) as ascending numbers, and how often each is linked."""
        size = (a1 - a0) * (b1 - b0)
        small = size <= LARGE
        n, wide = size[small], (b1 - b0)[small]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        across = np.repeat(wide, n)
        left = ids_a[np.repeat(a0[small], n) + within // across]
        right = ids_b[np.repeat(b0[small], n) + within % across]
        keys = np.sort(np.repeat(text[small] << 2 * BITS, n) | left << BITS | right)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        keys, times = keys[first], np.diff(np.r_[first, len(keys)])
        for g in np.flatnonzero(~small):
            (la, ca), (lb, cb) = (np.unique(x, return_counts=True) for x in (ids_a[a0[g] : a1[g]], ids_b[b0[g] : b1[g]]))
            keys = np.r_[keys, (text[g] << 2 * BITS | la[:, None] << BITS | lb).ravel()]
            times = np.r_[times, (ca[:, None] * cb).ravel()]
        if not small.all():
            keys, where = np.unique(keys, return_inverse=True)
            times = np.bincount(where, times).round().astype(np.int64)
        return keys, times


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker, kept between tasks."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str | None = None, tokenizer_b: str | None = None, groups: bool = False) -> DataFrame:
    """One row per row of `docs`: numbers of tokens, groups and links, the groups' SHA-256, and the distinct links with their times.

    A link is a number, the first id times 2 ** `BITS` plus the second. `groups`
    adds the groups as text, ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and
    those that either tokenizer does not give back, have no tokens and an empty
    text in place of the hash. Repeated rows and ids: each row stands for
    itself. `row` is this frame's own number of the row; other columns are
    ignored.
    """
    path_a, path_b = tokenizer_a or tokenizer_file(), tokenizer_b or tokenizer_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, row = aligner(path_a, path_b), TaskContext.get().partitionId() << 40
        for batch, texts in text_slices(batches, "text", SLICE):
            n_a, n_b, n_groups, n_links, shown, keys, times = zip(*align(texts))
            lists = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
            columns = {
                "row": pa.array(np.arange(row, row + len(texts))), "doc_id": batch.column("doc_id"),
                "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()),
                "n_groups": pa.array(n_groups, pa.int64()), "n_links": pa.array(n_links, pa.int64()),
                "groups_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown], pa.string()),
                "pairs": pa.ListArray.from_arrays(lists, np.concatenate(keys)), "times": pa.ListArray.from_arrays(lists, np.concatenate(times)),
            }
            if groups:
                columns["groups"] = pa.array(shown, pa.string())
            yield pa.RecordBatch.from_pydict(columns)
            row += len(texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA + (", groups string" if groups else ""))


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, n_docs, best) of aligned rows: how many rows hold a pair linked, and whether no pair with its first id is in more.

    Pairs are counted before they are shuffled, so one that every document
    holds costs a row per task. The best count of a first id is a row per entry
    of the vocabulary.
    """
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs")), "pairs")
    first = F.call_function("shiftright", F.col("pair"), F.lit(BITS)).alias("first")
    most = counts.groupBy(first).agg(F.max("n_docs").alias("most"))
    return counts.withColumn("first", first).join(F.broadcast(most), "first").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS, **options) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `n_best` are the links whose pair no other pair with the same first id
    outnumbers, ties included; `count_sum` sums the pairs' counts over all
    links. An empty table gives no rows. The counts are broadcast when there
    are at most `broadcast_pairs`, else joined by pair; a pair in very many
    documents then makes a long side, which Spark splits.
    """
    rows = stored(aligned(docs, **options), "aligned")
    counts = stored(link_counts(rows), "counts")
    small = counts.count() <= broadcast_pairs
    held = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    told = held.join(F.broadcast(counts) if small else counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.join(told, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
