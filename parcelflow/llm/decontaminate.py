"""Benchmark passages in documents, by SimHash over windows of an item's size.

A window of a document is as many words as a benchmark item has. Only windows
that can be similar are looked at: one that shares no shingle with the item has
similarity 0, and one that does starts where the shared shingle puts the item's
first word. Each such window and each item get a SimHash of `BLOCKS` blocks of
`BLOCK_BITS` bits. Items enter the index of every block with all values that differ in at
most one bit, so a window meets every item of its size within
``2 * BLOCKS - 1`` bits (two that differ in more bits in every block may be
missed: a chance of 5e-7 at the similarity threshold). What meets is verified
by the exact similarity of the shingles with their counts as weights, the sum
of the smaller counts over the sum of the larger.

An item of fewer words than a shingle has none; it is found where its words stand
in a document as they are, in its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, stored

WIDTH, THRESHOLD = 5, 0.8
BLOCKS, BLOCK_BITS = 16, 8
#: Shingles of all items that are broadcast; a larger benchmark is joined by shuffles.
BROADCAST_SHINGLES = 1_000_000
#: Rows of the index of items that are broadcast: 40 MB at most.
BROADCAST_INDEX = 1_000_000
#: Items of fewer than `WIDTH` words that are broadcast.
BROADCAST_ITEMS = 200_000


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingles(words: Column) -> Column:
    """Hashes of all runs of `WIDTH` words, in order; none for fewer words."""
    def run(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WIDTH)
        return F.when(F.size(w) >= WIDTH, F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WIDTH)]))).otherwise(
            F.array().cast("array<bigint>")
        )

    return let(words, run)


def simhash(items: Column) -> Column:
    """`BLOCKS` numbers of `BLOCK_BITS` bits. A bit is set when most shingles, by count, have it in their hash."""
    def ones(hashes: Column, bits: int) -> Column:
        one = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), one)

    def blocks(h: Column) -> Column:
        halves = F.concat(ones(h, 64), let(F.transform(h, lambda x: F.xxhash64(x)), lambda g: ones(g, BLOCKS * BLOCK_BITS - 64)))
        def fold(counts: Column) -> Column:
            bit = lambda b: (2 * F.get(counts, b) > F.size(h)).cast("int")
            block = lambda c: F.aggregate(F.sequence(c * BLOCK_BITS, c * BLOCK_BITS + BLOCK_BITS - 1), F.lit(0), lambda n, b: n * 2 + bit(b))
            return F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), block)

        return let(halves, fold)

    return let(items, blocks)


def overlap(a: Column, b: Column) -> Column:
    """Of two arrays of shingles, the sum of the smaller counts."""
    count = lambda items, x: F.size(F.filter(items, lambda y: y == x))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): a row per document and item found in it, at its best window.

    `start` counts words from 0. A document shorter than the item is one
    window. Texts without words hold nothing and are found in nothing; items of
    fewer than `WIDTH` words are found word by word, at their first place. Repeated
    rows count once. Null ids pass through. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    texts = texts.withColumn("version", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text"))
    every = benchmark.select(F.col("item_id").cast("long").alias("item_id"), normal_words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    return _similar(texts, every.where(F.size("w") >= WIDTH), threshold).unionByName(_brief(texts, every.where(F.size("w") < WIDTH)))


def _looked_up(side: DataFrame, small: bool) -> DataFrame:
    """The side of a join, broadcast if it was counted as small, else never: the planner knows nothing of the rows an explode makes."""
    return F.broadcast(side) if small else side.hint("merge")


def _brief(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `contaminated` for items of fewer than `WIDTH` words, met by their words as they are."""
    items = stored(items.select("item_id", F.size("w").alias("n"), F.array_join("w", " ").alias("words")), "brief")
    lengths = [row.n for row in items.select("n").distinct().collect()]  # WIDTH - 1 of them at most
    if not lengths:
        return texts.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start long, n_words long")

    def runs(w: Column) -> Column:
        of = lambda n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(i.alias("start"), F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]).alias("words"))))
        empty = F.array().cast("array<struct<start:int,words:string>>")
        return F.concat(empty, *[F.coalesce(of(n), empty) for n in sorted(lengths)])

    small = items.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    seen = texts.select("doc_id", F.explode(let(normal_words(F.col("text")), runs)).alias("r")).select("doc_id", "r.*")
    met = seen.join(_looked_up(items, small), "words")
    found = met.groupBy("doc_id", "item_id").agg(F.min(F.struct("start", "n")).alias("best"))
    return found.select("doc_id", "item_id", F.lit(1.0).alias("similarity"), F.col("best.start").cast("long").alias("start"), F.col("best.n").cast("long").alias("n_words"))


def _similar(texts: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The rows of `contaminated` for items that have shingles."""
    items = stored(items.select(
        F.xxhash64(F.coalesce("item_id", F.lit(-1)), F.col("item_id").isNull(), "w").alias("item"), "item_id", F.size("w").alias("length"), shingles(F.col("w")).alias("theirs")
    ), "items")

    spots = items.select("length", F.posexplode("theirs").alias("q", "shingle")).distinct()
    small = spots.limit(BROADCAST_SHINGLES + 1).count() <= BROADCAST_SHINGLES
    seen = texts.select("version", normal_words(F.col("text")).alias("w")).select(
        "version", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"))).alias("p", "shingle")
    )
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("n") - F.col("length")))
    hits = seen.join(_looked_up(spots, small), "shingle").select("version", "length", start.alias("start")).distinct()
    # A document has no more windows than words and item sizes.
    wanted = hits.groupBy("version").agg(F.collect_list(F.struct("length", "start")).alias("windows"))
    cut = texts.join(wanted, "version").select("version", "doc_id", "windows", shingles(normal_words(F.col("text"))).alias("all"))
    mine = F.transform("windows", lambda w: F.struct(w["length"].alias("length"), w["start"].alias("start"), F.slice(F.col("all"), w["start"] + 1, w["length"] - WIDTH + 1).alias("mine")))
    windows = stored(cut.select("version", "doc_id", F.explode(mine).alias("w")).select("version", "doc_id", "w.*").distinct(), "windows")

    marked = windows.select("version", "doc_id", "length", "start", "mine", F.posexplode(simhash(F.col("mine"))).alias("block", "value"))
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(BLOCK_BITS)])
    index = items.select("item", "length", F.posexplode(simhash(F.col("theirs"))).alias("block", "own"))
    index = index.select("item", "length", "block", F.explode(F.transform(flips, lambda f: F.col("own").bitwiseXOR(f))).alias("value"))
    # What is broadcast has a row of four numbers per item, block and value.
    few = items.limit(BROADCAST_INDEX // (BLOCKS * (BLOCK_BITS + 1)) + 1).count() * BLOCKS * (BLOCK_BITS + 1) <= BROADCAST_INDEX
    met = marked.join(_looked_up(index, few), ["length", "block", "value"])
    # Texts that share an id are judged apart, by their version; the best window of the id is taken last.
    met = met.groupBy("version", "doc_id", "start", "length", "item").agg(F.first("mine").alias("mine"))
    met = met.join(F.broadcast(items.drop("length")) if few and small else items.drop("length"), "item")
    both = met.withColumn("both", overlap(F.col("mine"), F.col("theirs")))
    judged = both.withColumn("similarity", F.col("both") / (F.size("mine") + F.size("theirs") - F.col("both"))).where(F.col("similarity") >= threshold)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (F.size("mine") + WIDTH - 1).alias("n_words"))).alias("best")
    return judged.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).cast("long").alias("start"), F.col("best.n_words").cast("long").alias("n_words")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `docs` whose id is not found with any item, with all their columns.

    Rows that share an id stay or go together; rows without an id are judged one by
    one. Null and empty texts stay. Repeated rows are kept as often as they stand. An empty benchmark keeps all.
    """
    named, nameless = docs.where(F.col(id_col).isNotNull()), docs.where(F.col(id_col).isNull())
    found = contaminated(named, benchmark, id_col, text_col).select(F.col("doc_id").alias("_found")).distinct()
    clean = named.join(found, named[id_col].cast("long") == found["_found"], "left_anti")
    # Rows without an id are known by their text; its hash is an id of its own.
    own = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    texts = nameless.select(own.alias("own"), F.col(text_col).alias("text"))
    gone = contaminated(texts, benchmark, "own", "text").select(F.col("doc_id").alias("_found")).distinct()
    return clean.unionByName(nameless.join(gone, own == gone["_found"], "left_anti"))
