"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is ``-ln(u) / weight`` with u a hash of the document in (0, 1)
and weight its quality: taking documents in ascending order of key draws
without replacement in proportion to weight. A source whose target is more than
its size gives whole epochs first, and only the rest is drawn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, running_total, stored

#: Sources beyond this many are joined instead of broadcast.
BROADCAST_SOURCES = 20_000
#: Documents that one task sorts, about.
SORTED_TOGETHER = 4_000
EPOCHS = 3


def words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = EPOCHS) -> DataFrame:
    """`sizes` (name, source_size) with `target`: the sum of all sizes shared by weight.

    Weights go round in the order of names (by code point, null last). No
    target is above `epochs` times its source; what is cut off is shared again by
    weight among the others. The level at which this ends is found at once:
    with sources in the order of cap / weight, the capped ones are a prefix.
    One row per source passes here, never documents.
    """
    named = Window.orderBy(F.col("name").isNull(), F.col("name").cast("binary"))
    turn = F.array(*[F.lit(w) for w in weights])[(F.row_number().over(named) - 1) % len(weights)]
    capped = sizes.withColumn("w", turn).withColumn("cap", epochs * F.col("source_size"))
    order = [F.col("cap") / F.col("w"), F.col("name").isNull(), F.col("name")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(before), F.lit(0))
    # The first source that is not capped sets the level for itself and all after it.
    level = F.min(F.when(F.col("own") * F.col("w") <= F.col("cap"), F.struct("turn", "own"))).over(everywhere)["own"]
    return (
        capped.withColumn("own", left / weight).withColumn("turn", F.row_number().over(Window.orderBy(*order)))
        .withColumn("level", level)
        .withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))))
        .select("name", "source_size", "target")
    )


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds a source's columns; broadcast only when the number of sources, just counted, is small."""
    small = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    side = (F.broadcast(sources) if small else sources).withColumnRenamed("name", "_name")
    return rows.join(side, F.col("name").eqNullSafe(F.col("_name")), "left").drop("_name")


def plan(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = EPOCHS, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, sources).

    Documents: their columns, `name`, `size` and `key`. Sources: `name`,
    `source_size`, `target`, `whole` (epochs), and where the draw ends: keys up
    to `last`, inclusive. A document is taken ``whole + (key <= last)`` times.
    """
    narrow = stored(keyed(docs, quality, id_col, text_col, source_col, seed).select("name", "size", "key"), "sizes")
    sizes = narrow.groupBy("name").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    aimed = stored(targets(sizes.select("name", "source_size"), epochs=epochs).join(sizes.select(F.col("name").alias("_n"), "n"), F.col("name").eqNullSafe(F.col("_n"))).drop("_n"), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aimed = aimed.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    # Equal keys (repeated rows) are taken together or not at all.
    ties = narrow.groupBy("name", "key").agg(F.sum("size").alias("size"))
    spread = F.floor((1 - F.exp(-F.col("key"))) * F.ceil(F.col("n") / SORTED_TOGETHER)).cast("long")
    placed = _by_source(ties, aimed).withColumn("bucket", spread).withColumn("tag", F.coalesce(F.concat(F.lit("="), "name"), F.lit("-")))
    summed = running_total(placed.select("name", "tag", "bucket", "key", "size", "budget"), ["tag"], "bucket", ["key"], "size", "before")
    drawn = summed.where((F.col("budget") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("budget")))
    last = drawn.groupBy("name").agg(F.max("key").alias("last")).withColumnRenamed("name", "_n")
    ends = aimed.join(last, F.col("name").eqNullSafe(F.col("_n")), "left").drop("_n", "n", "budget")
    return narrow, stored(ends, "sources")


def keyed(docs: DataFrame, quality: DataFrame | None, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """`docs` with name, size and key. `quality`: (id, weight > 0), one row per id; others weigh 1."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 11) + 0.5) / float(1 << 53)
    rows = docs.withColumns({"name": F.col(source_col), "size": words(text_col), "_unit": unit})
    if quality is None:
        rows = rows.withColumn("_weight", F.lit(1.0))
    else:
        rows = rows.join(quality.select(F.col("id").alias("_id"), F.col("weight").alias("_weight")), F.col(id_col) == F.col("_id"), "left").drop("_id")
    return rows.withColumn("key", -F.log("_unit") / F.coalesce("_weight", F.lit(1.0))).drop("_unit", "_weight")


def copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Keyed rows with their source's columns and `copies`, the times each is taken."""
    times = F.col("whole") + F.coalesce((F.col("key") <= F.col("last")).cast("long"), F.lit(0))
    return _by_source(rows, sources).withColumn("copies", times)


def label_quality(labels: DataFrame) -> DataFrame:
    """Weights from a table of labels (doc_id, quality 0/1): 0.5 to 1.5, the mean where a document has several."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    return known.agg((0.5 + F.avg("quality")).alias("weight"))


def mix(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20) -> DataFrame:
    """The mix: rows of `docs`, each as often as it is taken.

    Null, empty and blank texts have size 0 and are drawn like others, at no
    cost. A null source is a source of its own. Rows that are alike in id and
    text are taken together. An empty table gives an empty mix. Other columns
    pass through, whatever their names.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = own.select("doc", F.col(f"doc.`{id_col}`").alias("doc_id"), F.col(f"doc.`{text_col}`").alias("text"), F.col(f"doc.`{source_col}`").alias("source"))
    quality = None if labels is None else label_quality(labels)
    _, sources = plan(rows.drop("doc"), quality, "doc_id", "text", "source", seed=seed)
    taken = copies(keyed(rows, quality, "doc_id", "text", "source", seed), sources).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def mix_counts(docs: DataFrame, labels: DataFrame | None = None, seed: int = 20) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words)."""
    quality = None if labels is None else label_quality(labels)
    rows = docs.select("doc_id", "text", "source")
    _, sources = plan(rows, quality, seed=seed)
    taken = copies(keyed(rows, quality, "doc_id", "text", "source", seed), sources)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
