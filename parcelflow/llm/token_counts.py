"""Token totals for every context limit from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import running_total, stored
from .encode import encoder, text_slices, tokenizer_file

#: Lengths summed together before the running sums: no task sees more distinct lengths than this.
SPAN = 1024


def encoded_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per row of `docs`: n_tokens, without special tokens; null and empty texts have 0."""
    path = tokenizer or tokenizer_file()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(encoder(path)(texts)[1], pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs, and what it answers about a context limit of that length.

    ============== =========================================================
    n_tokens       the length, also read as the limit
    n_docs         documents of this length
    docs_at_least  documents of this length or more
    docs_at_most   documents of this length or less: its quantile's rank
    tokens_at_least tokens of documents of this length or more
    tokens_within  tokens that a limit of this length keeps when longer
                   documents are cut to it
    tokens_cut     tokens that it cuts off
    quantile       share of documents of this length or less
    ============== =========================================================

    An empty table gives no rows. Lengths are aggregated before the shuffle, so
    a length that a third of all documents have costs a row per task; sums run
    over spans of lengths first, then inside a span.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = stored(counts.withColumn("span", F.floor(F.col("n_tokens") / SPAN)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("all", F.lit(0)), "lengths")
    totals = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()
    run = running_total(counts, ["all"], "span", ["n_tokens"], "n_docs", "docs_before")
    run = running_total(run, ["all"], "span", ["n_tokens"], "tokens", "tokens_before")
    docs, tokens = F.lit(totals.d), F.lit(totals.t)
    return run.select(
        "n_tokens", "n_docs",
        (docs - F.col("docs_before")).alias("docs_at_least"),
        (F.col("docs_before") + F.col("n_docs")).alias("docs_at_most"),
        (tokens - F.col("tokens_before")).alias("tokens_at_least"),
        (F.col("tokens_before") + F.col("n_tokens") * (docs - F.col("docs_before"))).alias("tokens_within"),
        (tokens - F.col("tokens_before") - F.col("n_tokens") * (docs - F.col("docs_before"))).alias("tokens_cut"),
        ((F.col("docs_before") + F.col("n_docs")) / docs).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: DataFrame) -> DataFrame:
    """For each `limit` (any positive number of tokens): documents that fit whole, and tokens kept when longer ones are cut.

    A limit between two lengths is answered by the next length that occurs:
    every document of at least that length is cut, all others are whole.
    """
    merged = histogram.select(F.col("n_tokens").alias("at"), "docs_at_least", "tokens_at_least", F.lit(None).cast("long").alias("limit")).unionByName(
        limits.select((F.col("limit") + 1).cast("long").alias("at"), F.lit(None).cast("long").alias("docs_at_least"), F.lit(None).cast("long").alias("tokens_at_least"), F.col("limit").cast("long"))
    )
    total = histogram.agg(F.max("docs_at_least").alias("docs"), F.max("tokens_at_least").alias("tokens"))
    # Distinct lengths and limits only: as many rows as the longest document has tokens, at most.
    # From the longest down, so that each row adds to what the one before has seen.
    after = Window.orderBy(F.col("at").desc(), F.col("limit").isNull().desc()).rowsBetween(Window.unboundedPreceding, 0)
    fill = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(after), F.lit(0))
    cut = merged.select("limit", fill("docs_at_least").alias("docs_cut"), fill("tokens_at_least").alias("long_tokens")).where("limit IS NOT NULL")
    kept: Column = F.col("tokens") - F.col("long_tokens") + F.col("docs_cut") * F.col("limit")
    return cut.join(F.broadcast(total)).select("limit", (F.col("docs") - F.col("docs_cut")).alias("docs_whole"), "docs_cut", kept.alias("tokens_within"))
