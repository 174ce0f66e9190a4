"""What several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import shared_folder

#: A word, as a pattern for Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Stands for a null id inside a job; a null id orders before all others.
NO_ID = -(2**63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, and no lineage above it."""
    spark = df.sparkSession
    path = shared_folder(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often a lambda inside reads it."""
    return F.transform(F.array(value), body)[0]


def running_total(df: DataFrame, by: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """The sum of `value` over the rows before each row, in the order of (`bucket`, `order`) within `by`.

    Buckets are summed on their own first, so no task sorts a whole group: a
    group of any size costs rows per bucket. `by` and `bucket` hold no nulls.
    """
    keys = [*by, bucket]
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = df.groupBy(*keys).agg(F.sum(value).alias("_total")).select(
        *keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(bases, keys).withColumn(
        out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    ).drop("_base")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that a slice holds about `most` bytes of `column`, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // most
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


class WordHashes(dict):
    """64-bit hashes by word. Emptied when it has grown, which changes no hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
