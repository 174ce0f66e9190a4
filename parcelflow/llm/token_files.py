"""Token ids as flat binary files that readers map into memory.

A part is two files: ``NAME.ids``, the ids of its documents one after the
other as little-endian unsigned integers (16 bits when the vocabulary allows,
else 32), and ``NAME.off``, little-endian unsigned 64-bit offsets, one more
than documents, in ids. Beside them the table ``documents`` has a row per
document (part, name, row, doc_id), and ``parts`` a row per part with the ids
of all parts before it. Document `row` of a part is
``ids[off[row] : off[row + 1]]`` and starts at ``base + off[row]`` of the whole.

Files are mapped, so the shared folder must be one that executors mount: a
path or ``file:`` URI. Others are refused.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shared_folder
from .encode import encoder, text_slices, tokenizer_file

END = 0


def mounted(folder: str) -> str:
    """The folder as a local path."""
    at = urlsplit(folder)
    if at.scheme not in ("", "file") or at.netloc not in ("", "localhost"):
        raise ValueError(f"token files are mapped into memory and need a mounted folder, not {folder}")
    return at.path


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> None:
    """Encode documents into `folder` in ascending order of id, the end id after each document.

    Null ids come first; rows that share an id follow one another in the order
    of their texts. A null or empty text has the end id only. An empty table
    gives tables without rows. A task that is run again writes files of new
    names, and only the names that its committed rows carry are ever read.
    """
    path, target = tokenizer or tokenizer_file(), mounted(folder)
    os.makedirs(f"{target}/data", exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        name, total, row = f"part-{part:06d}-{uuid.uuid4().hex}", 0, 0
        ids_file = offsets_file = None
        for batch, texts in text_slices(batches, "text"):
            if ids_file is None:
                os.makedirs(f"{target}/data", exist_ok=True)
                ids_file, offsets_file = (open(f"{target}/data/{name}.{kind}", "wb") for kind in ("ids", "off"))
                offsets_file.write(np.zeros(1, "<u8").tobytes())
            ids, counts = encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, END).astype(f"<u{ids.itemsize}")
            offsets = total + ends + np.arange(1, len(texts) + 1)
            ids_file.write(ids.tobytes())
            offsets_file.write(offsets.astype("<u8").tobytes())
            total = int(offsets[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(texts), part), pa.int32()), pa.array([name] * len(texts)),
                    pa.array(np.arange(row, row + len(texts)), pa.int64()), batch.column("doc_id"),
                    pa.array(np.full(len(texts), ids.itemsize), pa.int32()), pa.array(counts + 1, pa.int64()),
                ],
                ["part", "name", "row", "doc_id", "width", "n_ids"],
            )
            row += len(texts)
        for file in (ids_file, offsets_file):
            if file is not None:
                file.flush()
                os.fsync(file.fileno())
                file.close()

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, name string, row long, doc_id long, width int, n_ids long"
    ordered.mapInArrow(write, schema).write.parquet(f"{folder}/documents")
    table = docs.sparkSession.read.schema(schema).parquet(f"{folder}/documents")
    # One row per part: as many as the write had tasks.
    parts = table.groupBy("part", "name", "width").agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("n_docs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (over the ids as 32-bit integers)."""
    target = mounted(folder)
    schema = "part int, name string, row long, doc_id long, width int, n_ids long"
    table = spark.read.schema(schema).parquet(f"{folder}/documents").select("part", "row", "doc_id")
    parts = spark.read.schema("part int, name string, width int, n_ids long, n_docs long, base long").parquet(f"{folder}/parts")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (name, width, base), rows in frame.groupby(["name", "width", "base"], sort=False):
                ids = np.memmap(f"{target}/data/{name}.ids", f"<u{width}", "r")
                offsets = np.memmap(f"{target}/data/{name}.off", "<u8", "r")
                at = rows["row"].to_numpy()
                start, end = offsets[at].astype(np.int64), offsets[at + 1].astype(np.int64)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(start.tolist(), end.tolist())]
                yield pd.DataFrame({"doc_id": rows["doc_id"], "start": base + start, "n_tokens": end - start, "ids_crc32": np.array(crc, np.int64)})

    # The parts are broadcast: a row per task of the write.
    named = table.join(F.broadcast(parts.select("part", "name", "width", "base")), "part").drop("part")
    return named.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write documents as token files (a new folder in the shared one unless given) and read them back."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "llm-tokens")
    write_tokens(docs, folder, **options)
    return read_tokens(spark, folder)
