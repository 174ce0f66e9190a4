"""A corpus from raw documents to token files, as stages over the table `documents`.

Each stage works on all rows the one before kept; `run` writes every stage as
Parquet into the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelflow.llm import decontaminate, mixing, near_dedup, quality_rules, token_files
from parcelflow.llm.common import stored, table


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is among `kept` (doc_id); null ids match one another."""
    ids = kept.select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept"]), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; of rows that share an id, all or none (all must be kept).

    Rows without an id are judged one by one, by their text. Null and blank texts go.
    """
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    rejected = judged.where("NOT kept").select(F.col("doc_id").alias("_gone"), F.col("own").alias("_own")).distinct()
    same = F.col("doc_id").eqNullSafe(rejected["_gone"]) & quality_rules.own_id().eqNullSafe(rejected["_own"])
    return docs.join(rejected, same, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest id; repeated rows once."""
    kept = near_dedup.near_duplicates(docs).where("kept").select("doc_id")
    rows = _only(docs, kept)
    return rows.dropDuplicates(["doc_id", "text"])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; rows that share an id go together, those without one go one by one.

    Null and empty texts and repeated rows stay.
    """
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights; a document stands as often as it is taken.

    Texts without words have no size and are drawn like others, at no cost. A null source is one of its own.
    Rows alike in id and text are taken together.
    """
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per document what they hold.

    A null or empty text holds its end id alone. Null ids come first; rows that share an id follow one another in the order of their texts.
    """
    return token_files.token_files(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Token ids and sampling by hash cannot be expressed in SQL. Tests hold the operators to brute force, the stages only to columns and row counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
