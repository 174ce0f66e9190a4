"""The queries of this subpackage, each over a whole table of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import align, decontaminate, line_dedup, mixing, near_dedup, ngram_join, pii, prefix_trie, quality_rules, sharding, token_counts, token_files, url_filter
from .common import table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(table(spark, folder, "documents")))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, folder, "pages"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rest = line_dedup.dedup_lines(table(spark, folder, "documents"), mixed=True)
    return rest.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.crc32(F.col("text").cast("binary")).alias("rest_crc32"),
    )


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.drop("own", "stratum", "n_lines")


def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return align.align_documents(table(spark, folder, "documents"))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_turns(table(spark, folder, "conversations")))


QUERIES = {f.__name__: f for f in (op1_pii, op2_token_counts, op3_url_filter, op4_mixing, op5_near_dedup, op6_decontaminate, op7_line_dedup, op8_sharding, op9_token_files, op10_quality_rules, op11_cross_tokenizer, op12_ngram_join, op13_prefix_trie)}

#: SQL for the queries that it can express; the others are tested against brute force.
ORACLES = {
    "op5_near_dedup": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
g AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
        ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.s = b.s AND a.doc_id != b.doc_id
    JOIN n AS p ON p.doc_id = a.doc_id JOIN n AS q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op12_ngram_join": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
g AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 4 THEN [array_to_string(l, ' ')]
        ELSE list_transform(range(1, len(l) - 2), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] || ' ' || l[i + 3]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.s = b.s AND a.doc_id != b.doc_id
    JOIN n AS p ON p.doc_id = a.doc_id JOIN n AS q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op13_prefix_trie": r"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) AS i FROM t),
c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
        lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)),
        4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
    SELECT c.conv_id, 0 AS part, o.i, o.k, o.text FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
    UNION ALL SELECT c.conv_id, 1, o.i, o.k, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
s AS (
    SELECT conv_id, row_number() OVER w AS d, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING) AS p,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
    UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS (SELECT p, min(conv_id) AS conv_id, min(d) AS depth, count(*) AS n_convs, min(words) AS words FROM s GROUP BY p),
e AS (
    SELECT p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(p, d) AS p FROM s GROUP BY conv_id) GROUP BY p),
q AS (SELECT n.*, CASE WHEN depth > 0 THEN left(p, 32 * (depth - 1)::INT) END AS above FROM n),
k AS (SELECT above AS p, count(*) AS n_children FROM q GROUP BY above),
f AS (SELECT q.*, coalesce(k.n_children, 0) AS n_children FROM q LEFT JOIN k ON k.p = q.p),
u AS (
    SELECT a.p, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
    FROM (SELECT DISTINCT x.p, y.p AS q FROM s x JOIN s y ON x.conv_id = y.conv_id AND x.d <= y.d) a JOIN f b ON b.p = a.q GROUP BY a.p)
SELECT f.conv_id, f.depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, u.saved::BIGINT AS saved_tokens,
    sha256(coalesce(e.ids, '')) AS ends_sha256
FROM f JOIN u ON u.p = f.p LEFT JOIN n AS parent ON parent.p = f.above LEFT JOIN e ON e.p = f.p""",
}
