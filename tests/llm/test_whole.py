"""Operators over whole tables and long texts, against plain Python."""

import collections
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelflow.llm import decontaminate, line_dedup, quality_rules as Q, queries, token_counts
from parcelflow.llm.common import table


def test_a_text_of_very_many_lines_takes_linear_time(spark):
    draw = np.random.default_rng(3)
    lines = [" ".join(f"w{x}" for x in draw.integers(0, 10**6, draw.choice([0, 3, 9, 15, 40]))) for _ in range(100_000)]
    passage = [" ".join(f"p{k}x{j}" for j in range(20)) for k in range(4)]
    docs = spark.createDataFrame([(1, "\n".join(passage)), (2, "\n".join([*lines, *passage, "end"]))], "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "removed").collect()}
    assert time.time() - began < 90
    assert (rows[1].removed, rows[2].n_lines, rows[2].removed) == ([], 100_005, [100_000, 100_001, 100_002, 100_003])


def test_items_below_a_shingle_are_found_word_by_word(spark):
    items = spark.createDataFrame([(1, "Alpha beta, gamma delta"), (2, "solo"), (3, "  "), (4, None), (None, "alpha beta")], "item_id long, text string")
    texts = {1: "x alpha BETA gamma-delta y", 2: "alpha beta delta gamma", 3: "solo", 4: "solos", 5: "", 6: None, 7: "alpha", 8: "z alpha beta q solo solo"}
    docs = spark.createDataFrame([*texts.items(), (8, "solo first"), (None, "so solo")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.similarity, r.start, r.n_words) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {
        (1, 1, 1.0, 1, 4), (1, None, 1.0, 1, 2), (2, None, 1.0, 0, 2), (3, 2, 1.0, 0, 1), (8, None, 1.0, 1, 2), (8, 2, 1.0, 0, 1), (None, 2, 1.0, 1, 1),
    }


def test_short_items_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ITEMS", 1)
    items = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "q")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (2, "b a")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.start) for r in decontaminate.contaminated(docs, items).collect()} == {(1, 1, 0), (1, 2, 2)}


def test_paths_are_ordered_by_labels_that_are_not_tested():
    import pandas as pd

    steps = np.zeros((1000, 5), int)
    steps[:100, 1], steps[100:104, 0] = 20, 7
    frame = pd.DataFrame([(r, s, (steps[:, r] == s).sum()) for r in range(5) for s in np.unique(steps[:, r])], columns=["rule", "step", "n"])
    assert Q.leads(frame) == [20, 0, 20, 20, 20]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_kept_against_brute_force(spark, sf):
    """Every verdict of the query, from its scores and the labels, in numpy."""
    folder = f"/root/testdata/{sf}"
    measured = Q.scored(Q.measures(table(spark, folder, "documents")))
    rows = measured.select("doc_id", "stratum", "base_failed", "scores", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")).toPandas()
    good = set(table(spark, folder, "labels").where("quality = 1").toPandas().doc_id)
    steps = np.ceil(np.array(rows.scores.tolist()) * Q.GRID).astype(int)
    labelled = rows.doc_id.isin(good).to_numpy() & ~rows.base_failed.to_numpy()
    half, stratum = rows.half.to_numpy(), rows.stratum.to_numpy()
    tested = {s: steps[labelled & (half == 1) & (stratum == s)] for s in set(stratum)}
    risk = Q.DELTA / max(1, sum(len(t) >= Q.labels_needed(Q.ALPHA, Q.TOGETHER * Q.DELTA) for t in tested.values()))
    over = np.zeros(len(rows), bool)

    def last_safe(own, alpha, at, risk):
        """The lowest cutoff before the first that is not shown to be safe."""
        end = at
        while len(own) and end > 0 and Q.upper_bound(int((own > end - 1).sum()), len(own), risk) <= alpha:
            end -= 1
        return end

    for s, seen in tested.items():
        first = steps[labelled & (half == 0) & (stratum == s)]
        lead = np.zeros(5, int)
        if len(first):
            safe = np.array([min(c for c in range(Q.GRID + 1) if (first[:, r] > c).sum() <= Q.ALPHA / 10 * len(first)) for r in range(5)])
            lead = safe.max() - safe
        path = np.where(seen > 0, seen + lead, 0).max(1) if len(seen) else np.zeros(0, int)
        joint = np.clip(last_safe(path, Q.ALPHA, Q.GRID + lead.max(), Q.TOGETHER * risk) - lead, 0, Q.GRID)
        alone = np.array([last_safe(seen[:, r], Q.ALPHA / 5, Q.GRID, (1 - Q.TOGETHER) * risk / 5) for r in range(5)])
        cut = joint if joint.sum() <= alone.sum() else alone
        over |= (stratum == s) & (steps > cut).any(1)
    expected = dict(zip(rows.doc_id, ~rows.base_failed.to_numpy() & ~over))
    found = {r.doc_id: r.kept for r in queries.op10_quality_rules(spark, folder).collect()}
    assert found == expected and (sf == "sf0.01" or over.any())


def test_quality_stage_judges_rows_without_an_id_one_by_one(spark, tmp_path):
    prose = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(None, prose), (None, "short"), (None, None), (4, prose), (4, "short"), (5, prose)], "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("web")})
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert rows.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in rows.collect()) == [(0, prose), (5, prose)]


def test_shards_hold_what_the_table_holds(spark, folder):
    docs = {r.doc_id: (r.text or "").encode() for r in table(spark, folder, "documents").collect()}
    rows = queries.op8_sharding(spark, folder).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in docs.items()}
    total, shard_of = collections.Counter(), {}
    for r in rows:
        total[r.shard] += r.size
        assert shard_of.setdefault(docs[r.doc_id], r.shard) == r.shard
    group = collections.Counter()
    for i, t in docs.items():
        group[t] += len(t) + 16
    assert set(total) == set(range(40)) and max(total.values()) - min(total.values()) <= max(group.values())


def test_at_limits(spark):
    """Limits below, between, at and beyond the lengths that occur, against sums over all documents."""
    lengths = [*np.random.default_rng(8).integers(1, 400, 3000).tolist(), *[77] * 1500, 9000]
    histogram = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    limits = [1, 2, 76, 77, 78, 250, 399, 400, 5000, 8999, 9000, 9001, 10**7]
    rows = token_counts.at_limits(histogram, spark.createDataFrame([(x,) for x in limits], "limit long")).collect()
    assert {tuple(r) for r in rows} == {(x, sum(n <= x for n in lengths), sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in limits}
    empty = token_counts.length_histogram(spark.createDataFrame([], "n_tokens long"))
    assert empty.count() == 0
