"""Joins whose sides the planner sizes too low: after an explode it counts a row's size, not how many rows come of it."""

import re

import pytest
from conftest import plan_of

from parcelflow.llm import decontaminate, near_dedup


@pytest.fixture
def plans(monkeypatch):
    """Plans of what a module stores, by purpose."""
    def watch(module):
        told, store = {}, module.stored

        def stored(df, purpose):
            told.setdefault(purpose, []).append(plan_of(df))
            return store(df, purpose)

        monkeypatch.setattr(module, "stored", stored)
        return told

    return watch


def near_copies(spark):
    words = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join([*words[: 60 + i % 2], f"own{i % 3}", *words[60:]])) for i in range(12)]
    rows += [(100 + i, " ".join(f"other{i}x{k}" for k in range(40))) for i in range(12)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keys_of_signatures_are_never_broadcast(spark, plans):
    """32 keys a text: the tables of texts are small enough for a broadcast, their keys need not be."""
    told = plans(near_dedup)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(near_copies(spark)).collect()}
    assert {found[i] for i in range(12)} == {0} and all(found[100 + i] == 100 + i for i in range(12))
    assert "SortMergeJoin" in told["keys"][0] and "Broadcast" not in told["keys"][0]
    # Three joins choose the pivots and take them to their keys.
    assert all(len(re.findall(r"(?m)^\(\d+\) SortMergeJoin", plan)) >= 3 for plan in told["judged"])


def test_an_index_beyond_its_bound_is_never_broadcast(spark, plans, monkeypatch):
    """144 rows an item: a table of items small enough for a broadcast has an index that need not be."""
    benchmark = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(20))), (2, "two words")], "item_id long, text string")
    inside = " ".join(["before", *(f"b{k}" for k in range(20)), "then two words after"])
    docs = spark.createDataFrame([(1, inside), (2, " ".join(f"c{k}" for k in range(50)))], "doc_id long, text string")
    want = {(1, 1, 1.0, 1, 20), (1, 2, 1.0, 22, 2)}
    assert {tuple(r) for r in decontaminate.contaminated(docs, benchmark).collect()} == want
    for bound in ("BROADCAST_INDEX", "BROADCAST_SHINGLES", "BROADCAST_ITEMS"):
        monkeypatch.setattr(decontaminate, bound, 0)
    told = plans(decontaminate)
    found = decontaminate.contaminated(docs, benchmark)
    assert {tuple(r) for r in found.collect()} == want
    # Windows by shingles; then the index, and the words of short items.
    assert re.search(r"(?m)^\(\d+\) SortMergeJoin.*\nLeft keys \[1\]: \[shingle", told["windows"][0])
    assert re.search(r"(?m)^\(\d+\) SortMergeJoin.*\nLeft keys \[3\]: \[length.*, block.*, value", plan_of(found))
    assert re.search(r"(?m)^\(\d+\) SortMergeJoin.*\nLeft keys \[1\]: \[words", plan_of(found))
