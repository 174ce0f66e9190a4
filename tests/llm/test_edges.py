"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, line_dedup, mixing, near_dedup, pii, quality_rules, sharding, token_counts, token_files, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, key long, label int, size string, name string, _kept int, _found int, copies int"
PASSAGE = " ".join(f"word{k} of passage{k}" for k in range(20))
LONG = " ".join(f"w{k % 7001}" for k in range(60_000))


def rows():
    plain = lambda i, t, lang="en", source="a": (i, t, lang, source, 1, "x", 2, 3, "y", "z", 4, 5, 6)
    return [
        plain(1, PASSAGE), plain(2, PASSAGE), plain(2, PASSAGE), plain(3, None, None, None), plain(4, ""), plain(5, " \n\t "),
        plain(None, PASSAGE + " and more"), plain(6, LONG, "de", "b"), plain(7, "one"), plain(8, "x" * 50_000, "fr", None),
        plain(9, "mail a.b@c.example.org or +1 (743) 555-3824 now 1.2.3.4 \U0001f600 4111 1111 1111 1111"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (6, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (3, "too short"), (None, "never seen words in any text here")], "item_id long, text string")


def ids(frame, column="doc_id"):
    return sorted((r[column] for r in frame.collect()), key=lambda x: (x is not None, x))


ALL = [None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]


def test_pii(docs, none):
    found = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert ids(pii.find_pii(docs)) == ALL and found[3].spans == "" and pii.find_pii(none).count() == 0
    assert (found[9].n_email, found[9].n_ip, found[9].n_card, found[9].n_phone) == (1, 1, 1, 1)
    text = next(r[1] for r in rows() if r[0] == 9)
    spans = [s.split(":") for s in found[9].spans.split(",")]
    assert [(k, text[int(a) : int(b)]) for k, a, b in spans] == [
        ("email", "a.b@c.example.org"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (743) 555-3824"),
    ]


def test_token_counts(docs, none):
    assert token_counts.length_histogram(token_counts.encoded_lengths(none)).count() == 0
    by = {r.n_tokens: r for r in token_counts.length_histogram(token_counts.encoded_lengths(docs)).collect()}
    assert by[0].n_docs == 2 and by[0].docs_at_least == 11 and by[max(by)].tokens_cut == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "no scheme", ""), (3, "http://A.Example.COM", None), (3, "http://A.Example.COM", None), (None, "https://x.net/es/1?a#b", "<a href='//y.org/'>"), (4, "http://q.org/#f", "<a href=\"http://x.net/es/1\">"), (5, "http://www.example.com/en/x", "")],
        "page_id long, url string, html string",
    )
    found = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_pages(pages).collect()}
    assert found == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.example.com", "", None, "allow"),
        (None, "x.net", "/es/1", "net/es/", "block"), (4, "q.org", "/", None, "block"), (5, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    }
    assert url_filter.judge_pages(pages).count() == 7 and url_filter.judge_pages(pages.limit(0)).count() == 0


def test_mixing(docs, none, labels):
    assert mixing.mix_counts(none, labels).count() == 0 and mixing.mix(none).count() == 0
    counts = mixing.mix_counts(docs, labels)
    assert ids(counts) == ALL
    assert {r.taken for r in counts.where("size = 0").collect()} == {0}
    mixed = mixing.mix(docs, labels)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(mixing.words("text"))).first()[0] == counts.select(F.sum("taken")).first()[0]


def test_near_dedup(docs, none):
    assert near_dedup.near_duplicates(none).count() == 0
    found = near_dedup.near_duplicates(docs)
    assert ids(found) == ALL
    by = {r.doc_id: (r.component_id, r.kept) for r in found.collect()}
    assert by[1] == (None, False) and by[2] == (None, False) and by[None] == (None, True) and by[3] == (3, True) and by[7] == (7, True)


def test_decontaminate(docs, none, bench):
    found = decontaminate.contaminated(docs, bench)
    assert sorted((r.doc_id or 0, r.item_id, r.similarity, r.start) for r in found.collect()) == [(0, 1, 1.0, 0), (1, 1, 1.0, 0), (2, 1, 1.0, 0)]
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_lines(docs, none):
    assert line_dedup.dedup_lines(none).count() == 0
    found = line_dedup.dedup_lines(docs)
    assert ids(found) == ALL
    assert sorted({(r.doc_id, tuple(r.removed)) for r in found.where("size(removed) > 0").collect()}) == [(2, (0,))]


def test_sharding(docs, none):
    assert sharding.shard(none).count() == 0
    found = sharding.shard(docs, shards=4)
    assert ids(found) == ALL
    by = {}
    for r in found.collect():
        by.setdefault(r["shard"], []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["shard"] for r in found.where("doc_id IN (1, 2)").collect()}) == 1


def test_token_files(docs, none):
    assert token_files.token_files(none).count() == 0
    found = sorted(token_files.token_files(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == ALL
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:])) and found[4].n_tokens == 1


def test_token_folder_must_be_mounted():
    with pytest.raises(ValueError, match="mounted"):
        token_files.mounted("hdfs://cluster/x")


def test_quality(docs, none, labels):
    assert quality_rules.judge(none, labels).count() == 0
    found = quality_rules.judge(docs, labels.limit(0))
    assert ids(found) == ALL
    assert {r.doc_id for r in found.where("kept").collect()} == {None, 1, 2}


def test_stages(spark, docs, none, labels, bench, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    sizes = []
    for start in (none, docs):
        rest = start
        for name, stage in corpus_pipeline.STAGES:
            rest.write.parquet(f"{tmp_path}/{name}-{len(sizes)}")
            rest = stage(spark, spark.read.schema(rest.schema).parquet(f"{tmp_path}/{name}-{len(sizes)}"), str(tmp_path))
            if name != "tokens":
                assert rest.columns == docs.columns
            sizes.append(rest.count())
    assert sizes[:5] == [0] * 5 and sizes[5:7] == [4, 1]


def test_quality_with_a_few_hundred_labels(spark):
    """Labelled bad documents of every stratum go; most good ones stay, also where they break one rule."""
    prose = lambda k: " ".join(f"word{k}x{j}" for j in range(40))
    made, marks = [], []
    for at, lang in enumerate(("de", "fr", "es", "it", "rare")):
        for k in range(300 if lang != "rare" else 20):
            i, bad = at * 1000 + k, k % 10 == 0
            lists = "\n".join(["- one line again"] * 2) + "\n" if k % 50 == 1 else ""
            made.append((i, lists + prose(i) + ("".join(f" ##{j}" for j in range(20)) if bad else ""), lang))
            marks.append((i, int(not bad)))
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    judged = quality_rules.judge(docs, spark.createDataFrame(marks, "doc_id long, quality int")).toPandas()
    good = judged.doc_id.isin([i for i, q in marks if q])
    by = judged.assign(bad_kept=judged.kept & ~good, good_gone=~judged.kept & good).groupby("stratum")[["bad_kept", "good_gone"]].sum()
    assert by.bad_kept.drop("rare").sum() == 0 and by.bad_kept["rare"] == 2 and (by.good_gone <= 0.05 * 270).all()


def test_quality_cutoffs_hold_and_one_rule_does_not_hold_up_the_others():
    import numpy as np
    import pandas as pd

    Q = quality_rules
    assert (Q.labels_needed(0.05, 0.9 * 0.05), Q.labels_needed(0.05, 0.9 * 0.05 / 4)) == (61, 88)

    def histogram(steps):
        on_path = np.where(steps > 0, steps + np.array(Q.LEAD), 0).max(1)
        every = np.c_[steps, on_path]
        return pd.DataFrame([(r, s, (every[:, r] == s).sum()) for r in range(len(Q.RULES) + 1) for s in np.unique(every[:, r])], columns=["rule", "step", "n"])

    clean = np.zeros((88, 5), int)
    assert Q.choose(histogram(clean[:60])) == [1.0] * 5 and Q.choose(histogram(clean[:61])) == [0.0] * 5
    assert Q.choose(histogram(clean[:87]), delta=Q.DELTA / 4) == [1.0] * 5 and Q.choose(histogram(clean), delta=Q.DELTA / 4) == [0.0] * 5
    code = np.zeros((3000, 5), int)
    code[:600, 0] = Q.GRID  # a fifth of the good documents is full of symbols
    assert Q.choose(histogram(code)) == [1.0, 0.0, 0.0, 0.0, 0.0]

    # Cutoffs that reject over ALPHA of the good ones come out in few of many draws.
    rng, wrong = np.random.default_rng(4), 0
    for _ in range(300):
        draw = lambda n: np.where(rng.random((n, 5)) < 0.06, rng.integers(1, Q.GRID + 1, (n, 5)), 0)
        cut, fresh = np.array(Q.choose(histogram(draw(400)))) * Q.GRID, draw(20_000)
        wrong += (fresh > cut.round()).any(1).mean() > Q.ALPHA + 0.005
    assert wrong <= 0.05 * 300


def test_passages_of_short_and_long_lines_go_whole(spark):
    """Whatever the lengths of its lines and whatever stands around it, a repeated passage of over 50 words is removed."""
    line = lambda name, n, width=4: " ".join(f"{name}{k}".ljust(width, "z") for k in range(n))
    passages = [
        [line("a", 12), line("b", 60)], [line("c", 60), line("d", 12)], [line("e", 30, 8), line("f", 25)], [line("g", 25), line("h", 30, 8)],
        [line("i", 4), line("j", 55), "", line("k", 4)], [line("l", 30), line("m", 30), line("n", 6)], [line("o", 40, 8), line("p", 40, 8), line("q", 9)],
        [line("r", 20), line("s", 20), line("t", 20), line("u", 20)],
    ]
    holders = [(p, d) for d in range(3) for p in range(len(passages))]
    texts = {i: "\n".join([line(f"x{i}_", 9), *passages[p], line(f"y{i}_", 7), line(f"z{i}_", 3)]) for i, (p, _) in enumerate(holders)}
    texts[1000] = "\n".join([line("a", 12), line("other", 60)])  # a short line alone is no passage
    rows = {r.doc_id: r.removed for r in line_dedup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), mixed=True).collect()}
    assert rows.pop(1000) == []
    assert [rows[i] for i in sorted(rows)] == [list(range(1, len(passages[p]) + 1)) if d else [] for p, d in holders]


def test_distrust_reaches_all_that_link_to_a_blocked_host(spark):
    """A farm of many linkers, a linker that is itself linked, and those that mostly link elsewhere or are trusted."""
    link = lambda *hosts: " ".join(f"<a href='http://{h}/es/1'>" for h in hosts)
    pages = [("bad.net/es/1", ""), ("hub.com/", link("backed.org")), ("fine.org/", "")]
    pages += [(f"farm{k}.org/", link("bad.net")) for k in range(300)]
    pages += [("linked.org/", link("bad.net")), ("far.org/", link("linked.org"))]
    pages += [("mixed.org/", link("bad.net", "fine.org", "fine2.org")), ("backed.org/", link("bad.net"))]
    rows = spark.createDataFrame([(i, "http://" + url, html) for i, (url, html) in enumerate(pages)], "page_id long, url string, html string")
    found = {r.host: r.verdict for r in url_filter.judge_pages(rows).collect()}
    blocked = {"bad.net", "linked.org", "far.org", *(f"farm{k}.org" for k in range(300))}
    assert {h for h, v in found.items() if v == "block"} == blocked
    assert {h for h, v in found.items() if v == "allow"} == {"hub.com", "fine.org", "mixed.org", "backed.org"}


@pytest.mark.parametrize("order", [1, -1])
def test_texts_that_share_an_id_are_judged_apart(spark, order):
    """An exact copy of an item beside a text with three words changed, under one id or none; the best of both counts."""
    item = [f"term{k}" for k in range(40)]
    near = [w if k not in (8, 20, 32) else w + "x" for k, w in enumerate(item)]
    rows = [(i, " ".join(t)) for i in (7, None) for t in (item, near)][::order]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, " ".join(item)), (None, " ".join(item))], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.similarity, r.start, r.n_words) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(d, i, 1.0, 0, 40) for d in (7, None) for i in (1, None)}
    # Rows with an id go together; those without are judged one by one.
    assert [(r.doc_id, r.text) for r in decontaminate.without_contaminated(docs, items).collect()] == [(None, " ".join(near))]
