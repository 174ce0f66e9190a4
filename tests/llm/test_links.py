"""Personalised PageRank over host links, and the verdicts drawn from it."""

import numpy as np
import pytest

from parcelflow.llm import url_filter


def linked(*hosts):
    return " ".join(f"<a href='http://{h}/es/1'>" for h in hosts)


def verdicts(spark, pages):
    rows = spark.createDataFrame([(i, "http://" + url, html) for i, (url, html) in enumerate(pages)], "page_id long, url string, html string")
    return {r.host: r.verdict for r in url_filter.judge_pages(rows).collect()}


def dense(n, links, seeds, damping):
    """Power iteration that returns the mass of hosts without links to the seeds."""
    move = np.zeros((n, n))
    for a, b, k in links:
        move[b, a] += k
    out = move.sum(0)
    move[:, out > 0] /= out[out > 0]
    start = seeds / seeds.sum()
    rank = start.copy()
    for _ in range(400):
        rank = damping * (move @ rank + rank[out == 0].sum() * start) + (1 - damping) * start
    return rank


def test_agrees_with_a_dense_power_iteration(spark):
    """A random graph with a hot host, hosts without links and several seeds, walked both ways."""
    draw = np.random.default_rng(1)
    n = 40
    pairs = {(int(a), int(b)) for a, b in draw.integers(0, n - 5, (90, 2)) if a != b} | {(k, 0) for k in range(1, 30)} | {(3, n - 1)}
    links = [(a, b, int(draw.integers(1, 4))) for a, b in sorted(pairs)]
    weights = np.where(draw.random(n) < 0.2, draw.random(n), 0.0)
    weights[7] = 1.0
    seeds = spark.createDataFrame([(f"h{k}", float(w), 1.0) for k, w in enumerate(weights)], "host string, seed double, judged double")
    for way in (links, [(b, a, k) for a, b, k in links]):
        frame = spark.createDataFrame([(f"h{a}", f"h{b}", k) for a, b, k in way], "a string, b string, n long")
        ranks = url_filter.personalised_pagerank(seeds, frame, damping=0.3, reach=0.3, tolerance=1e-11)
        assert ranks.residual <= 1e-11 and 5 < ranks.steps < 30
        got = {r.host: r.score for r in url_filter.scores(ranks).collect()}
        want = dense(n, way, weights, 0.3)
        assert max(abs(got[f"h{k}"] - want[k]) for k in range(n)) < 1e-9
        assert all(0 <= r.part <= 1 for r in ranks.hosts.collect())


def test_no_links_and_no_seeds(spark):
    seeds = spark.createDataFrame([("a", 1.0, 1.0), ("b", 0.0, 1.0)], "host string, seed double, judged double")
    none = spark.createDataFrame([], "a string, b string, n long")
    ranks = url_filter.personalised_pagerank(seeds, none)
    assert (ranks.steps, ranks.residual) == (0, 0.0)
    assert {r.host: r.score for r in url_filter.scores(ranks).collect()} == {"a": 1.0, "b": 0.0}
    one = spark.createDataFrame([("a", "b", 1)], "a string, b string, n long")
    unseeded = url_filter.personalised_pagerank(seeds.selectExpr("host", "0D AS seed", "judged"), one)
    assert {r.score for r in url_filter.scores(unseeded).collect()} == {0.0}
    assert url_filter.personalised_pagerank(seeds.limit(0), none).hosts.count() == 0


@pytest.mark.parametrize("strangers", [0, 9, 200])
def test_unrelated_linkers_do_not_have_a_trusted_host_blocked(spark, strangers):
    pages = [("good.com/", linked("target.org")), ("target.org/", linked("bad.net")), ("bad.net/es/1", "")]
    pages += [(f"stranger{k}.org/", linked("target.org")) for k in range(strangers)]
    found = verdicts(spark, pages)
    assert found["target.org"] == "allow" and found["good.com"] == "allow" and found["bad.net"] == "block"


@pytest.mark.parametrize("farm", [1, 500])
def test_a_farm_is_blocked_at_any_size(spark, farm):
    """So is whoever links to a linker; hosts that link nowhere near are not."""
    pages = [("bad.net/es/1", ""), ("far.org/", linked("farm0.org")), ("clean.org/", linked("other.org"))]
    pages += [(f"farm{k}.org/", linked("bad.net")) for k in range(farm)]
    found = verdicts(spark, pages)
    assert {h for h, v in found.items() if v == "block"} == {"bad.net", "far.org", *(f"farm{k}.org" for k in range(farm))}


def test_a_community_is_not_blocked_for_one_link_of_a_member(spark):
    """Distrust wears off along links between hosts that no rule judges."""
    ring = [(f"m{k}.org/", linked(*(f"m{(k + d) % 12}.org" for d in (1, 2, 5)), *(["bad.net"] if k == 0 else []))) for k in range(12)]
    found = verdicts(spark, [*ring, ("bad.net/es/1", "")])
    assert {h for h, v in found.items() if v == "block"} <= {"bad.net", "m0.org"}


def test_a_host_without_pages_passes_distrust_on(spark):
    """A host known only from links has no links of its own, so nothing flows through it, and it takes no part in a crash."""
    found = verdicts(spark, [("a.org/", linked("unseen.net")), ("b.org/", linked("bad.net", "unseen.net")), ("bad.net/fr/", linked("unseen.net"))])
    assert found == {"a.org": "allow", "b.org": "block", "bad.net": "block"}


def test_verdicts_of_the_whole_table(spark, folder):
    """Host, path, rule and verdict of every page, worked out again row by row."""
    from collections import defaultdict

    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = pages.select("page_id", "url", "html").collect()
    assert not url_filter.host_links(pages.select(url_filter.host_of(pages.url).alias("host"), "html")).count()

    def place(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        tail = rest[cut:]
        end = min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]

    def rule(host, path):
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    votes = defaultdict(list)
    for r in rows:
        host, path = place(r.url)
        votes[host].append(rule(host, path)[1])
    bad = {h for h, v in votes.items() if v.count("block") / len(v) >= 0.5 and v.count("block") > v.count("allow")}
    want = []
    for r in rows:
        host, path = place(r.url)
        name, verdict = rule(host, path)
        want.append((r.page_id, host, path, name, verdict or ("block" if host in bad else "allow")))
    assert sorted(want, key=str) == sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_pages(pages).collect()), key=str)
