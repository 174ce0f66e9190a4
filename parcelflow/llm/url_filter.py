"""URL rules, and personalised PageRank of trust and distrust over links between hosts.

Trust teleports to hosts by the share of their pages that the rules allow, and flows
along links; distrust teleports to hosts by the share that the rules block, and flows
against links, to the hosts that link there. Both are PageRank vectors: a host hands
`DAMPING` of its mass on, divided over its links. So a blocked host's mass is divided
by its fan-in, and no fixed limit on mass means the same everywhere. What is held against
`LIMIT` is relative mass: a host's received distrust as a part of what it would receive
if every judged host were a blocked one. Judged are hosts with a rule of their own and
hosts without links; the others are what their links make them, and each of them on
the way costs the factor ``DAMPING / REACH``. A host is blocked when that part, or
its own share of blocked pages, reaches `LIMIT` and its distrust is above its trust.
Unrelated hosts that link to a host change neither of its masses.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import shared_folder
from .common import stored

# The rules as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Distrust handed on over two links is 0.55 of what it could be, over three 0.41.
DAMPING, REACH, LIMIT = 0.63, 0.85, 0.5
#: The walk ends when what all later steps could add, over all hosts together, is at most this part of all mass.
TOLERANCE = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ATTRIBUTE = r"""(?i)(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s<>]*)"""


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "/", 1)).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null when none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(a, b, n): links of pages of `host` to other hosts, counted per page before they are shuffled."""
    targets = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_ATTRIBUTE), 1))
    url = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = pages.select(F.col("host").alias("a"), F.explode(targets).alias("url")).select("a", host_of(url).alias("b"))
    return links.where("a != '' AND b != '' AND a != b").groupBy("a", "b").agg(F.count("*").alias("n"))


class Ranks(NamedTuple):
    """Masses by host, and how far they can be from the limit of endless steps."""

    hosts: DataFrame  # host, seed, mass, received, part
    residual: float  # at most this part of all mass is missing
    steps: int


def personalised_pagerank(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, reach: float = REACH, tolerance: float = TOLERANCE) -> Ranks:
    """Mass that teleports to `seeds` (host, seed, judged: 0 to 1) and walks along `links` (a, b, n).

    `seeds` holds every host once. `mass` is a host's personalised PageRank up to one
    factor for all hosts: mass at hosts without links returns to the seeds, which
    multiplies the whole vector and is left to `scores`. `received` is mass less the
    host's own teleport. `part` is `received` over what would be received from
    `judged` in place of `seed`, handed on by `reach` and only as far as the next judged
    host; at most 1, and 0 where nothing is received.

    The vector is the sum of what arrives after 0, 1, 2 … links, so a step is one
    join and one aggregation over what arrived in the step before, written to
    the shared folder. Mass into a host that very many link to is summed before
    the shuffle; a host with very many links is left to the join's skew handling.
    """
    spark = seeds.sparkSession
    out = links.groupBy("a").agg(F.sum("n").alias("out")).join(seeds.select(F.col("host").alias("a"), (F.col("judged") > 0).alias("ends")), "a")
    share = stored(links.join(out, "a").select("a", "b", (F.col("n") / F.col("out")).alias("share"), "ends"), "shares")
    root = shared_folder(spark, "llm-ranks")
    shape = "host string, mass double, every double"
    start = F.lit(1 - damping)
    arrived, step, totals = seeds.select("host", (start * F.col("seed")).alias("mass"), (start * F.col("judged")).alias("every")), 0, [0.0, 0.0]
    while True:
        seen = Observation()
        arrived.observe(seen, F.sum("mass").alias("mass"), F.sum("every").alias("every")).write.parquet(f"{root}/step={step}")
        now = [seen.get[m] or 0.0 for m in ("mass", "every")]
        totals = [t + n for t, n in zip(totals, now)]
        # What all later steps together can add at most.
        residual = max(n * d / (1 - d) / t if t else 0.0 for n, d, t in zip(now, (damping, reach), totals))
        if step == 0 and share.isEmpty():
            residual = 0.0
        if residual <= tolerance:
            break
        onward = F.when(F.col("ends"), 0.0).otherwise(F.col("every")) if step else F.col("every")
        before, step = spark.read.schema(shape).parquet(f"{root}/step={step}"), step + 1
        arrived = before.join(share, F.col("host") == F.col("a")).groupBy(F.col("b").alias("host")).agg(
            (damping * F.sum(F.col("mass") * F.col("share"))).alias("mass"), (reach * F.sum(onward * F.col("share"))).alias("every"))
    later = lambda m: F.coalesce(F.sum(F.when(F.col("step") > 0, F.col(m))), F.lit(0.0))
    sums = spark.read.schema(f"{shape}, step int").parquet(root).groupBy("host").agg(
        F.sum("mass").alias("mass"), later("mass").alias("received"), later("every").alias("_every"))
    part = F.when(F.col("_every") > 0, F.least(F.lit(1.0), F.col("received") / F.col("_every"))).otherwise(0.0)
    return Ranks(stored(seeds.join(sums, "host").select("host", "seed", "mass", "received", part.alias("part")), "ranks"), residual, step)


def scores(ranks: Ranks) -> DataFrame:
    """(host, score): the probabilities of personalised PageRank, 0 throughout without seeds."""
    total = ranks.hosts.agg(F.sum("mass")).first()[0] or 1.0
    return ranks.hosts.select("host", (F.col("mass") / total).alias("score"))


def judge_pages(pages: DataFrame, rules: tuple = RULES, limit: float = LIMIT) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path; the empty
    host has no links and no rule, and its pages are allowed. A null html holds
    no links. Repeated rows count again in a host's shares, which they leave
    as they are. An empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    placed = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = placed.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    links = stored(host_links(placed), "links")
    kind = lambda v: F.avg((F.coalesce(F.col("own.verdict"), F.lit("")) == v).cast("double"))
    linked = links.select(F.col("b").alias("host")).distinct()
    seen = ruled.groupBy("host").agg(kind("allow").alias("allow"), kind("block").alias("block"))
    hosts = stored(seen.join(linked, "host", "full").select("host", F.coalesce("allow", F.lit(0.0)).alias("allow"), F.coalesce("block", F.lit(0.0)).alias("block")), "hosts")
    trust = personalised_pagerank(hosts.select("host", F.col("allow").alias("seed"), F.col("allow").alias("judged")), links).hosts.select("host", F.col("mass").alias("trust"))
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    linkers = links.select(F.col("a").alias("host")).distinct().withColumn("links", F.lit(True))
    judged = F.when((F.col("allow") > 0) | (F.col("block") > 0) | F.col("links").isNull(), 1.0).otherwise(0.0)
    distrust = personalised_pagerank(hosts.join(linkers, "host", "left").select("host", F.col("block").alias("seed"), judged.alias("judged")), back).hosts
    bad = distrust.where(F.greatest("seed", "part") >= limit).join(trust, "host").where("mass > trust").select(F.col("host").alias("_host"))
    final = ruled.select("page_id", "host", "path", "own").join(stored(bad, "blocked"), F.col("host") == F.col("_host"), "left")
    method = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return final.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce(F.col("own.verdict"), method).alias("verdict"))
