"""Quality rules whose cutoffs come from labelled holdouts with a bound on false rejections.

A rule rejects a document when its score is above a cutoff. Cutoffs are multiples of
``1 / GRID``, chosen for every stratum (language) such that, at the confidence
``1 - DELTA`` for all strata together, at most `ALPHA` of its good documents are
rejected by any rule (exact Clopper-Pearson bounds of the rate). Two ways are tried:

- All rules are tightened together along one path, and the documents that any of
  them rejects are tested against `ALPHA`. The path ends at its first failure, so its
  tests share one risk, and few labels suffice: 61 in one stratum, 88 in each of four.
- Every rule is tightened alone against its part of `ALPHA`. That takes ten times the
  labels, but a rule that good documents often break does not hold up the others.

The risk is split between the two, so that either may be used: the one whose cutoffs
are lower in sum. A stratum whose labels are too few for any test rejects nothing and
takes no part of the risk.

A path must not depend on the labels that are tested along it. Good labels are dealt to
two halves by a hash of the id: the first decides how far each rule is ahead on its
stratum's path, only the second is tested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WordHashes, let, slices, stored

ALPHA, DELTA = 0.05, 0.05
#: Cutoffs tried: multiples of 1 / GRID of a score between 0 and 1.
GRID = 50
RULES = ("symbols", "duplicates", "repeats", "short", "long")
#: Steps by which a rule is ahead on the path of a stratum that has no labels in the ordering half.
LEAD = (0, 0, 0, 0, 0)
#: The common path's part of the risk; the rules alone share the rest.
TOGETHER = 0.9
#: Strata beyond this many are joined instead of broadcast.
BROADCAST_STRATA = 20_000
WINDOW = 8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes], hashes: WordHashes, width: int = WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = hashes.of(words)
    value = np.zeros(n, np.uint64)
    for k in range(width):
        value = (value ^ ids[k : k + n]) * _MIX
        value ^= value >> np.uint64(29)
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def measure(text: bytes | None, hashes: WordHashes) -> tuple[int, ...]:
    """The measures of one whole text, in the order of `MEASURES`."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    codes = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[codes] & ((codes & 0xC0) != 0x80)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), int(inside.sum()), int(_SYMBOL[codes].sum()), len(lines) - len(set(lines)),
        repeated_words(words, hashes), len(lines),
    )


def own_id(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells rows without an id apart: a hash of their text; null for rows with an id."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, own (see `own_id`), stratum and the measures of each row's whole text; a null text has zeros."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            found = [measure(t, hashes) for t in batch.column("text").to_pylist()]
            values = [pa.array(v, pa.int64()) for v in zip(*found)]
            known = [batch.column(name) for name in ("doc_id", "own", "stratum")]
            yield pa.RecordBatch.from_arrays([*known, *values], ["doc_id", "own", "stratum", *MEASURES])

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), own_id(id_col, text_col).alias("own"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(rows, "doc_id long, own long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES))


def scored(measured: DataFrame) -> DataFrame:
    """Adds base_failed and `scores`, a number from 0 (good) to 1 per rule."""
    part = lambda a, b: F.when(F.col(b) > 0, F.least(F.lit(1.0), F.col(a) / F.col(b))).otherwise(0.0)
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scores = (
        part("n_symbols", "n_words"), part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words"),
        F.when(F.col("n_words") > 0, F.greatest(F.lit(0.0), 1 - mean / 4)).otherwise(1.0),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), (mean - 8) / 24)),
    )
    return measured.withColumns({"base_failed": base, "scores": F.array(*[s.cast("double") for s in scores])})


def upper_bound(rejected: int, n: int, risk: float) -> float:
    """The exact upper confidence bound of a rate, `rejected` of `n` seen, at confidence ``1 - risk``."""
    if rejected >= n:
        return 1.0
    low, high = rejected / n, 1.0
    for _ in range(50):
        p = (low + high) / 2
        if _at_most(rejected, n, p) > risk:
            low = p
        else:
            high = p
    return high


def _at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial."""
    i = np.arange(k + 1)
    logs = np.r_[0.0, np.cumsum(np.log(n - i[:-1]) - np.log(i[:-1] + 1))] + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(np.exp(logs - logs.max()).sum() * math.exp(logs.max()))


def labels_needed(alpha: float, risk: float) -> int:
    """Good labels without which no test can pass: those that show `alpha` when none is rejected."""
    return math.ceil(math.log(risk) / math.log1p(-alpha))


def _walk(counts: np.ndarray, start: int, alpha: float, risk: float) -> int:
    """From the laxest step down, each tested at `risk`: the last that passes before the first that fails, `start` when none does."""
    n, best = int(counts.sum()), start
    above = n - np.cumsum(counts)
    while n and best and upper_bound(int(above[best - 1]), n, risk) <= alpha:
        best -= 1
    return best


def leads(seen: pd.DataFrame, alpha: float = ALPHA) -> list[int]:
    """Steps by which each rule is ahead on a stratum's path, from the histogram (rule, step, n) of the ordering half.

    The path goes through the steps at which every rule alone rejects at most half its
    part of `alpha`, so that all rules reach the place where good documents begin to break them together.
    """
    counts = np.zeros((len(RULES), GRID + 1), np.int64)
    np.add.at(counts, (seen["rule"].to_numpy(), seen["step"].to_numpy()), seen["n"].to_numpy())
    n = counts.sum(1, keepdims=True)
    safe = (n - np.cumsum(counts, 1) <= alpha / (2 * len(RULES)) * n).argmax(1)
    return (safe.max() - safe).tolist()


def choose(seen: pd.DataFrame, alpha: float = ALPHA, delta: float = DELTA, lead: Sequence[int] = LEAD) -> list[float]:
    """Cutoffs of one stratum at the risk `delta`, from its good labels' histogram (rule, step, n): a cutoff per rule, 1 when none is safe.

    The rule after the last is the common path of these `lead` steps (see `path_step`).
    """
    top = GRID + int(max(lead))
    counts = np.zeros((len(RULES) + 1, top + 1), np.int64)
    np.add.at(counts, (seen["rule"].to_numpy(), seen["step"].to_numpy()), seen["n"].to_numpy())
    at = _walk(counts[-1], top, alpha, TOGETHER * delta)
    together = [min(GRID, max(0, at - int(ahead))) for ahead in lead]
    alone = [_walk(own[: GRID + 1], GRID, alpha / len(RULES), (1 - TOGETHER) * delta / len(RULES)) for own in counts[:-1]]
    return [step / GRID for step in min(together, alone, key=sum)]


def path_step(steps: Column, lead: Column) -> Column:
    """The lowest step of the common path at which no rule rejects a document of these grid steps.

    At a step, a rule's cutoff is as many grid steps lower as the rule is ahead, 0 at least.
    """
    return F.array_max(F.zip_with(steps, lead, lambda s, ahead: F.when(s > 0, s + ahead).otherwise(0)))


def cutoffs(scores: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per stratum: the cutoffs of the rules, from all labelled good documents that pass the base rules.

    One half of them orders the paths, the other is tested. Good labels become
    counts per stratum, rule and grid step before they are shuffled, so a stratum
    is a few hundred rows however many labels it has.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    steps = F.transform("scores", lambda s: F.ceil(s * GRID).cast("int"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    marked = stored(scores.where("NOT base_failed").join(good, "doc_id").select("stratum", half, steps.alias("steps")), "good")

    def order(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "lead": [leads(frame, alpha)]})

    first = marked.where("half = 0").select("stratum", F.posexplode("steps").alias("rule", "step")).groupBy("stratum", "rule", "step").agg(F.count("*").alias("n"))
    paths = stored(first.groupBy("stratum").applyInPandas(order, "stratum string, lead array<int>"), "paths")
    few = paths.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    second = marked.where("half = 1").join(F.broadcast(paths) if few else paths, "stratum", "left")
    second = second.withColumn("lead", F.coalesce("lead", F.array(*[F.lit(x) for x in LEAD])))
    on_path = F.concat("steps", F.array(path_step(F.col("steps"), F.col("lead"))))
    flat = second.select("stratum", "lead", F.posexplode(on_path).alias("rule", "step"))
    seen = stored(flat.groupBy("stratum", "lead", "rule", "step").agg(F.count("*").alias("n")), "tested")
    enough = F.col("n") >= labels_needed(alpha, TOGETHER * delta)
    strata = seen.where("rule = 0").groupBy("stratum").agg(F.sum("n").alias("n")).where(enough).count()

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "cutoffs": [choose(frame, alpha, delta / max(1, strata), frame["lead"].iloc[0])]})

    return seen.groupBy("stratum").applyInPandas(pick, "stratum string, cutoffs array<double>")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row of `docs`: doc_id, own (see `own_id`), stratum, the measures, base_failed, kept.

    A null, empty or blank text has no words and fails the base rules. A null
    stratum is a stratum of its own. Repeated rows are judged alike. Without
    labels only the base rules reject.
    """
    scores = stored(scored(measures(docs, id_col, text_col, stratum_col)), "measures")
    found = stored(cutoffs(scores, labels, alpha, delta), "cutoffs")
    small = found.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    with_cutoffs = scores.join(F.broadcast(found) if small else found, "stratum", "left")
    over = F.exists(F.arrays_zip("scores", "cutoffs"), lambda z: F.ceil(z["scores"] * GRID) > F.round(z["cutoffs"] * GRID))
    return with_cutoffs.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))).drop("scores", "cutoffs")
