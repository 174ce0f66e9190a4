"""Operators against brute force over whole small tables."""

import collections
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelflow.llm import queries
from parcelflow.llm.encode import Encoder, tokenizer_file
from parcelflow.llm.near_dedup import signatures
from parcelflow.llm.quality_rules import upper_bound
from parcelflow.llm.sharding import difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(folder):
    return pd.read_parquet(f"{folder}/documents.parquet")


def test_op1(spark, folder, docs):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(s[::-1])) % 10 == 0
    found = queries.op1_pii(spark, folder).toPandas().set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text):
        base = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
                if good:
                    base.append(f"{kind}:{m.start()}:{m.end()}")
        assert set(base) <= set(found.loc[i].spans.split(","))  if base else True
        assert found.loc[i][["n_email", "n_ip", "n_card", "n_phone"]].sum() == len(base)


def test_op2_and_op9(spark, folder, docs):
    tokenizer, start, lengths = Tokenizer.from_file(tokenizer_file()), 0, []
    found = queries.op9_token_files(spark, folder).toPandas().set_index("doc_id")
    for i, text in docs.sort_values("doc_id")[["doc_id", "text"]].itertuples(index=False):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert tuple(found.loc[i]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        lengths.append(len(ids) - 1)
    lengths = np.array(lengths)
    for r in queries.op2_token_counts(spark, folder).collect():
        long = lengths >= r.n_tokens
        assert (r.docs_at_least, r.tokens_at_least, r.tokens_within) == (long.sum(), lengths[long].sum(), np.minimum(lengths, r.n_tokens).sum())


def test_pieces_give_the_ids_of_whole_texts():
    rng, path = np.random.default_rng(3), tokenizer_file()
    alphabet = np.array(list("ab  \n\t 　\x1c\x01é\U0001f6001'"))
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 30))) + ["", "<|endoftext|> a"][k % 7 == 0] for k in range(2000)]
    ids, counts = Encoder(path)(texts)
    whole = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for t in whole for i in t] and counts.tolist() == [len(t) for t in whole]


def test_op4(spark, folder, docs):
    found = queries.op4_mixing(spark, folder).toPandas().merge(docs[["doc_id", "source", "text"]], on="doc_id")
    assert (found["size"] == [len(WORD.findall(t or "")) for t in found.text]).all()
    by = found.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    weights = pd.Series([1 + k % 3 for k in range(len(by))], by.index)
    target, free = pd.Series(0.0, by.index), pd.Series(True, by.index)
    for _ in range(len(by)):  # share again until none is above its cap
        rest = by["size"].sum() - target[~free].sum()
        target[free] = rest * weights[free] / weights[free].sum()
        over = free & (target > 3 * by["size"])
        if not over.any():
            break
        target[over], free[over] = 3.0 * by["size"][over], False
    assert np.allclose(by.target, target) and (abs(by.taken - by.target) <= by.most / 2 + 1).all()
    assert (found.taken <= 3 * found["size"]).all()


def test_op6(spark, folder, docs):
    plain = lambda t: [w for w in re.sub(r"[\W_]+", " ", t.lower()).strip().split(" ") if w]
    runs = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    items = {i: plain(t) for i, t in pd.read_parquet(f"{folder}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False)}
    index = collections.defaultdict(set)
    for i, w in items.items():
        for g in runs(w):
            index[g].add(i)
    expected = {}
    for d, text in zip(docs.doc_id, docs.text):
        w = plain(text or "")
        s = runs(w)
        for i in set().union(*(index.get(g, ()) for g in s)):
            item, length = collections.Counter(runs(items[i])), len(items[i])
            best = 0
            for start in range(max(1, len(w) - length + 1)):
                window = collections.Counter(s[start : start + length - 4])
                best = max(best, (window & item).total() / (window | item).total())
            if best >= 0.8:
                expected[d, i] = round(best, 9)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in queries.op6_decontaminate(spark, folder).collect()} == expected


def test_op8(spark, folder):
    found = queries.op8_sharding(spark, folder).toPandas()
    by = found.groupby("shard").agg(bytes=("size", "sum"), n=("slot", "count"), last=("slot", "max"), slots=("slot", "nunique"))
    assert (by.n == by["last"] + 1).all() and (by.n == by.slots).all() and found.groupby("text_crc32")["shard"].nunique().max() == 1


def test_differencing_places_what_it_totals():
    sizes = np.random.default_rng(1).integers(1, 10_000, 500)
    parts = np.zeros((500, 40), np.int64)
    parts[:, 0] = sizes
    totals, shards = difference(parts)
    assert sorted(np.bincount(shards[:, 0], sizes, 40)) == sorted(totals) and totals.max() - totals.min() <= 0.01 * totals.mean()


def test_op10(spark, folder, docs):
    found = queries.op10_quality_rules(spark, folder).toPandas().set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text):
        words = WORD.findall(text or "")
        places, covered = collections.defaultdict(list), set()
        for k in range(len(words) - 7):
            places[tuple(words[k : k + 8])].append(k)
        for at in places.values():
            if len(at) > 1:
                covered.update(x for k in at for x in range(k, k + 8))
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        row = found.loc[i]
        assert tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == expected
        assert row.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words)) and not (row.base_failed and row.kept)


def test_exact_binomial_bound():
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100)) and upper_bound(5, 5, 0.05) == 1.0
    assert upper_bound(5, 100, 0.05) == pytest.approx(0.1023, abs=1e-3)


def test_signature_distance_follows_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    other = np.r_[base[:1700], rng.integers(0, 2**63, 150, dtype=np.uint64)]
    one, two = signatures([np.unique(base), np.unique(other)])
    assert (one != two).sum() <= 15


@pytest.mark.parametrize("mixed", [False, True])
def test_line_dedup_against_brute_force(spark, mixed):
    """Chunks and runs found by plain Python; boundaries by hash are the operator's own."""
    import random

    from parcelflow.llm import line_dedup as L

    draw = random.Random(5)
    line = lambda n: " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(10**6)}" for _ in range(n))
    passages = [[line(26), line(25)], [line(18) for _ in range(3)], [line(9), "", *[line(9) for _ in range(6)]], [line(60)], [" ".join("a" * 1 for _ in range(51))]]
    texts = {}
    for d in range(60):
        lines = [line(draw.choice([2, 7, 15, 40])) for _ in range(draw.randrange(1, 9))]
        for p in draw.sample(range(len(passages)), draw.randrange(3)):
            at = draw.randrange(len(lines) + 1)
            lines[at:at] = passages[p]
        texts[d] = "\n".join(lines)
    texts.update({60: "\n".join(["x y z " * 3] * 40), 61: texts[7], 62: "", 63: "one\ntwo"})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    starts = {r[0]: r[1] for r in docs.select("doc_id", L.chunk_starts(F.split("text", "\n"))).collect()}

    places = {}
    for d, text in texts.items():
        lines = text.split("\n")
        spans = {(a, b) for a, b in zip(starts[d], [*starts[d][1:], len(lines)])}
        for a in range(len(lines)):
            words, b = 0, a
            while lines[a].split() and b < len(lines) and words <= L.MASS and (mixed or len(lines[b]) < L.LONG_LINE):
                words, b = words + len(lines[b].split()), b + 1
            if words > L.MASS:
                spans.add((a, b))
            words, b = 0, a + 1
            while mixed and lines[a].split() and b and words <= L.MASS:
                words, b = words + len(lines[b - 1].split()), b - 1
            if words > L.MASS:
                spans.add((b, a + 1))
        for a, b in spans:
            body = "\n".join(lines[a:b])
            if body.strip() and (b - a > 1 or len(body) >= L.LONG_LINE or len(body.split()) > L.MASS):
                places.setdefault(body, []).append((d, a, b))
    gone = {d: set() for d in texts}
    for found in places.values():
        first, *others = sorted(found)
        for d, a, b in others:
            if d != first[0] or a >= first[2]:
                gone[d].update(range(a, b))
    rows = {r.doc_id: r for r in L.dedup_lines(docs, mixed=mixed).collect()}
    assert {d: set(r.removed) for d, r in rows.items()} == gone
    for d, r in rows.items():
        assert r.text == "\n".join(x for k, x in enumerate(texts[d].split("\n")) if k not in gone[d])
    for passage in passages:
        holders = [d for d, text in texts.items() if "\n".join(passage) in text]
        assert len(holders) > 2
        assert [d for d in holders if "\n".join(passage) in rows[d].text] == holders[:1]
    # What is removed stays somewhere.
    left = {x for r in rows.values() for x in r.text.split("\n")}
    assert all(texts[d].split("\n")[k] in left for d in gone for k in gone[d])
