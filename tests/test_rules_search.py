"""Rule sets, rule look-up and nested search against plain Python."""

import json
import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.operators import lookup, rules as R, search
from parcelflow.schemas import RULE, RULE_LOCATION
from parcelflow.sources.rules import default_rules, read_rule_texts


def rule(ruleset, rule_id, when, salience=0, **params):
    return (ruleset, rule_id, salience, when, "POST", "REST", "http://x", params)


def envelopes(spark, rows):
    return spark.createDataFrame(rows, "messageid string, sourceid string, messagetype string, payload string")


MESSAGES = [("1", "a", "T", "x"), ("2", "b", "T", None), ("3", None, "U", "y"), ("4", "a", "U", "x"), ("5", "A", "T", "x")]
RULES = [
    rule("default", "d1", "messagetype = 'T'", 1, p="1"), rule("default", "d2", "payload IS NULL", 2),
    rule("a", "a1", "payload = 'x'", 5, p="2", q="3"), rule("a", "a2", "messagetype = 'T'", 1), rule("a", "a3", "payload = 'select 1'"),
]
EXPECTED = {("1", "a", "a1"), ("1", "a", "a2"), ("2", "default", "d1"), ("2", "default", "d2"), ("4", "a", "a1"), ("5", "default", "d1")}


@pytest.mark.parametrize("inline", [200, 0])
def test_rules_fire(spark, inline):
    rules = spark.createDataFrame(RULES, RULE)
    chosen = R.select_ruleset(envelopes(spark, MESSAGES), rules)
    fired = R.evaluate_rules(chosen, rules, inline=inline).collect()
    assert {(r.messageid, r.ruleset, r.rule_id) for r in fired} == EXPECTED and len(fired) == len(EXPECTED)
    assert {r.rule_id: r.params for r in fired}["a1"] == {"p": "2", "q": "3"}
    assert {r.rule_id: r.salience for r in fired}["d2"] == 2


@pytest.mark.parametrize("inline", [200, 0])
def test_no_rules(spark, inline):
    rules = spark.createDataFrame([], RULE)
    chosen = R.select_ruleset(envelopes(spark, MESSAGES), rules)
    assert {r.ruleset for r in chosen.collect()} == {"default"}
    assert R.evaluate_rules(chosen, rules, inline=inline).count() == 0


@pytest.mark.parametrize("text", ["payload IN (SELECT 1)", "rand() < 0.5", "current_timestamp() > '2020'", "uuid() = 'x'"])
def test_unstable_conditions_are_refused(text):
    with pytest.raises(ValueError):
        R.predicate(text)


def test_inline_rules_need_no_join(spark):
    rules = default_rules(spark, "r", "i", "b", "s")
    frame = envelopes(spark, MESSAGES).withColumn("ruleset", F.lit("default"))
    plan = plan_of(R.evaluate_rules(frame, rules))
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("inline", [200, 0])
def test_a_value_a_condition_cannot_read_ends_nothing(spark, inline):
    rules = spark.createDataFrame(
        [rule("a", "n", "CAST(payload AS INT) > 1 -- a number"), rule("b", "x", "payload = 'x'"), rule("b", "y", "payload > 1")], RULE)
    rows = [("1", "a", "T", "x"), ("2", "b", "T", "x"), ("3", "a", "T", "7"), ("4", "b", "T", "7"), ("5", "b", "T", None)]
    fired = R.evaluate_rules(R.select_ruleset(envelopes(spark, rows), rules), rules, inline=inline)
    assert sorted((r.messageid, r.rule_id) for r in fired.collect()) == [("2", "x"), ("3", "n"), ("4", "y")]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize("extra", [0, 195, 196, 4995])
def test_catalogue_size_does_not_change_what_fires(spark, extra):
    many = RULES + [rule("a", f"z{n}", f"messagetype = 'none{n}'") for n in range(extra)]
    rules = spark.createDataFrame(many, RULE)
    fired = R.evaluate_rules(R.select_ruleset(envelopes(spark, MESSAGES), rules), rules)
    assert {(r.messageid, r.ruleset, r.rule_id) for r in fired.collect()} == EXPECTED


def test_too_many_conditions_are_refused(spark, monkeypatch):
    monkeypatch.setattr(R, "MOST_CONDITIONS", 2)
    rules = spark.createDataFrame([rule("a", str(n), f"length(payload) = {n}") for n in range(3)], RULE)
    with pytest.raises(ValueError, match="more than 2 conditions"):
        R.evaluate_rules(envelopes(spark, MESSAGES).withColumn("ruleset", F.lit("a")), rules, inline=0)


def test_small_tables_are_broadcast_and_large_ones_salted(spark):
    left = spark.createDataFrame([(n, "hot" if n % 3 == 0 else str(n)) for n in range(300)] + [(999, None)], "n int, k string")
    right = spark.createDataFrame([("hot", 1), ("1", 2), ("unused", 3)], "k string, v int")
    small = lookup.left_lookup(left, right, ["k"])
    large = lookup.left_lookup(left, right, ["k"], rows=2)
    assert "BroadcastHashJoin" in plan_of(small)
    assert not lookup.fits_broadcast(right, rows=2) and not lookup.fits_broadcast(right, size=5) and lookup.fits_broadcast(right)
    assert "_salt" in plan_of(large)
    want = sorted((n, {"hot": 1, "1": 2}.get(k)) for n, k in ((r.n, r.k) for r in left.collect()))
    for joined in (small, large):
        assert joined.columns == ["k", "n", "v"]
        assert sorted((r.n, r.v) for r in joined.collect()) == want


def like(pattern: str, text: str) -> bool:
    import re

    out, n = "", 0
    while n < len(pattern):
        c = pattern[n]
        if c == "\\":
            n += 1
            out += re.escape(pattern[n])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        n += 1
    return re.fullmatch(out, text, re.S) is not None


def test_rule_location_lookup(spark):
    pick = random.Random(5)
    names = sorted({"".join(pick.choice("ab_%") for _ in range(pick.randint(0, 4))) for _ in range(60)})
    places = [(n, f"u{seq}", seq) for seq, n in enumerate(pick.choices(names, k=80))]
    ids = ["".join(pick.choice("ab_%") for _ in range(pick.randint(0, 4))) for _ in range(300)] + ["a\\_b", "\\%", "\\_\\%", "a\\%%", "%\\_%", None]
    locations = spark.createDataFrame(places, RULE_LOCATION)
    found = R.lookup_rule_uri(spark.createDataFrame(list(enumerate(ids)), "n int, sourceid string"), locations)
    assert "CartesianProduct" not in plan_of(found)
    got = {r.n: r.file_uri for r in found.collect()}
    assert len(got) == len(ids)
    for n, pattern in enumerate(ids):
        hits = [] if pattern is None else [(seq, uri) for name, uri, seq in places if like(pattern, name)]
        assert got[n] == (max(hits)[1] if hits else None), pattern


def test_ids_that_share_their_beginning_are_not_compared_with_all(spark):
    """An underscore is a wildcard and common in ids: each id finds its own place by the part that is rare."""
    places = spark.range(1000).selectExpr("format_string('device_%06d', id) AS sourceid", "concat('u', id) AS file_uri", "id AS load_seq")
    found = R.lookup_rule_uri(places.select("sourceid", F.col("file_uri").alias("want")), places)
    assert found.where("file_uri = want").count() == 1000
    kept = R._wildcard_uris(places.select("sourceid"), places)
    assert kept.count() == 1000


def walk(tree, matches):
    """Plain depth-first search: a matching key ends its level, a null result lets the parent go on."""
    for key, value in tree.items():
        if matches(key):
            return value
        if isinstance(value, dict):
            found = walk(value, matches)
            if found is not None:
                return found
    return None


def random_tree(pick, depth):
    def value(level):
        kind = pick.random()
        if level and kind < 0.5:
            return {pick.choice(["k", "kk", "a", "b", "é", "c"]): value(level - 1) for _ in range(pick.randint(0, 4))}
        return pick.choice([None, 1, 2.5, "x", True, [1, {"k": 2}], '{"k":1}', "k"])

    return {pick.choice(["k", "kk", "a", "b", "é", "c"]): value(depth) for _ in range(pick.randint(0, 4))}


@pytest.mark.parametrize("exact", [True, False])
def test_search_random_trees(spark, exact):
    pick = random.Random(11)
    trees = [random_tree(pick, 6) for _ in range(800)]
    frame = spark.createDataFrame([(n, json.dumps(t, ensure_ascii=n % 2 == 0)) for n, t in enumerate(trees)], "n int, j string")
    for key in ("k", "é"):
        find = search.search_map if exact else search.search_map_first_subkey
        got = {r.n: r.found for r in find(frame, "j", key).collect()}
        for n, tree in enumerate(trees):
            want = walk(tree, (lambda name: name == key) if exact else (lambda name: key in name))
            if want is None:
                assert got[n] is None
            else:
                text = want if isinstance(want, str) else json.dumps(want, separators=(",", ":"), ensure_ascii=False)
                assert got[n].value == text


def test_search_cases(spark):
    cases = [
        ('{"a":{"k":null,"z":{"k":1}},"b":{"k":2}}', ("2", "number")),
        ('{"k":null,"b":{"k":2}}', None),
        ('{"b":{"c":{"k":"deep"}},"k":"later"}', ("deep", "string")),
        ('{"a":[{"k":1}]}', None),
        ('{"a":"{\\"k\\":1}"}', None),
        ('{"k":{"b":1,"a":[true]}}', ('{"b":1,"a":[true]}', "object")),
        ('{"\\u006b":[1]} tail', ("[1]", "array")),
        ('{"a":' * 200 + '{"k":true}' + "}" * 200, ("true", "boolean")),
        ("{}", None),
    ]
    frame = spark.createDataFrame([(n, j) for n, (j, _) in enumerate(cases)], "n int, j string")
    got = [r.found for r in search.search_map(frame, "j", "k").orderBy("n").collect()]
    assert [g and (g.value, g.type) for g in got] == [want for _, want in cases]
    assert "Exchange" not in plan_of(search.search_map(frame, "j", "k"))


def test_search_json_reports_what_it_cannot_read(spark):
    frame = spark.createDataFrame([("[1]",), (None,), ('{"k":1}',)], "j string")
    got = [r.found.value for r in search.search_json(frame, "j", "k").collect()]
    assert got[0].startswith("Error retrieving key: 'k' in '[1]'") and got[1].startswith("Error") and got[2] == "1"


def test_rule_texts(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.drl").write_text("rule one\nwhen\nthen\nend")
    (tmp_path / "sub" / "b.drl").write_text("rule two")
    got = {r.name: r.rule for r in read_rule_texts(spark, str(tmp_path), "*.drl").collect()}
    assert got == {"a": "rule one\nwhen\nthen\nend", "b": "rule two"}


def test_rule_text_by_location(spark):
    places = spark.createDataFrame([("a", "rules/a.drl", 1), ("b", "sets/b", 1), ("c", "gone.drl", 1)], "sourceid string, file_uri string, load_seq long")
    texts = spark.createDataFrame([("a", "rule a"), ("b", "rule b"), ("b", "rule b"), ("default", "rule d"), (None, "no name")], "name string, rule string")
    sources = spark.createDataFrame([(s,) for s in ("a", "b", "c", "other", None)], "sourceid string")
    got = {r.sourceid: (r.rule_name, r.rule) for r in R.lookup_rule_text(sources, places, texts).collect()}
    fallback = ("default", "rule d")
    assert got == {"a": ("a", "rule a"), "b": ("b", "rule b"), "c": fallback, "other": fallback, None: fallback}
    assert R.lookup_rule_text(sources, places, texts.where("false")).where("rule IS NULL AND rule_name = 'default'").count() == 5


def test_patterns_over_very_long_locations(spark):
    """Beginnings, ends and parts of 2,000 characters; a location costs numbers in proportion to its length."""
    long = ["ab" * 1000 + str(k) for k in range(40)]
    places = spark.createDataFrame([(p, f"u{k}", k) for k, p in enumerate(long)], "sourceid string, file_uri string, load_seq long")
    patterns = [long[7], long[8][:-1] + "%", "%b39", "ab%b1_", "%" + "ba" * 500 + "%", "a" + "_" * 2000, "ab" * 1001 + "%", "%zz%", "abab%25"]
    found = {r.sourceid: r.file_uri for r in R.lookup_rule_uri(spark.createDataFrame([(p,) for p in patterns], "sourceid string"), places).collect()}
    like = lambda p: [k for k, x in enumerate(long) if re.fullmatch(p.replace("%", ".*").replace("_", "."), x)]
    assert found == {p: f"u{max(like(p))}" if like(p) else None for p in patterns}


def test_a_table_repeated_per_salt_is_not_broadcast(spark):
    """Its copies are not in the planner's estimate; the rows are those of the plain join, keys that are null included."""
    from conftest import plan_of

    from parcelflow.operators.lookup import left_lookup

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "id int, k string")
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    met = left_lookup(rows, table, ["k"], rows=1)
    assert "BroadcastHashJoin" not in plan_of(met)
    assert sorted((r.id, r.v) for r in met.collect()) == [(1, 1), (2, 2), (3, None), (4, None)]
