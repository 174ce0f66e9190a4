"""Nothing is lost or changed: runs into one target, numbers and characters of JSON, ids and texts that break rules."""

import json
import time

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import outbox, parse, rules, search
from parcelflow.sinks import files


def test_two_runs_add_up(spark, tmp_path):
    for start in (0, 2):
        files.write_batch(spark.range(start, start + 2), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_two_streams_add_up_and_a_restart_does_not(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    for checkpoint in ("a", "b", "a"):
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.option("checkpointLocation", str(tmp_path / checkpoint))
        query = stream.foreachBatch(lambda batch, n: files.write_batch(batch, str(tmp_path / "out"), n)).trigger(availableNow=True).start()
        query.awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 8 and written.select("run").distinct().count() == 2


@pytest.mark.parametrize("text", ['{"z":"hi \U0001f600","a":1.0}', '{"b":0.00001,"a":-0.0}', '{"n":12345678901234567890123}'])
def test_message_text_keeps_order_and_numbers(spark, text):
    frame = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    found = parse.message_text(parse.parse_json(frame)).first().json
    pairs = [json.loads(t, object_pairs_hook=list, parse_float=float, parse_int=str) for t in (found, text)]
    assert pairs[0] == pairs[1]


def test_repeated_key_gives_the_last_value(spark):
    frame = spark.createDataFrame([(bytearray(b'{"a":1,"a":2}'),)], "value binary")
    assert parse.message_text(parse.parse_json(frame)).first().json == '{"a":2}'


@pytest.mark.parametrize("number", ["21.0", "2.5", "7"])
def test_payload_numbers_keep_a_zero_fraction(spark, number):
    frame = spark.createDataFrame([(f'{{"payload":{number}}}',)], "t string")
    assert parse.payload_text(frame, "t").first().payload_text == number


def test_decoded_payload_is_exact(spark):
    frame = spark.createDataFrame([("  hi",), (' {"a":1}',)], "t string").select("t", F.base64(F.col("t").cast("binary")).alias("b"))
    rows = parse.decode_payload(frame, "b").selectExpr("t", "inner_text", "inner IS NOT NULL AS parsed").collect()
    assert all(r.t == r.inner_text for r in rows) and [r.parsed for r in rows] == [False, True]


def test_half_a_character_pair_does_not_end_the_search(spark):
    frame = spark.createDataFrame([('{"k":"\\ud800"}',), ('{"k":"fine"}',)], "t string")
    assert [r.found["value"] for r in search.search_map(frame, "t", "k").collect()] == ["?", "fine"]


def test_backslash_in_an_id(spark):
    ids = spark.createDataFrame([("DOMAIN\\user",), ("dev_1",), ("a\\_b",)], "sourceid string")
    places = spark.createDataFrame([("DOMAIN\\user", "u", 1), ("devx1", "d", 1), ("a_b", "e", 1), ("axb", "no", 2)], "sourceid string, file_uri string, load_seq long")
    assert {r.sourceid: r.file_uri for r in rules.lookup_rule_uri(ids, places).collect()} == {"DOMAIN\\user": "u", "dev_1": "d", "a\\_b": "e"}


def test_answers_stay_after_their_time(spark, tmp_path):
    frame = spark.createDataFrame([("x",)], "u string")

    def slow(request):
        time.sleep(1.5)
        return "answer"

    found = outbox.enrich_cached(frame, slow, F.col("u"), F.lit(""), F.create_map(F.lit("a"), F.lit("b")), str(tmp_path / "cache"), ttl="1 SECOND")
    time.sleep(1.5)
    assert found.first().answer == "answer"
