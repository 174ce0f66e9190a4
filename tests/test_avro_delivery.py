"""Avro, requests, delivery, cached look-ups and sinks."""

import contextlib
import io
import json
import os
import re
import uuid

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.functions import avro as A
from parcelflow.operators import avro, outbox as O, outcome, parse as P, standardise as S
from parcelflow.plans.queries import QUERIES
from parcelflow.schemas import ENVELOPE, ENVELOPE_AVRO, MESSAGE, REMOTE_REQUEST, REMOTE_REQUEST_AVRO
from parcelflow.sinks import files, tables, topics


def number(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def text(s: str) -> bytes:
    return number(len(s.encode())) + s.encode()


REQUEST = ("a/light", "POST", -7, '{"value":true}', "98", "54919CA5", "")


def request_bytes(r) -> bytes:
    return b"".join(number(v) if isinstance(v, int) else text(v) for v in r)


ENVELOPES = [
    ("m1", "device1", None, REQUEST, "2016", "REGISTRY_POST"),
    ("m2", "é", "x" * 63, None, "", "T"),
    ("m3", "s", "y" * 64, None, "2016", "T"),
    ("m4", "s", "z" * 9000, REQUEST[:2] + (2147483647,) + REQUEST[3:], "2016", "T"),
    ("m5", "s", "ü" * 1_100_000, REQUEST[:2] + (-2147483648,) + REQUEST[3:], "2016", "T"),
]


def envelope_bytes(e) -> bytes:
    payload = b"\x00" if e[2] is None else b"\x02" + text(e[2])
    request = b"\x00" if e[3] is None else b"\x02" + request_bytes(e[3])
    return text(e[0]) + text(e[1]) + payload + request + text(e[4]) + text(e[5])


def test_encode_and_decode(spark):
    frame = spark.createDataFrame(ENVELOPES, ENVELOPE).select("messageid", F.struct(*ENVELOPE.names).alias("e"))
    encoded = avro.encode_avro(frame, "e", ENVELOPE_AVRO)
    got = {r.messageid: bytes(r.value) for r in encoded.collect()}
    assert got == {e[0]: envelope_bytes(e) for e in ENVELOPES}
    back = avro.decode_avro(encoded.select("value"), "value", ENVELOPE_AVRO).select("envelope.*")
    assert back.schema == ENVELOPE or back.schema.simpleString() == ENVELOPE.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, spark.createDataFrame(ENVELOPES, ENVELOPE).collect()))


def test_missing_required_field_is_not_encoded(spark):
    frame = spark.createDataFrame([(None, "s", None, None, "d", "T")], ENVELOPE).select(F.struct("*").alias("e"))
    assert avro.encode_avro(frame, "e", ENVELOPE_AVRO).first().value is None


def test_bad_bytes_give_null(spark):
    good = envelope_bytes(ENVELOPES[0])
    rows = [b"", good[:10], b"\xff" * 20, b"\x02", good, None, good[:3] + b"\x99" + good[4:]]
    frame = spark.createDataFrame([(n, None if b is None else bytearray(b)) for n, b in enumerate(rows)], "n int, v binary")
    got = avro.decode_avro(frame, "v", ENVELOPE_AVRO).orderBy("n").collect()
    assert [r.envelope is not None for r in got[:6]] == [False, False, False, False, True, False]


def test_older_shape_with_enum(spark):
    """Layout of a captured message: id, source, payload, type as a number, date."""
    schema = json.dumps({"type": "record", "name": "M", "fields": [
        {"name": "messageid", "type": "string"}, {"name": "sourceid", "type": "string"}, {"name": "payload", "type": "string"},
        {"name": "messagetype", "type": {"type": "enum", "name": "E", "symbols": ["A", "B", "TELEMETRY"]}},
        {"name": "createdate", "type": "string"}]})
    payload = "just testing a sentence " * 6
    data = text("49519eb2-8e40-4d59-ae51-63022c1c2690") + text("yaima") + text(payload) + b"\x04" + text("Sep 6, 2016")
    assert data[0] == 72 and data[37] == 10
    frame = spark.createDataFrame([(bytearray(data),)], "v binary")
    row = json.loads(avro.decode_avro_as_json(frame, "v", schema).first().json)
    assert (row["sourceid"], row["payload"], row["messagetype"], row["createdate"]) == ("yaima", payload, "TELEMETRY", "Sep 6, 2016")
    again = avro.encode_avro(avro.decode_avro(frame, "v", schema, "e"), "e", schema, "back").first()
    assert bytes(again.back) == data


def test_request_alone(spark):
    frame = spark.createDataFrame([REQUEST], REMOTE_REQUEST).select(F.struct("*").alias("r"))
    assert bytes(avro.encode_avro(frame, "r", REMOTE_REQUEST_AVRO).first().value) == request_bytes(REQUEST)




def fired(spark, rows):
    data = [(e, "default", "r", 1, action, channel, "http://u", params) for e, action, channel, params in rows]
    schema = f"e {ENVELOPE.simpleString()}, ruleset string, rule_id string, salience int, action string, channel string, target string, params map<string,string>"
    return spark.createDataFrame(data, schema).select("e.*", "ruleset", "rule_id", "salience", "action", "channel", "target", "params")


def test_outbox(spark):
    with_header = ("m6", "s", None, REQUEST[:6] + ('{"API-KEY": "0","Content-Type": "application/json"}',), "d", "T")
    with_text = ("m7", "s", None, REQUEST[:6] + ("hub-request",), "d", "T")
    get = ("m8", "s", "owners/143", None, "d", "REGISTRY_GET")
    rows = [
        (with_header, "POST", "REST", {}), (with_text, "PUT", "REST", {}), (get, "GET", "REST", {}),
        (with_text, "PUBLISH", "MQTT", {"clientId": "c", "qos": "2", "schema": "registry"}),
        (get, "PUBLISH", "MQTT", {"schema": "registry"}), (get, "POST", "ES", {"path": "events", "header": '{"a":"b"}'}),
    ]
    post, put, got, mqtt, mqtt_plain, index = O.build_outbox(fired(spark, rows)).collect()
    assert post.headers == {"API-KEY": "0", "Content-Type": "application/json"} and post.path == "a/light" and post.method == "POST"
    assert json.loads(post.body)["registrypayload"]["payload"] == '{"value":true}'
    assert put.headers == {"header": "hub-request"}
    assert (got.path, got.body, got.headers) == ("owners/143", None, {})
    assert mqtt.headers == {"clientId": "c", "qos": "2"} and json.loads(mqtt.body)["verb"] == "POST" and mqtt.schema_ref == "registry"
    assert mqtt_plain.body == "owners/143"
    assert (index.path, index.headers) == ("events", {"a": "b"})


def test_delivery_records_one_result_per_request(spark):
    def send(request):
        if request["path"] == "owners/143":
            raise RuntimeError("no route")
        return "sent " + request["messageid"]

    rows = [(ENVELOPES[0], "POST", "REST", {}), (("m8", "s", "owners/143", None, "d", "G"), "GET", "REST", {})]
    requests = O.build_outbox(fired(spark, rows))
    for partitions in (None, 3):
        got = {r.messageid: r.result for r in O.deliver(requests, send, partitions).collect()}
        assert got == {"m1": "sent m1", "m8": "EXCEPTION_no route"}


def test_answers_are_reused_until_they_are_old(spark, tmp_path):
    asked = str(tmp_path / "asked")
    os.mkdir(asked)

    def look_up(request):
        import uuid

        open(os.path.join(asked, uuid.uuid4().hex), "w").close()
        if request["url"] == "bad":
            raise ValueError("no")
        return f"{request['url']}|{request['data']}|{sorted(request['attr'].items())}"

    rows = [("u1", None, {"a": "1", "b": "2"}), ("u1", None, {"b": "2", "a": "1"}), ("u1", "d", {}), ("bad", None, {}), ("u1", None, {"a": "1", "b": "2"})]
    frame = spark.createDataFrame(rows, "url string, data string, attr map<string,string>")

    def enrich(clock):
        now = F.lit(clock).cast("timestamp")
        out = O.enrich_cached(frame, look_up, F.col("url"), F.col("data"), F.col("attr"), str(tmp_path / "cache"), now=now)
        return sorted(r.answer for r in out.collect())

    first = enrich("2024-01-01 00:00:00")
    assert first == sorted(["EXCEPTION_no"] + ["u1|None|[('a', '1'), ('b', '2')]"] * 3 + ["u1|d|[]"])
    assert len(os.listdir(asked)) == 3
    assert enrich("2024-01-01 00:30:00") == first
    assert len(os.listdir(asked)) == 4  # only the failed one again
    assert enrich("2024-01-01 02:00:00") == first
    assert len(os.listdir(asked)) == 7


def messages(spark):
    rows = [
        ("t", 0, 1, "2024-01-01 23:59:59", "k1", bytearray(b'{"messagetype":"A","payload":"1"}')),
        ("t", 0, 2, "2024-01-02 00:00:01", None, bytearray(b"bad\xff")),
    ]
    loose = "topic string, partition int, offset bigint, timestamp string, key string, value binary"
    return spark.createDataFrame(rows, loose).withColumn("timestamp", F.to_timestamp("timestamp")).to(MESSAGE)


def test_archives_replace_a_repeated_batch(spark, tmp_path):
    root = str(tmp_path)
    for batch in (0, 1, 1):
        path = files.archive_raw(messages(spark), root, "app", batch)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    assert {(str(r.day), bytes(r.value)) for r in stored.collect()} == {
        ("20240101", b'{"messagetype":"A","payload":"1"}'), ("20240102", b"bad\xff")}
    lines = files.archive_raw(messages(spark), root, "text", 0, "text")
    assert {r.value for r in spark.read.text(lines).collect()} == {
        '2024-01-01 23:59:59 | k1 | {"messagetype":"A","payload":"1"}', "2024-01-02 00:00:01 |  | bad�"}


def test_publish_and_errors(spark, tmp_path):
    built = S.standardise(P.parse_json(messages(spark)))
    good, bad = outcome.split_errors(built)
    for _ in range(2):
        topics.publish(messages(spark), "out", str(tmp_path / "topic"), 7)
        files.write_errors(bad, str(tmp_path / "errors"), 7)
    assert spark.read.parquet(str(tmp_path / "topic")).where("topic = 'out'").count() == 2
    stored = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert [(r.stage, bytes(r.value)) for r in stored] == [("PARSE", b"bad\xff")]
    body = json.loads(outcome.error_reports(bad).first().body)
    assert body == {"RAW": "YmFk/w==", "EXCEPTION": "message is not a JSON object", "EXCEPTION CAUSE": "malformed input", "EXCEPTION TRACE": "parse_json"}


def test_sql_rows(spark):
    row = tables.sql_rows(spark.createDataFrame(ENVELOPES[:1], ENVELOPE), F.lit("2024-01-01 00:00:00").cast("timestamp")).first()
    assert row.id == "m1" and str(row.CREATED_TIME) == "2024-01-01 00:00:00" and row.payload is None


def test_overwrite_text(spark, tmp_path):
    path = str(tmp_path / "f")
    files.overwrite_text(spark.createDataFrame([("a",), ("b",)], "value string"), path)
    files.overwrite_text(spark.createDataFrame([("c",)], "value string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["c"]


def test_package_check(spark):
    assert A.package_available(spark) in (True, False)


def test_requests_with_a_result_are_not_sent_again(spark, tmp_path):
    """Nulls in a request's name, equal requests, another batch and another run of the same number, an empty batch."""
    from parcelflow.schemas import OUTBOX

    path = str(tmp_path / "results")

    def requests(*names):
        rows = [(*name, "POST", "u", "p", {}, "b", "s", 0) for name in names]
        by = ("messageid", "ruleset", "rule_id", "channel", "method", "uri", "path", "headers", "body", "schema_ref", "salience")
        return spark.createDataFrame([tuple(dict(zip(by, row))[f] for f in OUTBOX.names) for row in rows], OUTBOX)

    def results():
        return sorted((str(r.messageid), r.result, str(r.batch), r.run) for r in spark.read.parquet(path).collect())

    one, nameless, twice, new = ("1", "r", "a", "REST"), (None, None, "a", "REST"), ("2", "r", "b", "REST"), ("3", "r", "a", "ES")
    O.deliver_once(requests(one, nameless, twice, twice), lambda r: "first", path, 5, run="x")
    O.deliver_once(requests(one, nameless, twice, twice, new), lambda r: "second", path, 5, run="x")
    O.deliver_once(requests(one, nameless, twice, twice, new), lambda r: "third", path, 5, run="x")
    O.deliver_once(requests(), lambda r: "none", path, 5, run="x")
    mine = [("1", "first", "5", "x"), ("2", "first", "5", "x"), ("2", "first", "5", "x"), ("3", "second", "5", "x"), ("None", "first", "5", "x")]
    assert results() == mine
    O.deliver_once(requests(one), lambda r: "other batch", path, 6, run="x")
    O.deliver_once(requests(one), lambda r: "other run", path, 5, run="y")
    assert results() == sorted([*mine, ("1", "other batch", "6", "x"), ("1", "other run", "5", "y")])
    with pytest.raises(ValueError, match="named by"):
        O.deliver_once(requests(one), lambda r: "", path, 5, run="a/b")


def test_avro_columns_equal_values_read_one_by_one():
    """Records of records, with nulls and damaged bytes between them, in one batch and in none."""
    schema = json.loads(ENVELOPE_AVRO)
    text = lambda s: bytes([2 * len(s)]) + s.encode()
    request = b"\x02" + b"".join(map(text, ("/p", "POST"))) + b"\x05" + b"".join(map(text, ("", "t", "d", "h")))
    long = bytes([0x80 | (400 & 127), 400 >> 7]) + b"x" * 200
    whole = text("id") + text("src") + b"\x02" + long + request + text("now") + text("T")
    bare = text("id") + text("src") + b"\x00" + b"\x00" + text("now") + text("T")
    read = A.reader(schema)
    first = ("id", "src", "x" * 200, ("/p", "POST", -3, "", "t", "d", "h"), "now", "T")
    assert read(whole, 0) == (first, len(whole)) and read(bare, 0)[0] == ("id", "src", None, None, "now", "T")
    named = [dict(zip([f["name"] for f in schema["fields"]], row, strict=True)) for row in (first, read(bare, 0)[0])]
    named[0]["registrypayload"] = dict(zip(("path", "verb", "statusCode", "payload", "txId", "deviceId", "header"), first[3], strict=True))
    arrow = A._arrow_type(schema)
    assert A._column([first, None, read(bare, 0)[0]], arrow).to_pylist() == [named[0], None, named[1]]
    assert A._column([], arrow).to_pylist() == [] and A._column([None], arrow).to_pylist() == [None]
    for cut in (1, 5, len(whole) - 1):
        with pytest.raises((IndexError, ValueError)):
            read(whole[:cut], 0)


def test_generated_code_of_standardise_is_small_enough_to_be_compiled(spark, folder):
    """The JVM runs methods above 8000 bytes uncompiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    text = io.StringIO()
    try:
        with contextlib.redirect_stdout(text):
            QUERIES["standardise"](spark, folder).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_requests_are_told_apart_without_sorting_what_is_read(spark, tmp_path, monkeypatch):
    """Repeated requests go by hash before any sort; a map counts regardless of its order."""
    frame = spark.createDataFrame([(1, "u", {"a": "1", "b": "2"}), (2, "u", {"b": "2", "a": "1"}), (3, None, None), (4, None, None), (5, "u", {})], "id int, url string, attr map<string,string>")
    plans = []
    calls = str(tmp_path / "calls")

    def look_up(request):
        os.makedirs(calls, exist_ok=True)
        open(f"{calls}/{uuid.uuid4().hex}", "w").close()
        return f"{request['url']} {sorted(request['attr'].items())}"

    original = type(frame).mapInPandas

    def watched(self, *args, **kwargs):
        plans.append(plan_of(self))
        return original(self, *args, **kwargs)

    monkeypatch.setattr(type(frame), "mapInPandas", watched)
    got = O.enrich_cached(frame, look_up, F.col("url"), F.lit(None).cast("string"), F.col("attr"), str(tmp_path / "cache"))
    answers = {r.id: r.answer for r in got.collect()}
    assert answers[1] == answers[2] == "u [('a', '1'), ('b', '2')]" and answers[3] == answers[4] == "None []" and answers[5] == "u []"
    assert len(os.listdir(calls)) == 3
    tree = plans[0].split("\n\n")[0]
    assert "HashAggregate" in tree and tree.rindex("HashAggregate") > tree.rindex("Sort")
