"""Edge rows of parsing and standardisation, each with its expected outcome."""

import base64
import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.operators import outcome, parse as P, standardise as S
from parcelflow.schemas import MESSAGE


def b64(value) -> str:
    data = value if isinstance(value, bytes) else (value if isinstance(value, str) else json.dumps(value)).encode()
    return base64.b64encode(data).decode()


def run(spark, rows, **options):
    """rows: (topic, value) -> list of (envelope dict or None, error dict or None), in order."""
    data = [
        (topic, 0, n, None, "k", bytearray(v if isinstance(v, bytes) else v.encode())) for n, (topic, v) in enumerate(rows)
    ]
    messages = spark.createDataFrame(data, MESSAGE)
    built = S.standardise(
        P.parse_json(messages), id_col=F.col("offset").cast("string"), clock_col=F.lit("2024-02-03 04:05:06.789").cast("timestamp"), **options
    )
    result = []
    for row in built.orderBy("offset").collect():
        result.append((row.envelope and row.envelope.asDict(True), row.error and row.error.asDict()))
    return result


@pytest.mark.parametrize(
    "text",
    ["not json", "", "[1,2]", '"text"', "null", "{'a':1}", '{"a":NaN}', '{"a":01}', b'{"a":"\xff"}'],
)
def test_not_an_object(spark, text):
    (envelope, error), = run(spark, [("x", text)])
    assert envelope is None and error["stage"] == "PARSE"


def test_accepted_forms(spark):
    forms = [
        '{"messagetype":"A","payload":"p"} trailing',
        '﻿ {"messagetype":"A","payload":"p"}',
        '{"messagetype":"B","messagetype":"A","payload":"p"}',
        '{"messagetype":"A","payload":"p","x":{"y":1,"y":2}}',
    ]
    for envelope, error in run(spark, [("x", f) for f in forms]):
        assert error is None
        assert (envelope["messagetype"], envelope["payload"], envelope["sourceid"]) == ("A", "p", "default")


def test_passthrough_types(spark):
    cases = [
        ({"payload": "p"}, "MESSAGETYPE"),
        ({"payload": "p", "messagetype": None}, "MESSAGETYPE"),
        ({"payload": "p", "messagetype": 5}, "ENCODE"),
        ({"payload": {"a": 1}, "messagetype": "A"}, "ENCODE"),
        ({"payload": "p", "messagetype": "A", "sourceid": 7}, "SOURCEID"),
        ({"payload": "p", "messagetype": ""}, "TELEMETRY"),
        ({"payload": "p", "messagetype": " "}, " "),
        ({"payload": None, "messagetype": "A"}, "A"),
        ({"messagetype": "A", "sourceid": None}, "A"),
        ({"messagetype": "A", "sourceid": ""}, "A"),
    ]
    results = run(spark, [("in.topic.oneid", json.dumps(c)) for c, _ in cases])
    for (message, expected), (envelope, error) in zip(cases, results):
        if error:
            assert error["stage"] == expected, message
        else:
            assert envelope["messagetype"] == expected
            assert envelope["payload"] == message.get("payload")
            assert envelope["sourceid"] == ("" if message.get("sourceid") == "" else "oneid")
            assert envelope["messageid"].endswith(envelope["sourceid"])
            assert envelope["createdate"] == "2024-02-03T04:05:06.789Z"


def test_device_payloads(spark):
    inner = {"path": "a/light", "payload": {"value": True, "brightness": 30}, "statusCode": 200, "txId": None}
    cases = [
        ({"payload": b64(inner)}, {"path": "a/light", "payload": '{"value":true,"brightness":30}', "statusCode": 200, "txId": ""}),
        ({"payload": b64({"payload": 'say "x"'})}, {"payload": '"say \\"x\\""', "statusCode": 0, "path": ""}),
        ({"payload": b64({"payload": [1, None, "é"]})}, {"payload": '[1,null,"é"]'}),
        ({"payload": b64('{"payload":{"b":1,"a":{"d":null,"c":2}}}')}, {"payload": '{"b":1,"a":{"d":null,"c":2}}'}),
        ({"payload": b64({"payload": 1.5})}, {"payload": "1.5"}),
        ({"payload": b64({"payload": False})}, {"payload": "false"}),
        ({"payload": b64({"payload": None})}, {"payload": ""}),
        ({"payload": b64({})}, {"payload": "", "verb": "", "deviceId": "", "header": ""}),
        ({"payload": b64({"path": "~?>é"}).replace("+", "-").replace("/", "_").rstrip("=")}, {"path": "~?>é"}),
        ({"payload": "\n".join(b64({"path": "a" * 200})[i:i + 60] for i in range(0, 400, 60))}, {"path": "a" * 200}),
        ({}, "PAYLOAD"),
        ({"payload": None}, "PAYLOAD"),
        ({"payload": {"value": True}}, "PAYLOAD"),
        ({"payload": ""}, "PAYLOAD"),
        ({"payload": "!!!"}, "PAYLOAD"),
        ({"payload": b64("no json")}, "PAYLOAD"),
        ({"payload": b64("[1]")}, "PAYLOAD"),
        ({"payload": b64({"statusCode": "200"})}, "ENCODE"),
        ({"payload": b64({"statusCode": 2.5})}, "ENCODE"),
        ({"payload": b64({"statusCode": 3000000000})}, "ENCODE"),
        ({"payload": b64({"path": 5})}, "ENCODE"),
        ({"payload": b64({"header": {"a": "b"}})}, "ENCODE"),
    ]
    for topic, kind in (("device.event.x", "REGISTRY_PUT"), ("device.outer", "REGISTRY_POST")):
        results = run(spark, [(topic, json.dumps(c)) for c, _ in cases])
        for (message, expected), (envelope, error) in zip(cases, results):
            if isinstance(expected, str):
                assert error and error["stage"] == expected, message
            else:
                assert error is None, (message, error)
                assert envelope["messagetype"] == kind and envelope["payload"] is None
                assert expected.items() <= envelope["registrypayload"].items()


def test_onboarding(spark):
    cases = [
        ({"path": "/p", "payload": b64("[1, 2] any text")}, ("/p", "[1, 2] any text")),
        ({"payload": b64(b"\xffA")}, ("", "�A")),
        ({"payload": None}, ("", "")),
        ({"payload": ""}, ("", "")),
        ({"payload": 5}, "PAYLOAD"),
        ({"path": 5}, "ENCODE"),
    ]
    results = run(spark, [("device.onboard", json.dumps(c)) for c, _ in cases])
    for (message, expected), (envelope, error) in zip(cases, results):
        if isinstance(expected, str):
            assert error["stage"] == expected
        else:
            request = envelope["registrypayload"]
            assert (request["path"], request["payload"]) == expected and request["statusCode"] == 0


def test_strict_record(spark):
    full = {"path": "a", "verb": "", "statusCode": 1, "payload": "p", "txId": "t", "deviceId": "d", "header": "h"}
    cases = [(full, None), ({**full, "extra": [1]}, None)]
    cases += [({k: v for k, v in full.items() if k != name}, f"{name} is missing") for name in full]
    cases += [({**full, name: None}, f"{name} is missing") for name in full]
    cases += [({**full, "statusCode": "1"}, "statusCode has the wrong type"), ({**full, "payload": {}}, "payload has the wrong type")]
    results = run(spark, [("out.registry.topic", json.dumps(c)) for c, _ in cases])
    for (message, expected), (envelope, error) in zip(cases, results):
        if expected:
            assert (error["stage"], error["exception"]) == ("RECORD", expected)
        else:
            assert envelope["payload"] == "" and envelope["messagetype"] == "REGISTRY_RESPONSE"
            assert envelope["registrypayload"] == full


def test_routing_by_subscription_and_unknown_topic(spark):
    message = json.dumps({"payload": b64({"path": "p"}), "messagetype": "M"})
    (by_topic, _), = run(spark, [("out.topic.registry", message)])
    assert by_topic["messagetype"] == "M"
    (by_list, _), = run(spark, [("any", message)], subscription="device.event,any")
    assert by_list["messagetype"] == "REGISTRY_PUT" and by_list["registrypayload"]["path"] == "p"


def test_long_payload(spark):
    long = "é" * 100_000
    (envelope, error), = run(spark, [("x", json.dumps({"payload": long, "messagetype": "A"}, ensure_ascii=False))])
    assert error is None and envelope["payload"] == long


def test_compact_text(spark):
    cases = [('{ "b" : 1 , "a":[ 1,2 ], "c":{"z":null,"y":"\\u00e9"}} x', '{"b":1,"a":[1,2],"c":{"z":null,"y":"é"}}'), ('{"a":1,"a":2}', '{"a":2}'), ("[1]", None)]
    frame = spark.createDataFrame([(n, bytearray(t.encode())) for n, (t, _) in enumerate(cases)], "n int, value binary")
    got = [r.json for r in P.message_text(P.parse_json(frame)).orderBy("n").collect()]
    assert got == [expected for _, expected in cases]


def test_generic_strict_record(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DoubleType()), T.StructField("b", T.BooleanType())])
    rows = ['{"n":1,"d":2,"b":true}', '{"n":1.5,"d":2,"b":true}', '{"n":1,"d":"2","b":true}', '{"n":1,"d":2.5}', "x"]
    frame = spark.createDataFrame([(i, bytearray(r.encode())) for i, r in enumerate(rows)], "i int, value binary")
    got = P.strict_record(P.parse_json(frame), schema).orderBy("i").collect()
    assert got[0].record.asDict() == {"n": 1, "d": 2.0, "b": True} and got[0].error is None
    assert [r.error and r.error.exception for r in got[1:]] == [
        "n has the wrong type", "d has the wrong type", "b is missing", "message is not a JSON object"]
    assert all(r.record is None for r in got[1:])


def test_security_check(spark):
    frame = spark.createDataFrame(
        [("x", 0, n, None, "k", bytearray(v.encode())) for n, v in enumerate(['{"authentication":"t","messagetype":"A"}', '{"messagetype":"A"}', "bad"])], MESSAGE)
    allowed = F.try_variant_get("msg", "$.authentication", "string") == "t"
    built = S.standardise(outcome.security_check(P.parse_json(frame), allowed))
    good, bad = outcome.split_errors(built)
    assert good.count() == 1
    assert sorted(r.stage for r in bad.collect()) == ["PARSE", "SECURITY"]


def test_replay_keeps_ids(spark):
    rows = [("a", 0, 1, None, "k", bytearray(b'{"messagetype":"A"}')), ("a", 1, 1, None, "k", bytearray(b'{"messagetype":"A"}'))]
    built = S.standardise(P.parse_json(spark.createDataFrame(rows, MESSAGE)))
    first, again = ({r.envelope.messageid for r in built.collect()} for _ in range(2))
    assert first == again and len(first) == 2


def test_plan_is_one_pass_without_python(spark, folder):
    from parcelflow.plans.message_tables import event_message_rows, table

    messages = event_message_rows(table(spark, folder, "events"))
    good, bad = outcome.split_errors(S.standardise(P.parse_json(messages)))
    for frame in (good, bad):
        plan = plan_of(frame)
        assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan
    # Each text is parsed once: one parse of the message, one of the decoded payload.
    assert plan_of(good).count("parseJson") <= 2


def test_generated_code_stays_compilable(spark, folder):
    import contextlib
    import io
    import re

    from parcelflow.plans.message_tables import event_message_rows, table

    built = S.standardise(P.parse_json(event_message_rows(table(spark, folder, "events")).persist()))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        built.explain("codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))) < 8000


def test_security_check_by_token(spark):
    said = [
        '{"sourceid":"s","authentication":"1","messagetype":"A"}', '{"sourceid":"s","authentication":"2","messagetype":"A"}',
        '{"sourceid":"r","authentication":"1","messagetype":"A"}', '{"authentication":"1","messagetype":"A"}',
        '{"sourceid":"s","messagetype":"A"}', "bad",
    ]
    frame = spark.createDataFrame([("x", 0, n, None, "k", bytearray(v.encode())) for n, v in enumerate(said)], MESSAGE)
    tokens = spark.createDataFrame([("s", "1"), ("s", "1"), ("s", None), (None, "1"), ("r", "3")], "sourceid string, token string")
    checked = outcome.security_check_by_token(P.parse_json(frame), tokens)
    good, bad = outcome.split_errors(S.standardise(checked))
    assert [r.sourceid for r in good.collect()] == ["s"]
    assert sorted((r.offset, r.partition, r.stage) for r in bad.collect()) == [
        (1, 0, "SECURITY"), (2, 0, "SECURITY"), (3, 0, "SECURITY"), (4, 0, "SECURITY"), (5, 0, "PARSE")]
    assert outcome.security_check_by_token(P.parse_json(frame), tokens.where("false")).where("error IS NULL").count() == 0
