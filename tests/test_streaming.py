"""Streams give what a batch gives, also after a restart."""

import json
import glob
import os

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.operators import avro, outcome, parse as P, rules as R, standardise as S
from parcelflow.plans import jobs
from parcelflow.plans.message_tables import event_messages
from parcelflow.schemas import ENVELOPE_AVRO, MESSAGE
from parcelflow.sinks import files
from parcelflow.sources.messages import read_messages, spread
from parcelflow.sources.rules import default_rules
from parcelflow.streaming import run

TOPICS = "device.event, device.out,device.onboard,out.registry.topic,in.topic.oneid,jsonexternaltopic"


@pytest.fixture(scope="module")
def topic_folder(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topics") / "messages")
    event_messages(spark, folder).repartition(4).write.parquet(path)
    return path


def published(spark, root, app):
    return avro.decode_avro(spark.read.parquet(f"{root}/{app}/TOPIC"), "value", ENVELOPE_AVRO).select("envelope.*")


def test_topic_list(spark, topic_folder):
    two = read_messages(spark, "device.event,device.out", "batch", topic_folder)
    assert {r.topic for r in two.select("topic").distinct().collect()} == {"device.event", "device.out"}
    assert "PushedFilters: [In(topic" in plan_of(two)


def test_stream_equals_batch_and_survives_a_restart(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    ids = {"id_col": F.col("offset").cast("string"), "clock_col": F.col("timestamp")}

    def stream():
        return read_messages(spark, TOPICS, "stream", topic_folder, maxFilesPerTrigger="1")

    failed = []

    def breaks_once(batch, batch_id):
        jobs.security_job(batch, jobs.Target(root, "stream"), batch_id, **ids)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run.run_stream(stream(), breaks_once, f"{root}/checkpoint").awaitTermination()
    query = run.run_stream(stream(), breaks_once, f"{root}/checkpoint")
    query.awaitTermination()
    assert failed and query.exception() is None
    jobs.security_job(read_messages(spark, TOPICS, "batch", topic_folder), jobs.Target(root, "batch"), **ids)

    mine, theirs = (sorted(map(str, published(spark, root, app).collect())) for app in ("stream", "batch"))
    assert mine == theirs and len(mine) > 900
    for part in ("RAW", "ERRORS"):
        counts = [spark.read.parquet(f"{root}/{app}/{part}").count() for app in ("stream", "batch")]
        assert counts[0] == counts[1] > 0
    texts = [sorted(r.value for r in spark.read.text(f"{root}/{app}/PARSED").collect()) for app in ("stream", "batch")]
    assert texts[0] == texts[1]


def test_counts_add_up(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    stream = read_messages(spark, TOPICS, "stream", topic_folder, maxFilesPerTrigger="1")
    query = run.run_stream(stream, run.count_batch(f"{root}/counts"), f"{root}/checkpoint")
    query.awaitTermination()
    counted = spark.read.parquet(f"{root}/counts")
    per_batch = {int(r.batch): r.n for r in counted.groupBy("batch").agg(F.sum("messages").alias("n")).collect()}
    assert len(per_batch) == 4 and sum(per_batch.values()) == spark.read.parquet(topic_folder).count()
    assert {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]} == per_batch


def test_steps_share_one_batch(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    seen = []

    def first(batch, batch_id):
        seen.append(batch.is_cached)
        files.write_batch(batch.select("topic"), f"{root}/a", batch_id, run="steps")

    def second(batch, batch_id):
        files.write_batch(batch.select("topic"), f"{root}/b", batch_id, run="steps")

    stream = read_messages(spark, TOPICS, "stream", topic_folder)
    for keep in (True, False):
        run.run_stream(stream, run.foreach_batch(first, second, keep=keep), f"{root}/checkpoint-{keep}").awaitTermination()
    assert seen == [True, False]
    assert spark.read.parquet(f"{root}/a").count() == spark.read.parquet(f"{root}/b").count() == spark.read.parquet(topic_folder).count()


def test_whole_chain(spark, topic_folder, tmp_path):
    """Messages to envelopes to rules to results."""
    root = str(tmp_path)
    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    jobs.security_job(messages, jobs.Target(root, "security"))
    envelopes = spark.read.parquet(f"{root}/security/TOPIC").select(
        "topic", F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(None).cast("string").alias("key"), "value")
    broken = envelopes.limit(1).withColumn("value", F.lit(b"\xff\xff"))
    rules = default_rules(spark, "http://r", "http://i", "tcp://b", "s")
    jobs.business_job(envelopes.unionByName(broken), rules, lambda request: json.dumps([request["channel"], request["method"]]),
                      jobs.Target(root, "business"))
    results = spark.read.parquet(f"{root}/business/RESULTS")
    stored = published(spark, root, "security")
    to_store = stored.where("messagetype = 'TELEMETRY' AND sourceid = 'oneid'").count()
    assert results.count() == stored.count() - to_store
    assert {r.result for r in results.select("result").distinct().collect()} == {
        '["REST", "POST"]', '["REST", "PUT"]', '["MQTT", "PUBLISH"]', '["ES", "POST"]'}
    errors = sorted(r.stage for r in spark.read.parquet(f"{root}/business/ERRORS").collect())
    assert errors == ["DECODE"] + ["DELIVER"] * to_store and to_store > 0
    # Rules read per batch, and every error also sent.
    jobs.business_job(envelopes.unionByName(broken), lambda: rules, lambda request: request["rule_id"],
                      jobs.Target(root, "reported"), error_uri="http://errors")
    sent = spark.read.parquet(f"{root}/reported/RESULTS").groupBy("result").count().collect()
    assert {r.result: r["count"] for r in sent}["exception_index"] == len(errors)


def test_rule_without_a_channel_is_an_error(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    messages = read_messages(spark, "in.topic.oneid", "batch", topic_folder)
    jobs.security_job(messages, jobs.Target(root, "security"))
    envelopes = spark.read.parquet(f"{root}/security/TOPIC").withColumns(
        {"timestamp": F.current_timestamp(), "key": F.lit(None).cast("string")})
    rules = default_rules(spark, "r", "i", "b", "s").withColumn("channel", F.lit(None).cast("string"))
    fired = R.evaluate_rules(R.select_ruleset(published(spark, root, "security"), rules), rules).count()
    jobs.business_job(envelopes, rules, lambda request: "", jobs.Target(root, "business"))
    errors = spark.read.parquet(f"{root}/business/ERRORS")
    assert [r.stage for r in errors.select("stage").distinct().collect()] == ["DELIVER"] and errors.count() == fired > 0


def test_topic_test_of_a_route_reaches_the_scan(spark, topic_folder):
    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    assert "StringStartsWith(topic,device.event)" in plan_of(P.parse_json(S.of_route(messages, "device_event")))
    routed = S.route(messages).select("offset", "route").collect()
    for route in S.ROUTES:
        mine = {r.offset for r in S.of_route(messages, route.name).collect()}
        assert mine == {r.offset for r in routed if r.route == route.name}


def test_clock_text_in_a_zone_that_skips_an_hour(spark):
    from parcelflow.functions import envelope as E

    instants = ["2024-03-10 02:30:00", "2024-03-10 07:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00", None]
    frame = spark.createDataFrame([(t,) for t in instants], "t string").selectExpr(
        "CAST(CASE WHEN t IS NOT NULL THEN concat(t, ' UTC') END AS timestamp) AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = frame.select(E.create_date(F.col("t")).alias("iso"), E.create_date(F.col("t"), E.TWELVE_HOUR).alias("twelve")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.iso for r in rows] == [t and t.replace(" ", "T") + ".000Z" for t in instants]
    assert [r.twelve for r in rows] == ["2024-03-10 02:30:00", "2024-03-10 07:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00", None]


def test_one_line_per_message(spark, tmp_path):
    frame = spark.createDataFrame([("a\nb\r\nc",), ("d",)], "value string")
    assert sorted(r.value for r in spark.read.text(files.overwrite_text(frame, f"{tmp_path}/t")).collect()) == ["a\\nb\\r\\nc", "d"]
    messages = frame.selectExpr("timestamp'2024-01-01' AS timestamp", "'t' AS topic", "'k' AS key", "CAST(value AS BINARY) AS value")
    path = files.archive_raw(messages, str(tmp_path), "app", fmt="text")
    assert spark.read.text(path).count() == 2


def test_message_beyond_the_parser(spark):
    deep = '{"a":' * 1200 + "1" + "}" * 1200
    frame = spark.createDataFrame([(1, b"{bad"), (2, deep.encode()), (3, b'{"a":1}')], "n int, value binary")
    assert {r.n: r.stage for r in P.parse_json(frame).select("n", "error.stage").collect()} == {1: "PARSE", 2: "LIMIT", 3: None}


def test_other_jobs(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    total = messages.count()
    bad = P.parse_json(messages).where("msg IS NULL").count()
    jobs.registry_job(messages, jobs.Target(root, "registry"))
    jobs.simple_job(messages, jobs.Target(root, "simple"), "source", partitions=6)
    whole, simple = published(spark, root, "registry"), published(spark, root, "simple")
    assert whole.count() == total - bad and simple.count() == total
    assert {(r.sourceid, r.messagetype) for r in whole.select("sourceid", "messagetype").distinct().collect()} == {("default", "REGISTRY_RESPONSE")}
    assert not os.path.exists(f"{root}/simple/PARSED")
    assert len(glob.glob(f"{root}/simple/TOPIC/topic=envelopes/batch=0/*/*.parquet")) == 6


def test_half_of_all_rows_in_one_key(spark, folder):
    """A hot source gives every row its envelope, rule set and rules, whichever way the look-ups are joined."""
    from parcelflow.operators import lookup, rules as R

    half, value = F.col("offset") % 2 == 0, b'{"sourceid":"yaima","messagetype":"TELEMETRY","payload":"p"}'
    messages = event_messages(spark, folder).withColumn("topic", F.when(half, "x").otherwise(F.col("topic")))
    hot = messages.withColumn("value", F.when(half, F.lit(value)).otherwise(F.col("value")))
    good = outcome.accepted(S.standardise(P.parse_json(hot)))
    assert good.where("payload = 'p'").count() == 500
    names = spark.createDataFrame([("yaima", "yaima"), ("kaniu", "kaniu")], "sourceid string, ruleset string")
    salted = lookup.left_lookup(good, names, ["sourceid"], rows=0)
    assert "_salt" in plan_of(salted)
    assert salted.count() == good.count() and salted.where("payload = 'p' AND ruleset = 'yaima'").count() == 500
    rules = default_rules(spark, "http://r", "http://i", "tcp://b", "s")
    chosen = R.select_ruleset(good, rules)
    for inline in (200, 0):
        assert R.evaluate_rules(chosen, rules, inline=inline).where("payload = 'p'").count() == 500


def test_spread_only_when_there_are_few_splits(spark):
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=16)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many) is many


def test_envelopes_as_json(spark, topic_folder, tmp_path):
    root = str(tmp_path)
    messages = read_messages(spark, "in.topic.oneid", "batch", topic_folder)
    jobs.security_job(messages, jobs.Target(root, "security", encoding="json"))
    sent = spark.read.parquet(f"{root}/security/TOPIC").withColumns({"timestamp": F.current_timestamp(), "key": F.lit(None).cast("string")})
    broken = sent.limit(2).withColumn("value", F.unhex(F.lit("FFFF")))
    rules = default_rules(spark, "r", "i", "b", "s")
    jobs.business_job(sent.unionByName(broken), rules, lambda request: "", jobs.Target(root, "business"), encoding="json")
    errors = spark.read.parquet(f"{root}/business/ERRORS")
    assert errors.where("stage = 'DECODE'").count() == 2
    assert spark.read.parquet(f"{root}/business/RESULTS").count() + errors.where("stage = 'DELIVER'").count() == sent.count() > 0
    assert spark.read.parquet(f"{root}/business/RAW").count() == sent.count() + 2
    with pytest.raises(ValueError, match="encoding"):
        jobs.pack(sent, "xml")


def test_equal_dead_letters_have_ids_of_their_own(spark):
    from parcelflow.operators import outbox

    rows = [("x", p, 1, None, "k", bytearray(b"bad")) for p in (0, 1)]
    letters = outcome.dead_letters(P.parse_json(spark.createDataFrame(rows, MESSAGE)))
    first, again = ({r.messageid for r in outbox.error_outbox(letters, "u").collect()} for _ in range(2))
    assert first == again and len(first) == 2


def test_compacted_day_holds_every_row_once(spark, topic_folder, tmp_path):
    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    path = [files.archive_raw(messages, str(tmp_path), "app", batch, run="r") for batch in (1, 2)][0]
    kept = spark.read.parquet(path)
    day = kept.select(F.col("day").cast("string")).first()[0]
    for _ in range(2):
        files.compact(spark, path, f"{tmp_path}/days", day)
    want = kept.where(F.col("day") == day)
    assert spark.read.parquet(f"{tmp_path}/days").count() == want.count() > 0
    assert len(glob.glob(f"{tmp_path}/days/day=*/*.parquet")) == 1
    assert {"partition", "offset"} <= set(kept.columns)


def test_a_batch_reads_its_source_once(spark, topic_folder, tmp_path):
    """What the archive writes comes from the frame the other writes use."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    total = messages.count()
    jobs.security_job(messages.mapInArrow(counted, messages.schema), jobs.Target(str(tmp_path), "security"))
    assert reads.value == total
    assert spark.read.parquet(f"{tmp_path}/security/RAW").count() == total


def test_counts_observed_cost_no_job_and_add_up_after_a_restart(spark, topic_folder, tmp_path):
    root, jobs_of, counts, failed = str(tmp_path), {}, {}, []
    known = ["device.event", "device.out", "device.event"]

    def archive(batch, batch_id):
        files.archive_raw(batch, root, "plain", batch_id)

    def breaks_once(batch, batch_id):
        archive(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    def stream(step, checkpoint):
        messages = read_messages(spark, TOPICS, "stream", topic_folder, maxFilesPerTrigger="1")
        query = run.run_stream(messages, step, f"{root}/{checkpoint}")
        query.awaitTermination()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))

    jobs_of["plain"] = stream(archive, "plain")
    jobs_of["observed"] = stream(run.observed_counts(archive, known, lambda n, c: None), "observed")
    jobs_of["own job"] = stream(run.foreach_batch(archive, run.count_batch(f"{root}/counts")), "own")
    assert jobs_of["observed"] == jobs_of["plain"] < jobs_of["own job"]

    step = run.observed_counts(breaks_once, known, counts.__setitem__)
    with pytest.raises(Exception, match="lost after writing"):
        stream(step, "restarted")
    assert sorted(counts) == [0]
    stream(step, "restarted")
    assert sorted(counts) == [0, 1, 2, 3] and failed
    topics = {r.topic: r["count"] for r in spark.read.parquet(topic_folder).groupBy("topic").count().collect()}
    want = {name: topics[name] for name in known} | {run.OTHER: sum(n for t, n in topics.items() if t not in known)}
    assert {name: sum(c.get(name, 0) for c in counts.values()) for name in want} == want


def test_counts_of_an_empty_batch(spark, topic_folder, tmp_path):
    counts = {}
    step = run.observed_counts(lambda batch, n: files.write_batch(batch, f"{tmp_path}/out", n), ["a"], counts.__setitem__)
    for k, none in enumerate((spark.createDataFrame([], MESSAGE), spark.read.parquet(topic_folder).where("topic = 'no such topic'"))):
        step(none, k)
    assert counts == {0: {}, 1: {}}


def test_a_business_batch_run_again_sends_nothing_twice(spark, topic_folder, tmp_path):
    """Lost after its results were written and before the checkpoint: the same requests, each sent once."""
    root = str(tmp_path)
    messages = read_messages(spark, TOPICS, "batch", topic_folder)
    jobs.security_job(messages, jobs.Target(root, "security", encoding="json"))
    envelopes = spark.read.parquet(f"{root}/security/TOPIC").select(
        "topic", F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(None).cast("string").alias("key"), "value")
    envelopes.write.parquet(f"{root}/envelopes")
    rules = default_rules(spark, "http://r", "http://i", "tcp://b", "s")
    sent, failed = spark.sparkContext.accumulator(0), []

    def send(request):
        sent.add(1)
        return request["rule_id"]

    def breaks_once(batch, batch_id):
        jobs.business_job(batch, rules, send, jobs.Target(root, "business"), batch_id, encoding="json")
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after sending")

    def stream():
        return run.run_stream(read_messages(spark, "envelopes", "stream", f"{root}/envelopes"), breaks_once, f"{root}/checkpoint")

    with pytest.raises(Exception, match="lost after sending"):
        stream().awaitTermination()
    first = sent.value
    stream().awaitTermination()
    assert failed and sent.value == first > 0
    assert spark.read.parquet(f"{root}/business/RESULTS").count() == first
