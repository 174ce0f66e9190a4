"""One query per operator over the given tables; `oracles` holds the SQL that checks each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import envelope as E
from ..operators import avro, outbox as O, outcome, parse as P, rules as R, search, standardise as S
from ..schemas import ENVELOPE, ENVELOPE_AVRO, REMOTE_REQUEST
from ..session import configure, shared_folder
from ..sinks import files, tables, topics
from ..sources import messages as source, rules as rule_source
from ..streaming import enrich, run
from . import jobs
from .message_tables import TOPICS, conversation_messages, customer_messages, document_messages, event_message_rows, event_messages, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Addresses of the derived requests; nothing is ever sent to them.
ADDRESSES = {"registry": "http://registry", "index": "http://index", "broker": "tcp://broker", "store": "store"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _given() -> dict[str, Column]:
    """Id and clock taken from the message instead of a hash and now."""
    return {"id_col": F.col("offset").cast("string"), "clock_col": F.col("timestamp")}


def _standardised(spark: SparkSession, folder: str) -> DataFrame:
    return S.standardise(P.parse_json(event_messages(spark, folder)), **_given())


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return outcome.accepted(_standardised(spark, folder))


def flat(envelopes: DataFrame) -> DataFrame:
    """Envelopes with the registry request's fields as plain columns."""
    request = [F.col("registrypayload").getField(name).alias(f"r_{name}") for name in REMOTE_REQUEST.names]
    return envelopes.select("messageid", "sourceid", "payload", *request, "createdate", "messagetype")


def _flat_request(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col("request").getField(name).alias(f"r_{name}") for name in REMOTE_REQUEST.names])


def _of_route(spark: SparkSession, folder: str, *routes: str) -> DataFrame:
    chosen = S.of_route(event_messages(spark, folder), *routes)
    return flat(outcome.accepted(S.standardise(P.parse_json(chosen), **_given())))


# Sources


@query
def read_messages(spark, folder):
    stored = shared_folder(spark, "messages")
    event_messages(spark, folder).write.parquet(stored)
    return source.read_messages(spark, ",".join(TOPICS), "batch", stored).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("offset").alias("offsets")
    )


def _customer_rules(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return customers.select(
        F.col("c_mktsegment").alias("ruleset"),
        F.col("c_name").alias("rule_id"),
        F.col("c_nationkey").cast("int").alias("salience"),
        F.concat(F.lit("sourceid = '"), F.col("c_mktsegment"), F.lit("'")).alias("when_sql"),
        F.lit("POST").alias("action"), F.lit("REST").alias("channel"),
        F.concat(F.lit("http://registry/"), F.col("c_custkey").cast("string")).alias("target"),
        F.create_map(F.lit("path"), F.col("c_name")).alias("params"),
    )


@query
def read_rules(spark, folder):
    stored = shared_folder(spark, "rules")
    _customer_rules(spark, folder).write.parquet(stored)
    return rule_source.read_rules(spark, stored).select(
        "ruleset", "rule_id", "salience", "when_sql", "target", F.col("params")["path"].alias("path")
    )


# Parsing and encoding


@query
def parse_json(spark, folder):
    parsed = P.parse_json(event_messages(spark, folder))
    return parsed.select(
        "topic", "offset", F.col("msg").isNotNull().alias("is_object"),
        F.try_variant_get("msg", "$.sourceid", "string").alias("sourceid"),
        F.try_variant_get("msg", "$.messagetype", "string").alias("messagetype"),
        F.col("error.stage").alias("stage"),
    )


@query
def parse_json_long_text(spark, folder):
    parsed = P.parse_json(conversation_messages(spark, folder))
    return parsed.select("offset", F.try_variant_get("msg", "$.payload", "string").alias("payload"))


@query
def to_json_text(spark, folder):
    customers = table(spark, folder, "customer")
    return P.to_json_text(customers, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).select("c_custkey", "json")


@query
def message_text(spark, folder):
    return P.message_text(P.parse_json(conversation_messages(spark, folder))).select("offset", "json")


def _encoded(envelopes: DataFrame) -> DataFrame:
    packed = envelopes.select("messageid", F.struct(*ENVELOPE.names).alias("envelope"))
    return avro.encode_avro(packed, "envelope", ENVELOPE_AVRO)


@query
def encode_avro(spark, folder):
    wrapped = outcome.accepted(S.simple_wrap(document_messages(spark, folder), "documents", **_given()))
    return _encoded(wrapped).select("messageid", F.octet_length("value").alias("bytes"))


@query
def decode_avro(spark, folder):
    decoded = avro.decode_avro(_encoded(_envelopes(spark, folder)).select("value"), "value", ENVELOPE_AVRO)
    return flat(decoded.select("envelope.*"))


@query
def decode_avro_as_json(spark, folder):
    encoded = _encoded(_envelopes(spark, folder))
    return avro.decode_avro_as_json(encoded, "value", ENVELOPE_AVRO).select("messageid", "json")


@query
def strict_record(spark, folder):
    parsed = P.parse_json(event_messages(spark, folder)).where(F.col("topic") == "out.registry.topic")
    checked = P.strict_record(parsed, REMOTE_REQUEST)
    fields = [F.col(f"record.{name}").alias(name) for name in REMOTE_REQUEST.names]
    return checked.select("offset", *fields, F.col("error.stage").alias("stage"), F.col("error.exception").alias("exception"))


def _encoded_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a device request, in Base64."""
    inner = F.concat(
        F.lit('{"path":"/a/'), F.col("event_type"), F.lit('","statusCode":'), (F.col("event_id") % 3).cast("string"),
        F.lit(',"payload":'), F.col("props"), F.lit(',"txId":"'), F.col("event_id").cast("string"), F.lit('"}'),
    )
    events = table(spark, folder, "events")
    return events.select("event_id", "event_type", F.base64(inner.cast("binary")).alias("payload"))


@query
def decode_payload(spark, folder):
    decoded = P.decode_payload(_encoded_requests(spark, folder), "payload")
    return decoded.select(
        "event_id", "inner_text",
        F.try_variant_get("inner", "$.path", "string").alias("path"),
        F.try_variant_get("inner", "$.payload.k", "int").alias("k"),
    )


@query
def decode_payload_long_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.base64(F.col("text").cast("binary")).alias("payload"))
    return P.decode_payload(documents, "payload").select("doc_id", F.col("inner_text").alias("text"))


@query
def payload_text(spark, folder):
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.col("props"))
        .when(kind == 1, F.concat(F.lit('"say \\"'), F.col("event_type"), F.lit('\\""')))
        .when(kind == 2, F.col("event_id").cast("string"))
        .when(kind == 3, "true")
        .when(kind == 4, "null")
    )
    text = F.coalesce(F.concat(F.lit('{"z": 1, "payload": '), value, F.lit(', "a": 2}')), F.lit('{"z": 1}'))
    return P.payload_text(table(spark, folder, "events").select("event_id", text.alias("text")), "text").select(
        "event_id", "payload_text"
    )


# Standardisation


@query
def standardise(spark, folder):
    return flat(_envelopes(spark, folder))


@query
def standardise_conversations(spark, folder):
    built = S.standardise(P.parse_json(conversation_messages(spark, folder)), **_given())
    return outcome.accepted(built).select("messageid", "sourceid", "payload", "messagetype")


@query
def route(spark, folder):
    return S.route(event_messages(spark, folder)).groupBy("route").agg(F.count(F.lit(1)).alias("messages"))


@query
def envelope_defaults(spark, folder):
    parsed = P.parse_json(event_messages(spark, folder))
    return S.envelope_defaults(parsed, **_given()).select("offset", "sourceid", "messageid", "createdate")


@query
def remote_request(spark, folder):
    return _flat_request(S.remote_request(P.decode_payload(_encoded_requests(spark, folder), "payload")), "event_id")


@query
def remote_request_raw(spark, folder):
    return _flat_request(S.remote_request_raw(table(spark, folder, "documents"), "text"), "doc_id")


@query
def remote_request_onboard(spark, folder):
    return _flat_request(S.remote_request_onboard(_encoded_requests(spark, folder), "event_type"), "event_id")


@query
def device_event(spark, folder):
    return _of_route(spark, folder, "device_event")


@query
def device_out(spark, folder):
    return _of_route(spark, folder, "device_out")


@query
def device_onboard(spark, folder):
    return _of_route(spark, folder, "device_onboard")


@query
def registry_response_strict(spark, folder):
    return _of_route(spark, folder, "registry_response")


@query
def passthrough(spark, folder):
    return _of_route(spark, folder, "oneid", "other")


@query
def registry_whole_message(spark, folder):
    built = S.registry_whole_message(P.parse_json(conversation_messages(spark, folder)), **_given())
    return outcome.accepted(built).select("messageid", "sourceid", "payload", "createdate", "messagetype")


@query
def simple_wrap(spark, folder):
    built = S.simple_wrap(document_messages(spark, folder), "documents", createdate_format=E.TWELVE_HOUR, **_given())
    return outcome.accepted(built).select("messageid", "sourceid", "payload", "createdate", "messagetype")


# Errors and rules


@query
def security_check(spark, folder):
    known = F.try_variant_get("msg", "$.sourceid", "string").isNotNull()
    checked = outcome.security_check(P.parse_json(event_messages(spark, folder)), known)
    return checked.select("topic", F.coalesce("error.stage", F.lit("ACCEPTED")).alias("outcome")).groupBy(
        "topic", "outcome"
    ).agg(F.count(F.lit(1)).alias("messages"))


@query
def security_check_tokens(spark, folder):
    """Customers that owe nothing have a token."""
    customers = table(spark, folder, "customer").where("c_acctbal >= 0")
    tokens = customers.select(F.col("c_name").alias("sourceid"), F.concat(F.lit("t-"), F.col("c_custkey")).alias("token"))
    checked = outcome.security_check_by_token(P.parse_json(customer_messages(spark, folder)), tokens)
    return checked.select("offset", F.coalesce("error.stage", F.lit("ACCEPTED")).alias("outcome"))


@query
def split_errors(spark, folder):
    _, letters = outcome.split_errors(_standardised(spark, folder))
    return letters.select("topic", "partition", "offset", "key", F.col("value").cast("string").alias("value"), "stage", "exception")


def _rules(spark: SparkSession) -> DataFrame:
    return rule_source.default_rules(spark, **ADDRESSES)


@query
def select_ruleset(spark, folder):
    return R.select_ruleset(_envelopes(spark, folder), _rules(spark)).select("messageid", "sourceid", "ruleset")


def _located(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers with an id derived from their nation, as plain text or a pattern, and a location per nation."""
    nations = table(spark, folder, "nation")
    locations = nations.select(
        F.col("n_name").alias("sourceid"), F.concat(F.lit("rules/"), F.col("n_nationkey")).alias("file_uri"),
        F.col("n_nationkey").cast("bigint").alias("load_seq"),
    )
    name = F.col("n_name")
    pattern = F.element_at(F.array(
        name, F.concat(F.left(name, F.lit(1)), F.lit("%")), F.concat(F.lit("%"), F.right(name, F.lit(2))),
        F.regexp_replace(name, ".", "_"), F.concat(F.lit("_"), F.lit("%")), F.concat(name, F.lit("?")),
    ), (F.col("c_custkey") % 6 + 1).cast("int"))
    sources = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return sources.select("c_custkey", pattern.alias("sourceid")), locations


@query
def lookup_rule_uri(spark, folder):
    return R.lookup_rule_uri(*_located(spark, folder)).select("c_custkey", "sourceid", "file_uri")


@query
def lookup_rule_text(spark, folder):
    """Nations of the first region have no text of their own and take the default one."""
    texts = table(spark, folder, "nation").where("n_regionkey > 0").select(
        F.col("n_nationkey").cast("string").alias("name"), F.concat(F.lit("rule of "), F.col("n_name")).alias("rule"))
    default = table(spark, folder, "region").where("r_regionkey = 0").select(F.lit("default").alias("name"), F.col("r_name").alias("rule"))
    return R.lookup_rule_text(*_located(spark, folder), texts.unionByName(default)).select("c_custkey", "sourceid", "file_uri", "rule_name", "rule")


def _fired(spark: SparkSession, folder: str, **options) -> DataFrame:
    rules = _rules(spark)
    return R.evaluate_rules(R.select_ruleset(_envelopes(spark, folder), rules), rules, **options)


@query
def evaluate_rules(spark, folder):
    return _fired(spark, folder).select("messageid", "ruleset", "rule_id", "salience", "action", "channel", "target")


@query
def evaluate_rules_joined(spark, folder):
    return _fired(spark, folder, inline=0).select(
        "messageid", "ruleset", "rule_id", "salience", "action", "channel", "target"
    )


@query
def evaluate_rules_numeric(spark, folder):
    """Orders against a rule per customer over the order's price, all in the sets of the customers' segments."""
    customers = table(spark, folder, "customer")
    base = (F.col("c_custkey") * 7919 % 500_000).cast("string")
    more = (F.col("c_custkey") * 7919 % 500_000 + 40).cast("string")
    when = F.element_at(F.array(
        F.concat(F.lit("price > "), (F.col("c_custkey") * 7919 % 500_000 + 300_000).cast("string"), F.lit(".5")),
        F.concat(F.lit("price BETWEEN "), base, F.lit(" AND "), more),
        F.concat(F.lit("CAST(price_text AS DOUBLE) < "), (F.col("c_custkey") % 5000).cast("string")),
        F.concat(F.lit("price >= "), base, F.lit(" AND price < "), more),
    ), (F.col("c_custkey") % 4 + 1).cast("int"))
    rules = _customer_rules(spark, folder).drop("when_sql").join(
        customers.select(F.col("c_name").alias("rule_id"), when.alias("when_sql")), "rule_id")
    segments = customers.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("ruleset"))
    price = F.col("o_totalprice").cast("double")
    orders = table(spark, folder, "orders").join(segments, "o_custkey").select("o_orderkey", "ruleset", price.alias("price"), price.cast("string").alias("price_text"))
    return R.evaluate_rules(orders, rules).select("o_orderkey", "ruleset", "rule_id")


def _trees(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as nested JSON; where the text sits depends on the document."""
    kind, text = F.col("doc_id") % 5, F.to_json(F.struct("text"))
    tree = (
        F.when(kind == 0, F.concat(F.lit('{"id":1,"doc":'), text, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":{"i":'), text, F.lit('}}}}}}}}},"text":"later"}')))
        .when(kind == 2, F.concat(F.lit('{"a":{"text":null,"z":'), text, F.lit('},"tail":{"text":"after"}}')))
        .when(kind == 3, F.concat(F.lit('{"list":['), text, F.lit("]}")))
        .otherwise(F.concat(F.lit("no json "), text))
    )
    return source.spread(table(spark, folder, "documents")).select("doc_id", tree.alias("tree"))


@query
def search_map(spark, folder):
    return search.search_map(_trees(spark, folder), "tree", "text").select("doc_id", "found.value", "found.type")


@query
def search_map_first_subkey(spark, folder):
    return search.search_map_first_subkey(_trees(spark, folder), "tree", "tex").select("doc_id", "found.value", "found.type")


@query
def search_json(spark, folder):
    return search.search_json(_trees(spark, folder), "tree", "text").select("doc_id", "found.value", "found.type")


# Sinks and delivery


@query
def archive_raw(spark, folder):
    # No spreading here: nothing is parsed, and rows of one day stay together.
    messages = event_message_rows(table(spark, folder, "events"))
    path = files.archive_raw(messages, shared_folder(spark, "archive"), "security")
    return spark.read.parquet(path).select(
        F.col("day").cast("string").alias("day"), "topic", "key", F.col("value").cast("string").alias("value")
    )


@query
def archive_parsed(spark, folder):
    parsed = P.message_text(P.parse_json(conversation_messages(spark, folder)))
    path = files.archive_parsed(parsed, shared_folder(spark, "archive"), "security")
    return spark.read.text(path).select(F.col("value").alias("json"))


@query
def publish(spark, folder):
    path = shared_folder(spark, "topic")
    topics.publish(document_messages(spark, folder), "documents.out", path)
    return spark.read.parquet(path).select("topic", F.col("value").cast("string").alias("value"))


@query
def sql_rows(spark, folder):
    rows = tables.sql_rows(_envelopes(spark, folder), F.to_timestamp("createdate"))
    return rows.select(F.unix_millis("CREATED_TIME").alias("created_ms"), "id", "sourceid", "payload", "messagetype")


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return O.build_outbox(_fired(spark, folder))


@query
def build_outbox(spark, folder):
    return _requests(spark, folder).select(
        "messageid", "ruleset", "rule_id", "channel", "method", "uri", "path", "body", "schema_ref", "salience",
        F.col("headers")["Content-Type"].alias("content_type"), F.col("headers")["qos"].alias("qos"),
    )


@query
def deliver(spark, folder):
    def recorded(request: dict) -> str:
        """Stands in for a call: answers with what was asked, and fails for the broker."""
        if request["channel"] == "MQTT":
            raise ConnectionError("broker away")
        return f"{request['method']} {request['uri']} {request['path']}"

    path = shared_folder(spark, "results")
    files.write_batch(O.deliver(_requests(spark, folder), recorded), path)
    return spark.read.parquet(path).select("messageid", "rule_id", "channel", "result")


@query
def deliver_again(spark, folder):
    """A batch of which some requests have results is run again: those keep theirs, the others are sent."""
    path, requests = shared_folder(spark, "results"), _requests(spark, folder)

    def answered(request: dict) -> str:
        return f"{request['method']} {request['uri']} {request['path']}"

    def broker_only(request: dict) -> str:
        if request["channel"] == "MQTT":
            raise ConnectionError("broker away")
        return "sent again"

    O.deliver_once(requests.where("channel != 'MQTT'"), answered, path, 7, run="replay")
    for _ in range(2):
        O.deliver_once(requests, broker_only, path, 7, run="replay")
    return spark.read.parquet(path).select("messageid", "rule_id", "channel", "result")


@query
def enrich_cached(spark, folder):
    def look_up(request: dict) -> str:
        return f"{request['url']}?{request['attr']['path']}"

    events = table(spark, folder, "events")
    answered = O.enrich_cached(
        events, look_up, F.concat(F.lit("http://users/"), F.col("user_id")), F.lit(None).cast("string"),
        F.create_map(F.lit("path"), F.col("event_type")), shared_folder(spark, "answers"),
    )
    return answered.select("event_id", "answer")


@query
def enrich_stream(spark, folder):
    """The look-ups of a stream from keyed state, stopped after its first half and started again: one call per request.

    Every call marks its answer, so the marks of a request are its calls.
    """
    def look_up(request: dict) -> str:
        return f"{request['url']}?{request['attr']['path']}#{uuid.uuid4().hex}"

    root, events = shared_folder(spark, "enriched"), table(spark, folder, "events").select("event_id", "user_id", "event_type")
    for half in (0, 1):
        events.where(F.pmod("event_id", F.lit(2)) == half).write.mode("append").parquet(f"{root}/in")
        answered = enrich.enrich_stream(
            spark.readStream.schema(events.schema).parquet(f"{root}/in"), look_up, F.concat(F.lit("http://users/"), F.col("user_id")),
            F.lit(None).cast("string"), F.create_map(F.lit("path"), F.col("event_type")),
        )
        writer = answered.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
        enrich.start_keyed(spark, lambda: writer.start(f"{root}/out", format="parquet")).awaitTermination()  # noqa: B023
    marked = spark.read.schema(answered.schema).parquet(f"{root}/out").withColumn("answer", F.split("answer", "#"))
    return marked.groupBy(F.col("answer")[0].alias("answer")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").cast("long").alias("event_ids"), F.count_distinct(F.col("answer")[1]).alias("calls"))


@query
def write_errors(spark, folder):
    letters = outcome.dead_letters(_standardised(spark, folder))
    path = files.write_errors(letters, shared_folder(spark, "errors"))
    return spark.read.parquet(path).groupBy("stage", "topic").agg(F.count(F.lit(1)).alias("messages"))


@query
def error_requests(spark, folder):
    letters = outcome.dead_letters(_standardised(spark, folder))
    return O.error_outbox(letters, ADDRESSES["index"]).select(
        "channel", "uri", "path",
        F.get_json_object("body", "$.EXCEPTION").alias("exception"), F.get_json_object("body", "$.RAW").alias("raw"),
        F.get_json_object("body", "$.sourceid").alias("sourceid"),
    )


@query
def overwrite_text(spark, folder):
    path = shared_folder(spark, "text")
    pages = table(spark, folder, "pages")
    files.overwrite_text(pages, path, "page_id")
    files.overwrite_text(pages, path, "url")
    return spark.read.text(path).select(F.col("value").alias("url"))


# Streaming


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return event_message_rows(events)


@query
def run_stream(spark, folder):
    """Envelopes of a stream, archived, published and read back."""
    configure(spark)
    root = shared_folder(spark, "stream")
    target = jobs.Target(root, "security")

    def step(batch: DataFrame, batch_id: int) -> None:
        jobs.security_job(batch, target, batch_id, **_given())

    run.run_stream(_event_stream(spark, folder), step, f"{root}/checkpoint").awaitTermination()
    published = spark.read.parquet(f"{root}/security/TOPIC")
    return flat(avro.decode_avro(published, "value", ENVELOPE_AVRO).select("envelope.*"))


@query
def foreach_batch(spark, folder):
    """Two steps per batch, and the whole stream run again as after a lost checkpoint: one copy stays."""
    configure(spark)
    root = shared_folder(spark, "stream")

    def envelopes(batch: DataFrame, batch_id: int) -> None:
        built = S.standardise(P.parse_json(batch), **_given())
        files.write_batch(flat(outcome.accepted(built)), f"{root}/envelopes", batch_id, run="replay")

    def raw(batch: DataFrame, batch_id: int) -> None:
        files.archive_raw(batch, root, "security", batch_id, run="replay")

    for attempt in ("first", "again"):
        both = run.foreach_batch(envelopes, raw)
        run.run_stream(_event_stream(spark, folder), both, f"{root}/checkpoint-{attempt}").awaitTermination()
    stored = spark.read.parquet(f"{root}/envelopes").groupBy("messagetype").agg(F.count(F.lit(1)).alias("messages"))
    archived = spark.read.parquet(f"{root}/security/RAW").agg(F.count(F.lit(1)).alias("messages"))
    return stored.unionByName(archived.select(F.lit("RAW").alias("messagetype"), "messages"))


@query
def repartition(spark, folder):
    spread = run.repartition(event_messages(spark, folder), 6)
    return spread.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("messages")
    )


@query
def batch_counts(spark, folder):
    configure(spark)
    root = shared_folder(spark, "stream")
    run.run_stream(_event_stream(spark, folder), run.count_batch(f"{root}/counts"), f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/counts").groupBy("topic").agg(F.sum("messages").alias("messages"))


@query
def batch_counts_observed(spark, folder):
    """Counts per topic, taken while the stream's batches are archived."""
    configure(spark)
    root, batches = shared_folder(spark, "stream"), {}

    def archive(batch: DataFrame, batch_id: int) -> None:
        files.archive_raw(batch, root, "counted", batch_id)

    step = run.observed_counts(archive, TOPICS, batches.__setitem__)
    run.run_stream(_event_stream(spark, folder), step, f"{root}/checkpoint").awaitTermination()
    rows = [(batch_id, topic, n) for batch_id, counts in batches.items() for topic, n in counts.items()]
    counted = spark.createDataFrame(rows, "batch long, topic string, n long")
    return counted.groupBy("topic").agg(F.sum("n").alias("messages"))


__all__ = ["QUERIES", "flat"]
