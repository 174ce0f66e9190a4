"""Rule tables and rule text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import RULE

# Sources with a rule set of their own.
RULE_SETS = ("default", "kaniu", "yaima", "oneid", "customer2")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule table in parquet."""
    return spark.read.schema(RULE).parquet(path)


def read_rule_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Rule text by name from a file tree, one row per file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    stem = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1)
    return files.text(path, wholetext=True).select(stem.alias("name"), F.col("value").alias("rule"))


def read_rule_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Rule text by name from a `(name, rule)` table in a SQL store."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select("name", "rule")


def default_rules(spark: SparkSession, registry: str, index: str, broker: str, store: str) -> DataFrame:
    """A catalogue for the known message types; every address is the caller's.

    The rule texts themselves are not public. These rows only follow the
    message types and the kinds of call they are known to lead to.
    """
    json_header = '{"Content-Type":"application/json"}'
    rows = []
    for name in RULE_SETS:
        def rule(rule_id, salience, when, action, channel, target, **params):
            rows.append((name, rule_id, salience, when, action, channel, target, params))

        rule("registry_post", 10, "messagetype = 'REGISTRY_POST'", "POST", "REST", registry, header=json_header)
        rule("registry_put", 10, "messagetype = 'REGISTRY_PUT'", "PUT", "REST", registry, header=json_header)
        rule("registry_get", 10, "messagetype = 'REGISTRY_GET'", "GET", "REST", registry)
        rule("registry_response", 10, "messagetype = 'REGISTRY_RESPONSE'", "PUBLISH", "MQTT", broker,
             path="registry/response", clientId="parcelflow", qos="1", schema="registry")
        rule("onboarding", 10, "messagetype = 'DEVICE_ONBOARDING'", "POST", "REST", registry, header=json_header)
        if name == "oneid":
            rule("telemetry_store", 5, "messagetype = 'TELEMETRY'", "INSERT", "SQL", store)
        else:
            rule("telemetry_index", 5, "messagetype = 'TELEMETRY'", "POST", "ES", index, path="events")
        rule("exception_index", 1, "messagetype = 'EXCEPTION'", "POST", "ES", index, path="exceptions")
    return spark.createDataFrame(rows, RULE)
