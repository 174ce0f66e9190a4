"""Errors travel with their row; nothing stops a neighbouring message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import json_text as J
from ..schemas import DEAD_LETTER, ENVELOPE, ERROR
from .lookup import left_lookup


def problem(stage: str, exception: str, cause: str, trace: str, quoted: bool = True) -> str:
    """SQL of an error value; `stage` names the step that set the row aside.

    With ``quoted=False`` the exception is an expression instead of a text.
    """
    message = f"'{exception}'" if quoted else exception
    return f"named_struct('stage', '{stage}', 'exception', {message}, 'cause', '{cause}', 'trace', '{trace}')"


def no_problem() -> Column:
    return F.lit(None).cast(ERROR)


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows, with their columns computed before any later filter.

    Catalyst pushes a filter on a computed column below the projection and then
    computes the expression twice, once in the filter and once for the output;
    through a chain of projections the expression also grows with every step.
    It does not push through a generator, so the row passes through one.

    A generator also ends a stage of generated code. The JVM never compiles
    methods above 8000 bytes, so a long chain of projections runs several times
    faster when it is cut into stages below that size. Only names may stand
    inside the generator: it evaluates without generated code.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted envelopes and dead letters of a frame with `envelope` and `error` columns."""
    return accepted(df), dead_letters(df)


def accepted(df: DataFrame) -> DataFrame:
    return df.where("error IS NULL").select("envelope.*").select(*ENVELOPE.names)


def dead_letters(df: DataFrame) -> DataFrame:
    """Rows with an error, as messages with their position and what is wrong; a frame without positions gives NULL."""
    position = [F.col(n) if n in df.columns else F.lit(None).cast(DEAD_LETTER[n].dataType).alias(n) for n in ("partition", "offset")]
    return (
        df.where("error IS NOT NULL")
        .select("topic", *position, "key", "value", "error.*", F.col("timestamp").alias("ts"))
        .select(*DEAD_LETTER.names)
    )


def security_check(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Set aside rows the predicate does not accept; without one every row passes.

    The predicate may use the message columns and `msg`, the parsed message.
    NULL counts as refused. An earlier error is kept.
    """
    if predicate is None:
        return df
    refused = F.expr(problem("SECURITY", "message refused by the security check", "not accepted", "security_check"))
    return df.withColumn("error", F.coalesce("error", F.when(~F.coalesce(predicate, F.lit(False)), refused)))


def security_check_by_token(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Set aside messages whose `authentication` is not a token of their `sourceid`.

    `tokens` has `sourceid` and `token`, any number of tokens per source;
    repeated and NULL ones count for nothing. A message without either member
    is refused. An earlier error is kept.
    """
    said = df.withColumns({
        "_source": F.try_variant_get("msg", "$.sourceid", "string"), "_token": F.try_variant_get("msg", "$.authentication", "string"),
    })
    known = tokens.select(F.col("sourceid").alias("_source"), F.col("token").alias("_token")).distinct()
    checked = left_lookup(said, known.withColumn("_known", F.lit(True)), ["_source", "_token"])
    return security_check(checked, F.col("_known")).select(*df.columns)


def error_reports(letters: DataFrame) -> DataFrame:
    """Adds `body`: what the exception index stores for a dead letter.

    The message's own members plus EXCEPTION, EXCEPTION CAUSE and EXCEPTION
    TRACE. A message that is not a JSON object appears under RAW, in Base64
    when it is not text either.
    """
    report = {"EXCEPTION": "exception", "EXCEPTION CAUSE": "cause", "EXCEPTION TRACE": "trace"}
    added = F.create_map(*[part for name, column in report.items() for part in (F.lit(name), F.col(column).cast("variant"))])
    parsed = J.parse_object(J.utf8_text("value"))
    members = F.expr(f"try_variant_get({parsed}, '$', 'map<string,variant>')")
    raw = F.coalesce(F.try_validate_utf8(F.col("value").cast("string")), F.base64("value"))
    own = F.coalesce(
        F.map_filter(members, lambda name, _: ~name.isin(*report)),
        F.create_map(F.lit("RAW"), raw.cast("variant")),
    )
    return letters.withColumn("body", F.to_json(F.map_concat(own, added)))
