"""Look-ups of a stream from keyed state."""

import os
import time
import uuid

from pyspark.sql import functions as F

from parcelflow.streaming.enrich import enrich_stream, start_keyed


def _answers(spark, folder, checkpoint, out, lookup, **options):
    """One run of the stream over the files in `folder`, a file per batch."""
    stream = spark.readStream.schema("id long, name string, tags map<string,string>").option("maxFilesPerTrigger", 1).parquet(folder)
    answered = enrich_stream(stream, lookup, F.concat(F.lit("http://x/"), F.col("name")), F.lit(None).cast("string"), F.col("tags"), **options)
    writer = answered.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    start_keyed(spark, lambda: writer.start(out, format="parquet")).awaitTermination(120)


def _file(spark, folder, rows):
    spark.createDataFrame(rows, "id long, name string, tags map<string,string>").coalesce(1).write.mode("append").parquet(folder)


def _recording(calls):
    def lookup(request):
        open(f"{calls}/{uuid.uuid4().hex}", "w").write(f"{request['url']} {sorted(request['attr'].items())}")
        if request["url"] and request["url"].endswith("down"):
            raise ConnectionError("away")
        return f"{request['url']} {request['attr'].get('k')}"

    return lookup


def _asked(calls):
    return sorted(open(f"{calls}/{f}").read() for f in os.listdir(calls))


def test_one_call_per_request_over_batches_and_a_restart(spark, tmp_path):
    src, check, out, calls = (f"{tmp_path}/{n}" for n in ("in", "check", "out", "calls"))
    os.mkdir(calls)
    big = 2**62 + 1
    _file(spark, src, [(1, "a", {"k": "1"}), (2, "a", {"k": "1"}), (None, "b", None), (big, "down", {})])
    _file(spark, src, [(4, "a", {"k": "1"}), (5, "a", {"k": "2"}), (6, "down", {}), (7, None, None)])
    _answers(spark, src, check, out, _recording(calls))
    _file(spark, src, [(8, "a", {"k": "1"}), (9, None, None), (10, "b", None)])
    _answers(spark, src, check, out, _recording(calls))
    found = {(r.id, r.name, r.answer) for r in spark.read.parquet(out).collect()}
    assert found == {
        (1, "a", "http://x/a 1"), (2, "a", "http://x/a 1"), (None, "b", "http://x/b None"), (big, "down", "EXCEPTION_away"), (4, "a", "http://x/a 1"),
        (5, "a", "http://x/a 2"), (6, "down", "EXCEPTION_away"), (7, None, "None None"), (8, "a", "http://x/a 1"), (9, None, "None None"), (10, "b", "http://x/b None"),
    }
    # Once each, over three batches and two runs; the failing one once per batch that holds it.
    assert _asked(calls) == sorted(["http://x/a [('k', '1')]", "http://x/a [('k', '2')]", "http://x/b []", "None []", "http://x/down []", "http://x/down []"])


def test_answers_expire_and_spread_asks_per_part(spark, tmp_path):
    src, check, out, calls = (f"{tmp_path}/{n}" for n in ("in", "check", "out", "calls"))
    os.mkdir(calls)
    for _ in range(2):
        _file(spark, src, [(k, "hot", None) for k in range(200)])
        _answers(spark, src, check, out, _recording(calls), ttl_seconds=1, spread=4)
        time.sleep(1.5)
    rows = spark.read.parquet(out)
    assert rows.count() == 400 and rows.select("answer").distinct().count() == 1
    assert _asked(calls) == ["http://x/hot []"] * 8
