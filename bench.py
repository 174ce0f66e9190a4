"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelflow.plans.queries import QUERIES  # noqa: E402
from parcelflow.session import build_session  # noqa: E402

HEADLINE = (
    "parse_json", "message_text", "standardise", "registry_whole_message", "simple_wrap", "split_errors",
    "encode_avro", "decode_avro", "evaluate_rules", "evaluate_rules_joined", "lookup_rule_uri",
    "search_map", "search_json", "build_outbox", "deliver", "enrich_cached", "archive_raw", "run_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["standardise"](spark, folder).limit(1).collect()  # start-up is not part of any query
    only = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in only:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
