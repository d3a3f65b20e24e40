"""Headline timings: one JSON line on standard output.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local threads. Each query runs once to warm up and then twice; the
median counts. A lazy query is timed to its last row (``noop`` sink); a query that writes tables includes those writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cambio.session import build_session  # noqa: E402
from checks.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "decode_documents",
    "normalize_li",
    "distinct_quotes",
    "merge_quotes_li",
    "merge_quotes_li_shuffled",
    "committed_quotes_li",
    "committed_quotes_li_shuffled",
    "latest_price_per_pair",
    "latest_price_hot_pairs",
    "alerts_li",
    "documents_to_alerts",
    "daily_load",
    "stream_load",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        timings[name] = round(statistics.median(once(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
