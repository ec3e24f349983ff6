"""Time the headline queries (best of two runs) and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom.session import build_session  # noqa: E402
from clickloom.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "gold_snapshots",
    "gold_with_split",
    "gold_tables",
    "silver_events",
    "session_split_map",
    "extended_features",
    "replay_events",
    "encoded_features",
    "pr_summary",
    "online_metrics",
    "price_quantiles",
    "session_medians",
    "drift",
    "stream_serving_rows",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute every row and column of it."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "clickloom-bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "type_counts", sf_dir)  # start the JVM and its compilers
    seconds = {
        name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
        for name in wanted
    }
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
