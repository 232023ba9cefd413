"""Runs the headline queries and prints one JSON line with their times in seconds.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.  Every query is run to its last row
into a sink that stores nothing; the first, untimed one warms up the session.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.plans.queries import QUERIES  # noqa: E402
from riskloom.session import local_session  # noqa: E402

HEADLINE = (
    "q_decode_transactions",
    "q_features",
    "q_decisions",
    "q_latest_decision",
    "q_ops_summary",
    "q_volume_by_minute",
    "q_investigation_queue",
    "q_roc_auc",
    "q_reliability",
    "q_ordered_split",
    "q_arrival_features",
    "q_outcome_counters",
    "q_latency_percentiles",
    "q_lag_alerts",
    "q_stall_alerts",
    "q_message_decisions",
    "q_stream_decisions",
)
SCORED = "q_decisions"


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, SCORED, sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "events": rows,
                "scored_events_per_second": round(rows / seconds[SCORED], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
