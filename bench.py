"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs twice; the second run is reported, so that JVM warm-up is not part of it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from alertloom.session import build_session
from alertloom.verification import registry

HEADLINE = [
    "daily_volume_by_severity",
    "noisy_rules",
    "time_to_triage",
    "triage_by_hour",
    "mitre_coverage",
    "hourly_heatmap",
    "burst_detection",
    "top_source_ips",
    "attack_chains",
    "analyst_workload",
    "untriaged_high_severity",
    "weekly_trend_after_tuning",
    "host_hour_features",
    "host_hour_excess",
    "baseline_ranking",
    "anomaly_scores",
    "host_hour_scores",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "alertloom-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times = {}
    for name in names:
        run(queries[name], spark, sf_dir)
        times[name] = round(run(queries[name], spark, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
