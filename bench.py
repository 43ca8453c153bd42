"""Benchmark: run the headline analyses and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is evaluated in full through Spark's ``noop`` sink (no collect).
Every query reads the test tables; the first one also pays for the warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from smogmesh.plans.catalog import queries  # noqa: E402
from smogmesh.session import local_session  # noqa: E402

HEADLINE = (
    "clean_readings",
    "quality_profile",
    "hourly_profile",
    "weekday_profile",
    "critical_periods",
    "station_ranking",
    "network_total",
    "anomalies_fixed",
    "anomalies_zscore",
    "anomalies_iqr",
    "anomalies_context",
    "anomaly_summary",
    "graph_vertices",
    "graph_edges",
    "critical_stations",
    "propagation",
    "components",
    "city_summary",
    "correlations",
    "stream_abnormal",
    "model_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="smogmesh-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    times: dict[str, float] = {}
    registry = queries()
    failed: dict[str, str] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # record and go on: one failure must not hide the rest
            failed[name] = str(exc).splitlines()[0][:200]
            continue
        times[name] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    out = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
