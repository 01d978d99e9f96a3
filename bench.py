"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row computed, none
collected), $BENCH_REPEAT times (default 5) after an untimed warm-up; the
median per query is reported and the metric is the sum of medians. The full
lifecycle (plans/run.py) is timed once as ``lifecycle_sec``. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from yardstick.plans import catalog  # noqa: E402
from yardstick.session import build_session  # noqa: E402

HEADLINE = (
    "stg_batch", "stg_stream", "combined", "year_over_year", "target_gaps", "scores", "dim_countries",
    "tracker", "goal_summary", "peer_comparison", "fan_out", "publish_stats", "upsert_two_loads",
    "gate_report", "column_tests", "api_normalise", "lake_validated_records", "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)
    log_dir = tempfile.mkdtemp(prefix="yardstick-bench-events-", dir="/tmp")
    spark = build_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), "yardstick-bench",
                          event_log_dir=log_dir)
    qs = catalog.queries()
    # warm-up (JIT, class loading, code generation of the shared plan shapes), not timed
    for name in ("stg_goals", "tracker"):
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - reported, not hidden: listed under "failed"
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name] = round(statistics.median(runs), 3)
    # the whole transform lifecycle once (gate, materialised panel, seven marts, 28
    # column tests): the counterpart of the reference's published pipeline run
    lifecycle = None
    if os.environ.get("BENCH_LIFECYCLE", "1") == "1":
        from yardstick.plans.run import run
        try:
            t0 = time.perf_counter()
            run(spark, sf_dir, tempfile.mkdtemp(prefix="yardstick-bench-marts-", dir="/tmp"), gate_mode="report")
            lifecycle = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - the query metric above is the bench result
            lifecycle = f"failed: {type(e).__name__}"
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "lifecycle_sec": lifecycle,
        "failed": failed,
        "event_log": log_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
