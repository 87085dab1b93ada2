"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the ``noop`` sink (full computation,
no driver collect); the value is the sum of per-query seconds after one
warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourwise.plans.catalog import queries  # noqa: E402
from hourwise.session import build_session  # noqa: E402

HEADLINE = ["hourly_mart", "hourly_mart_by_asset", "daily_mart", "investigation", "investigation_by_asset",
            "incidents", "report_review", "period_kpis", "k12_hourly_share_baseline", "data_quality",
            "audit_cadence", "window_vs_join_mismatch", "audit_largest_gaps", "independent_recheck",
            "alert_state_log", "validate_rows",
            # end-to-end: CSV written and re-ingested with file-order row numbers; gated snapshot publish
            "row_numbering", "snapshot_manifest"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="hourwise-bench")
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    qs["hourly_mart"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_query_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
