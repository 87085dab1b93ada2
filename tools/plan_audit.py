"""Print plan red flags for every registered query (no data is computed).

Flags: exchanges to a single partition, nested-loop / cartesian joins, Python
evaluation, and the number of shuffle exchanges.
Usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hourwise.session import build_session  # noqa: E402
from hourwise.plans.catalog import queries  # noqa: E402

SKIP = {"row_numbering", "snapshot_manifest", "snapshot_verify", "export_ordered", "stream_hourly_mart",
        "stream_scored_hours", "stream_alert_state_log", "incremental_log", "completeness_gate"}  # run jobs to build


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]")
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in queries().items():
        if name in SKIP:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        flags = []
        lines = plan.splitlines()
        win_single = 0
        for i, ln in enumerate(lines):
            if "Exchange SinglePartition" in ln:
                above = " ".join(lines[max(0, i - 2):i])
                if "Window" in above:
                    win_single += 1
        if win_single:
            flags.append(f"single-partition-window x{win_single}")
        for pat in ("BroadcastNestedLoopJoin", "CartesianProduct"):
            if pat in plan:
                flags.append(pat)
        if "ArrowEvalPython" in plan or "BatchEvalPython" in plan or "FlatMapGroupsInPandas" in plan:
            flags.append("python")
        ex = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))
        scans = len(re.findall(r"Scan parquet [^\n]*events", plan)) + len(re.findall(r"FileScan parquet [^\n]*events", plan))
        print(f"{name:32s} exchanges={ex:2d} raw_scans={scans} {' '.join(flags)}")
    spark.stop()


if __name__ == "__main__":
    main()
