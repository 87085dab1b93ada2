"""Scale probe (experiment, not a registered query): the full refresh pipeline on
N time-shifted copies of the sf0.1 events (15 copies ~ 1.5M readings, the size of
the reference's source), timed end to end: once from Parquet readings, once from CSV files
(scan, validation and a written table of valid readings first).

Usage: python tools/scale_probe.py [copies] [sf_dir]
"""

from __future__ import annotations

import json
import posixpath
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from hourwise.plans.refresh import refresh  # noqa: E402
from hourwise.plans.catalog_sources import write_readings_csv  # noqa: E402
from hourwise.session import build_session, checkpoint_dir, materialize  # noqa: E402
from hourwise.sources.csv_ingest import fail_fast, scan_csv  # noqa: E402
from hourwise.sources.readings import load_table, readings_from_events, reports  # noqa: E402
from hourwise.spec import DEMO_V1  # noqa: E402


def main():
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 15
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    ev = load_table(spark, sf, "events")
    n = ev.count()
    big = (ev.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("event_id", F.col("event_id") + F.col("_k") * F.lit(n))
           .withColumn("ts", F.col("ts") + F.make_dt_interval(F.col("_k") * 30)).drop("_k"))
    stage = posixpath.join(checkpoint_dir(spark), "probe", uuid.uuid4().hex)
    big.write.parquet(posixpath.join(stage, "events"))  # materialise the input once (not timed)
    rd = readings_from_events(spark.read.parquet(posixpath.join(stage, "events")))
    t0 = time.perf_counter()
    res = refresh(spark, rd, reports(spark), DEMO_V1, posixpath.join(stage, "export"), "probe", "events")
    secs = time.perf_counter() - t0
    csv = write_readings_csv(spark, rd)
    t0 = time.perf_counter()
    loaded = materialize(fail_fast(scan_csv(spark, csv)), "probe_readings")
    ingest = time.perf_counter() - t0
    refresh(spark, loaded, reports(spark), DEMO_V1, posixpath.join(stage, "export_csv"), "probe", "events")
    whole = time.perf_counter() - t0
    state = res.state
    inv = res.tables["hourly_investigation"][0]
    print(json.dumps({"readings": state["original_rows"], "hours": inv.count(), "seconds": round(secs, 2),
                      "csv_ingest_seconds": round(ingest, 2), "csv_to_snapshot_seconds": round(whole, 2)}))


if __name__ == "__main__":
    main()
