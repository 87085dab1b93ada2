"""Streams with sessions, timers and a late table, batch by batch, against their batch forms."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import ts
from hourwise.operators.incidents import incidents
from hourwise.operators.rule import INVESTIGATION_COLUMNS
from hourwise.spec import PRESSURE_V1, REVIEW_PRESSURE
from hourwise.streaming import dedup as D
from hourwise.streaming.alerts import evaluate_ticks
from hourwise.streaming.incidents import session_incidents, stream_incidents
from hourwise.streaming.timers import LATE, ROCKSDB, alert_states_with_timers

T0 = ts(2024, 1, 1)
SCORED = "asset_id long, hour_ts timestamp_ntz, readings long, loaded_readings long, low_pressure_loaded_readings long, " \
         "current_low_fraction double, candidate_status string, overlaps_reported_failure boolean"


def scored(spark, rng, hours, assets=(1, 2, None)):
    rows = [(a, T0 + dt.timedelta(hours=h), 30, 20, rng.randrange(20), rng.random(),
             REVIEW_PRESSURE if rng.random() < 0.6 else "NO_CANDIDATE", rng.random() < 0.2) for a in assets for h in hours if rng.random() < 0.95]
    return rows, spark.createDataFrame(rows, SCORED)


def test_sessions_equal_batch_incidents(spark, tmp_path):
    """Hours in several batches; a run over the edge of two batches is one incident; the newest stays open."""
    rng = random.Random(2)
    rows, whole = scored(spark, rng, range(120))
    assert len(INVESTIGATION_COLUMNS) > 30
    src, sink, ck = (str(tmp_path / x) for x in ("scored", "out", "ck"))
    seen = []
    for lo in range(0, 120, 24):
        spark.createDataFrame([r for r in rows if lo <= (r[1] - T0).total_seconds() / 3600 < lo + 24], SCORED).write.mode("append").parquet(src)
        stream_incidents(spark, src, whole.schema, sink, ck, PRESSURE_V1, keys=["asset_id"]).awaitTermination()
        seen.append(spark.read.parquet(sink).count())
    assert seen == sorted(seen) and seen[0] > 0
    want = incidents(whole, PRESSURE_V1, ["asset_id"]).filter(F.col("ends_at") <= F.lit(max(r[1] for r in rows) - dt.timedelta(hours=1)).cast("timestamp_ntz"))
    got = spark.read.parquet(sink)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() < incidents(whole, PRESSURE_V1, ["asset_id"]).count()
    later = [(1, T0 + dt.timedelta(hours=h), 30, 20, 0, 0.1, "NO_CANDIDATE", False) for h in (130, 131)]
    spark.createDataFrame(later, SCORED).write.mode("append").parquet(src)
    stream_incidents(spark, src, whole.schema, sink, ck, PRESSURE_V1, keys=["asset_id"]).awaitTermination()
    assert spark.read.parquet(sink).count() == incidents(whole, PRESSURE_V1, ["asset_id"]).count(), "hours that are no candidates close runs too"
    batch = session_incidents(whole, PRESSURE_V1, keys=["asset_id"])  # the same sessions without a stream
    assert sorted(map(tuple, batch.collect()), key=repr) == sorted(map(tuple, incidents(whole, PRESSURE_V1, ["asset_id"]).collect()), key=repr)


@pytest.fixture
def rocksdb(spark):
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    yield
    for k in ROCKSDB:
        spark.conf.unset(k)


def test_timers_order_ticks_and_tell_late_ones(spark, tmp_path, rocksdb):
    import numpy as np
    rng = random.Random(5)
    every = [("a", T0 + dt.timedelta(minutes=m), float(rng.random() < 0.3)) for m in range(0, 3000, 7)]
    every += [("always", T0 + dt.timedelta(minutes=m), 1.0) for m in range(0, 3000, 3)] + [("off", T0, 1.0)]
    schema, src, sink, ck = "alert string, tick timestamp_ntz, value double", *(str(tmp_path / x) for x in ("ticks", "out", "ck"))
    # batches by time, but every tick up to 100 minutes too early or too late, and one very late tick at the end
    place = lambda t: (t[1] - T0).total_seconds() / 60 + rng.randrange(-100, 100)
    placed = sorted(((place(t), t) for t in every), key=lambda x: x[0])
    batches = [[t for p, t in placed if lo <= p < lo + 1000] for lo in (-1000, 0, 1000, 2000, 3000)]
    batches.append([("a", T0 + dt.timedelta(minutes=1), 1.0), ("a", T0 + dt.timedelta(minutes=9000), 0.0)])
    batches.append([("a", T0 + dt.timedelta(minutes=2), 1.0)])
    active = spark.createDataFrame([("a", True), ("always", True), ("off", False)], "alert string, active boolean")
    for b in batches:
        if not b:
            continue
        spark.createDataFrame(b, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        q = (alert_states_with_timers(stream, 3600, ">", 0.5, "4 hours", 1800, active).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.parquet(sink).collect()
    late = [r for r in got if r.state == LATE]
    assert {(r.alert, r.tick) for r in late} <= {("a", T0 + dt.timedelta(minutes=m)) for m in (1, 2)}
    for alert in ("a", "always"):
        own = sorted(t for a, t, _ in every if a == alert)
        value = {t: v for a, t, v in every if a == alert}
        us = np.array([int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for t in own])
        states, _ = evaluate_ticks(us, np.array([value[t] for t in own]), None, 3600 * 10 ** 6, ">", 0.5)
        assert sorted((r.tick, r.state) for r in got if r.alert == alert and r.state != LATE) == list(zip(own, states))
    assert not [r for r in got if r.alert == "off"]


def test_kept_duplicate_and_late_rows_add_up(spark, tmp_path):
    schema, root = "id long, at timestamp_ntz", str(tmp_path / "s")
    at = lambda h: T0 + dt.timedelta(hours=h)
    batches = [[(i, at(i)) for i in range(48)],
               [(i, at(i)) for i in range(48, 60)] + [(47, at(47)), (46, at(46)), (900, at(3)), (901, None)],
               [(59, at(59)), (59, at(59)), (61, at(61)), (902, at(30))]]
    inbox, kept = str(tmp_path / "inbox"), str(tmp_path / "kept")
    for b in batches:
        spark.createDataFrame(b, schema).write.mode("append").parquet(inbox)
        D.split_late(spark.readStream.schema(schema).parquet(inbox), "at", root, str(tmp_path / "c1"), 24 * 3600).awaitTermination()
        D.deduplicated(spark, root, schema, ["id"], "at", kept, str(tmp_path / "c2"), 24 * 3600).awaitTermination()
    r = D.balance(spark, root, kept, schema).first()
    assert r.asDict() == {"kept": 61, "duplicate": 4, "late": 3} and sum(r) == sum(map(len, batches))
    late = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(f"{root}/{D.LATE}")
    assert sorted(x.id for x in late.collect()) == [900, 901, 902]
