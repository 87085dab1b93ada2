"""Incremental marts against full builds, on written files."""
import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import ts
from helpers import READING_TYPES
from hourwise.operators import incidents as inc, marts, rule
from hourwise.plans import incremental as N, refresh as R
from hourwise.plans.catalog import SPEC as DEMO
from hourwise.sources.readings import reports
from hourwise.spec import PRESSURE_V1

SPEC = replace(PRESSURE_V1, min_current_loaded=2, min_prior_loaded=4)
DAY0 = ts(2020, 4, 1)


def rows(hours, seed=1, low=lambda h: h % 5 == 0):
    """Three loaded readings an hour; pressure is low in some hours."""
    out = []
    for h in hours:
        rng = random.Random(1000 * seed + h)  # an hour's readings do not depend on the others
        for k in range(3):
            out.append((len(out) + 1, DAY0 + dt.timedelta(hours=h, minutes=20 * k), 5.0, 6.0 if low(h) else 8.5 + rng.random(), 5.0, 1.0,
                        8.5, 45.0, 7.0, 0, 0, 0, 0, 0, 0, 0, 0.0))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, READING_TYPES)


def full(spark, rd, rep):
    hourly = marts.hourly_mart(rd, SPEC)
    inv = rule.investigation(hourly, rep, SPEC)
    return {"hourly": hourly, "daily": marts.daily_mart(hourly), "scored": inv, "incidents": inc.incidents(inv, SPEC)}


def same(m, spark, rd, rep):
    fixed = lambda df: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()], key=repr)
    for name, want in full(spark, rd, rep).items():
        assert fixed(m.read(name).select(*want.columns)) == fixed(want), name


def files(m, name):
    return {(r.day, r.f) for r in m.read(name).select("day", F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_appended_rows_rewrite_their_day_and_the_look_back_only(spark, tmp_path):
    base = rows(h for h in range(24 * 20) if h // 24 != 9 or h % 24 < 8)
    late = rows((h for h in range(24 * 9 + 8, 24 * 10)), 2, low=lambda h: h % 24 > 20)
    rep = reports(spark, [(1, ts(2020, 4, 10, 20), ts(2020, 4, 11, 3), "x")])
    m = N.Marts(spark, str(tmp_path / "m"), SPEC)
    m.build(frame(spark, base), rep)
    same(m, spark, frame(spark, base), rep)
    before = {n: files(m, n) for n in N.TABLES}
    all_rows = frame(spark, base + late)
    done = m.refresh(all_rows, rep, N.changed_days(frame(spark, late)))
    same(m, spark, all_rows, rep)
    day = dt.date(2020, 4, 10)
    assert done["hourly"] == done["daily"] == [day]
    assert done["scored"] == [day + dt.timedelta(days=i) for i in range(8)]
    for n in N.TABLES:
        assert {x for x in before[n] if x[0] not in done[n]} == {x for x in files(m, n) if x[0] not in done[n]}, n
        assert not {x for x in before[n] if x[0] in done[n]} & files(m, n), n


def test_random_changes_join_split_and_remove_incidents(spark, tmp_path):
    """Runs that cross the closure's edges, days that vanish, and reports that come later."""
    rng = random.Random(4)
    hours = {h: h % 24 in (0, 1, 22, 23) or h % 7 == 0 for h in range(24 * 16) if rng.random() < 0.9}
    make = lambda: frame(spark, rows(sorted(hours), 1, low=lambda h: hours[h]))
    rep = reports(spark, [(1, ts(2020, 4, 3, 20), ts(2020, 4, 4, 3), "x")])
    m = N.Marts(spark, str(tmp_path / "m"), SPEC)
    m.build(make(), rep)
    for step in range(3):
        days = rng.sample(range(16), 2)
        for d in days:
            for h in range(24 * d, 24 * d + 24):
                if step == 1:
                    hours.pop(h, None)  # a day without any reading
                else:
                    hours[h] = rng.random() < 0.6
        m.refresh(make(), rep, [DAY0.date() + dt.timedelta(days=d) for d in days])
        same(m, spark, make(), rep)
    more = reports(spark, [(1, ts(2020, 4, 3, 20), ts(2020, 4, 4, 3), "x"), (2, ts(2020, 4, 13, 1), ts(2020, 4, 13, 9), "y")])
    assert m.refresh(make(), more, [], report_days=[dt.date(2020, 4, 13)])["hourly"] == []
    same(m, spark, make(), more)
    assert m.refresh(make(), more, []) == {n: [] for n in N.TABLES}


def test_a_refresh_that_was_cut_off_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    base, late = rows(range(24 * 10)), rows(range(24 * 4, 24 * 4 + 24), 3, low=lambda h: True)
    rep = reports(spark, [])
    m = N.Marts(spark, str(tmp_path / "m"), SPEC)
    m.build(frame(spark, base), rep)
    all_rows = frame(spark, base + late)
    replay = N.Marts.replay
    monkeypatch.setattr(N.Marts, "replay", lambda self: (_ for _ in ()).throw(RuntimeError("lost")) if N.exists(
        self.spark, self.path(N.REDO)) else False)
    with pytest.raises(RuntimeError, match="lost"):
        m.refresh(all_rows, rep, [dt.date(2020, 4, 5)])
    monkeypatch.setattr(N.Marts, "replay", replay)
    same(m, spark, frame(spark, base), rep)  # nothing has been replaced yet
    assert m.replay() and not m.replay()
    same(m, spark, all_rows, rep)


def test_closure_and_spans():
    d = dt.date(2020, 2, 27)
    assert N.closure([d], 7 * 86400) == [d + dt.timedelta(days=i) for i in range(8)]
    assert N.spans([d + dt.timedelta(days=3), d, d + dt.timedelta(days=1)]) == [
        (d, d + dt.timedelta(days=2)), (d + dt.timedelta(days=3), d + dt.timedelta(days=4))]


def test_changed_days_reach_the_scan_as_a_range(spark):
    from hourwise.plans.catalog import readings
    plan = marts.hourly_mart(readings(spark, "/root/testdata/sf0.001").filter(N.on_days([dt.date(2024, 1, 12)], "observed_at")), DEMO)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(ts" in text


# ---------------------------------------------------------------- counts observed in the jobs themselves

def test_refresh_scans_raw_once_and_gates_on_observed_counts(spark, tmp_path, monkeypatch):
    data = rows(range(24 * 3))
    path = str(tmp_path / "raw")
    frame(spark, data).write.parquet(path)
    rd = spark.read.parquet(path)
    counted = spark.sparkContext.accumulator(0)

    def passes(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b
    watched = rd.mapInArrow(passes, rd.schema)
    out = R.refresh(spark, watched, reports(spark, []), SPEC, str(tmp_path / "out"), "run", "raw", count_duplicates=False)
    assert counted.value == len(data), "one pass over the raw rows"
    assert set(out.counts.values()) == {len(data)} and out.state["duplicate_timestamps"] is None
    assert (out.state["first_reading"], out.state["last_reading"]) == (data[0][1], data[-1][1])
    R.refresh(spark, watched, reports(spark, []), SPEC, str(tmp_path / "out"), "run2", "raw")
    assert counted.value == 3 * len(data), "and one more, of a single column, for duplicates"


def test_gate_refuses_after_recount_and_leaves_no_staging(spark, tmp_path, monkeypatch):
    from hourwise.sources import snapshot as S
    rd = frame(spark, rows(range(30)))
    monkeypatch.setattr(R.marts, "daily_mart", lambda h, keys=None, f=marts.daily_mart: f(h.filter("hour(hour_ts) > 2"), keys))
    with pytest.raises(S.SnapshotError, match="reconcile"):
        R.refresh(spark, rd, reports(spark, []), SPEC, str(tmp_path / "out"), "run", "raw")
    assert not [p for p in (tmp_path / "out").rglob("*") if p.name == "CURRENT" or "run" in p.name]


def test_observed_counts_that_disagree_are_counted_again(spark):
    rd = frame(spark, rows(range(5)))
    h = R.materialize(marts.hourly_mart(rd, SPEC), "t")
    for seen, raw in ((R.ObservedCounts(), rd), (R.ObservedCounts(), rd.unionByName(rd))):  # as if tasks had run twice
        R.materialize(seen.watched_mart(marts.hourly_mart(seen.watched(raw), SPEC)), "t")
        obs, total = seen.daily_export()
        R.materialize(marts.daily_mart(h).observe(obs, *total), "t")
        assert seen.counts(rd, h, marts.daily_mart(h)) == {"raw_rows": 15, "hourly_rows": 15, "daily_rows": 15}
