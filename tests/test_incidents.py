"""F2 island fixture: islands [2,1,1], history minima, stable ids, future hours don't change the past."""
from pyspark.sql import functions as F

from hourwise.operators import incidents as inc, marts, rule
from hourwise.sources.readings import reports
from hourwise.spec import PRESSURE_V1
from helpers import ORIGIN, READING_TYPES, island_rows
import datetime as dt


def pipeline(spark, rows):
    rd = spark.createDataFrame(rows, READING_TYPES)
    h = marts.hourly_mart(rd, PRESSURE_V1)
    inv = rule.investigation(h, reports(spark, rows=[]), PRESSURE_V1)
    return rd, h, inv, inc.incidents(inv, PRESSURE_V1)


def hour(h):
    return ORIGIN + dt.timedelta(hours=h)


def test_islands_and_statuses(spark):
    rd, h, inv, incs = pipeline(spark, island_rows())
    assert [r.candidate_hours for r in incs.orderBy("starts_at").collect()] == [2, 1, 1]
    st = {r.hour_ts: r for r in inv.collect()}
    assert st[hour(9)].candidate_status == "INSUFFICIENT_HISTORY" and st[hour(9)].prior_loaded_readings == 270
    assert st[hour(10)].candidate_status == "REVIEW_PRESSURE" and st[hour(10)].prior_low_fraction == 0.0
    first = incs.orderBy("starts_at").first()
    assert first.starts_at == hour(10) and first.ends_at == hour(12)
    # every raw row lands in exactly one hour
    assert rd.count() == h.agg(F.sum("readings")).first()[0] == 450


def test_ids_stable_and_future_rows_do_not_change_past(spark):
    _, _, inv1, inc1 = pipeline(spark, island_rows())
    _, _, inv2, inc2 = pipeline(spark, island_rows(extra_hours=(100,)))
    ids1 = {(r.starts_at, r.incident_id) for r in inc1.collect()}
    ids2 = {(r.starts_at, r.incident_id) for r in inc2.collect()}
    assert ids1 <= ids2 and len(ids2) == len(ids1) + 1
    a = inv1.filter(inv1.hour_ts == hour(10)).drop("overlaps_reported_failure").first()
    b = inv2.filter(inv2.hour_ts == hour(10)).drop("overlaps_reported_failure").first()
    assert a == b


def test_islands_across_chunk_boundaries(spark):
    """Runs crossing many small chunks equal the LAG + running-sum definition."""
    from hourwise.operators.incidents import assign_islands
    hours = [0, 1, 2, 3, 5, 6, 30, 31, 32, 33, 34, 35, 36, 37, 38, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 90]
    df = spark.createDataFrame([(ORIGIN + dt.timedelta(hours=x),) for x in hours], "hour_ts timestamp_ntz")
    got = {r.hour_ts: r.island_start for r in assign_islands(df, chunk_days=1).collect()}
    expect, start, prev = {}, None, None
    for x in hours:
        if prev is None or x != prev + 1:
            start = x
        expect[ORIGIN + dt.timedelta(hours=x)] = ORIGIN + dt.timedelta(hours=start)
        prev = x
    assert got == expect
