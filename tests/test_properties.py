"""Property tests on random hour tables (Hypothesis): two derivations must agree."""
import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hourwise.operators.baseline import trailing_baseline, trailing_baseline_join
from hourwise.operators.incidents import assign_islands
from hourwise.operators.marts import daily_mart, hourly_mart
from hourwise.operators.timegrid import asfreq, resample_null_check
from hourwise.spec import PRESSURE_V1
from helpers import READING_TYPES

ORIGIN = dt.datetime(2021, 3, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

hour_sets = st.lists(st.integers(min_value=0, max_value=24 * 40), min_size=1, max_size=60, unique=True)


@SETTINGS
@given(hours=hour_sets, seed=st.integers(0, 1000))
def test_window_equals_self_join(spark, hours, seed):
    rows = [(ORIGIN + dt.timedelta(hours=h), (h * 7 + seed) % 50, (h * 3 + seed) % 11) for h in hours]
    df = spark.createDataFrame(rows, "hour_ts timestamp_ntz, loaded long, low long")
    w = trailing_baseline(df, 7 * 86400, 3600, sums={"loaded": "prior_loaded", "low": "prior_low"},
                          count_name="prior_hours", chunk_days=3)
    j = trailing_baseline_join(df, 7 * 86400)
    key = ["hour_ts", "prior_loaded", "prior_low", "prior_hours"]
    assert sorted(map(tuple, w.select(key).collect())) == sorted(map(tuple, j.select(key).collect()))


@SETTINGS
@given(hours=hour_sets)
def test_islands_equal_sequential_definition(spark, hours):
    df = spark.createDataFrame([(ORIGIN + dt.timedelta(hours=h),) for h in hours], "hour_ts timestamp_ntz")
    got = {r.hour_ts: r.island_start for r in assign_islands(df, chunk_days=2).collect()}
    expect, start, prev = {}, None, None
    for h in sorted(hours):
        if prev is None or h != prev + 1:
            start = h
        expect[ORIGIN + dt.timedelta(hours=h)] = ORIGIN + dt.timedelta(hours=start)
        prev = h
    assert got == expect


@SETTINGS
@given(hours=hour_sets)
def test_resample_inserts_only_null_points(spark, hours):
    df = spark.createDataFrame([(ORIGIN + dt.timedelta(hours=h), float(h)) for h in hours], "ts timestamp_ntz, v double")
    res = asfreq(df, "ts", 3600)
    r = resample_null_check(df, res, "ts", ["v"]).first()
    assert r.inserted_non_null_points == 0
    assert r.grid_points == max(hours) - min(hours) + 1 and r.present_points == len(hours)


@SETTINGS
@given(secs=st.lists(st.integers(min_value=0, max_value=3 * 86400), min_size=1, max_size=80))
def test_daily_rollup_equals_direct_daily(spark, secs):
    rows = [(i + 1, ORIGIN + dt.timedelta(seconds=s), 1.0, float(s % 13), 1.0, 1.0, float(s % 9), 40.0 + s % 5,
             float(s % 12), 0, 0, 0, 0, s % 2, 0, 0, 0.0) for i, s in enumerate(secs)]
    rd = spark.createDataFrame(rows, READING_TYPES)
    d = daily_mart(hourly_mart(rd, PRESSURE_V1))
    direct = (rd.groupBy(F.to_date("observed_at").alias("reading_date"))
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("motor_current") >= 6).alias("loaded"),
                   F.avg("tp3").alias("panel")))
    a = {r.reading_date: (r.readings, r.loaded_readings, round(r.avg_panel_pressure_bar, 9)) for r in d.collect()}
    b = {r.reading_date: (r.n, r.loaded, round(r.panel, 9)) for r in direct.collect()}
    assert a == b


def test_stitched_lag_balances_a_hot_hour(spark):
    """A third of all rows in one hour (distinct microsecond stamps) is split across buckets."""
    from hourwise.operators.timegrid import quantile_buckets, stitched_lag
    base = [ORIGIN + dt.timedelta(minutes=7 * i) for i in range(2000)]
    burst = [ORIGIN + dt.timedelta(days=3, microseconds=17 * i) for i in range(1000)]
    stamps = base + burst
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    sizes = [r["count"] for r in df.groupBy(quantile_buckets(df, "ts", 8).alias("b")).count().collect()]
    assert max(sizes) < 0.25 * len(stamps)
    got = {r.ts: r.prev for r in stitched_lag(df, "ts", "ts", "prev", buckets=8).collect()}
    ordered = sorted(stamps)
    assert got == {t: (ordered[i - 1] if i else None) for i, t in enumerate(ordered)}


@SETTINGS
@given(days=st.lists(st.tuples(st.integers(0, 20), st.integers(1, 500), st.integers(0, 500), st.integers(0, 500)),
                     min_size=1, max_size=15, unique_by=lambda x: x[0]),
       cut=st.integers(0, 20))
def test_period_kpis_additive_over_disjoint_periods(spark, days, cut):
    from hourwise.operators import period as P
    from hourwise.sources.readings import reports
    rows = [(dt.date(2021, 3, 1) + dt.timedelta(days=d), n, min(l, n), min(lo, l, n)) for d, n, l, lo in days]
    daily = spark.createDataFrame(rows, "reading_date date, readings long, loaded_readings long, "
                                        "low_pressure_loaded_readings long")
    hourly = spark.createDataFrame([], "hour_ts timestamp_ntz, candidate_status string")
    inc = spark.createDataFrame([], "starts_at timestamp_ntz, ends_at timestamp_ntz")
    t = {"daily": daily, "hourly": hourly, "incidents": inc, "reports": reports(spark, rows=[])}
    first, last, mid = dt.date(2021, 3, 1), dt.date(2021, 3, 21), dt.date(2021, 3, 1) + dt.timedelta(days=cut)

    def k(a, b):
        return P.kpis(P.select_period(t, a, b)).first()
    whole = k(first, last)
    left = k(first, mid)
    right = k(mid + dt.timedelta(days=1), last)
    assert whole.readings == left.readings + right.readings
    assert whole.loaded_readings == left.loaded_readings + right.loaded_readings
