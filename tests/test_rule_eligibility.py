"""F4 hourly micro-fixtures: exclusion reasons, inclusive minima, 7-day boundary, NULL-rate defence."""
import datetime as dt

import pytest

from hourwise.operators import rule
from hourwise.sources.readings import reports
from hourwise.spec import PRESSURE_V1
from helpers import hourly_rows

D = dt.datetime


def evaluate(spark, rows, target):
    h = hourly_rows(spark, rows)
    inv = rule.investigation(h, reports(spark, rows=[]), PRESSURE_V1)
    return inv.filter(inv.hour_ts == target).first().asDict()


def test_current_only(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 300, 300, 0), (D(2020, 1, 2), 360, 29, 0)], D(2020, 1, 2))
    assert r["exclusion_reason"].startswith("Current only") and r["evaluation_status"] == "Not evaluated"
    assert r["candidate_status"] == "INSUFFICIENT_HISTORY"


def test_baseline_only_prior_299(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 299, 299, 0), (D(2020, 1, 2), 360, 30, 0)], D(2020, 1, 2))
    assert r["prior_loaded_readings"] == 299 and r["exclusion_reason"].startswith("Baseline only")
    assert r["rule_eligible"] is False


def test_both_and_null_rates(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 360, 0, 0)], D(2020, 1, 1))
    assert r["prior_loaded_readings"] is None and r["prior_observed_hours"] == 0
    assert r["current_low_fraction"] is None and r["prior_low_fraction"] is None
    assert r["exclusion_reason"].startswith("Both")
    assert r["prior_unobserved_hour_windows"] == 168


def test_eligible_no_breach_inclusive_minima(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 300, 300, 0), (D(2020, 1, 2), 360, 30, 0)], D(2020, 1, 2))
    assert r["rule_eligible"] is True and r["prior_low_fraction"] == 0.0
    assert r["evaluation_status"] == "Evaluated: no breach" and r["exclusion_reason"] == "None: evaluated"


def test_seven_day_calendar_window(spark):
    rows = [(D(2019, 12, 31, 23), 300, 300, 300), (D(2020, 1, 1), 300, 300, 0),
            (D(2020, 1, 8), 360, 40, 6), (D(2020, 1, 9), 300, 300, 300)]
    r = evaluate(spark, rows, D(2020, 1, 8))
    assert r["prior_loaded_readings"] == 300 and r["prior_low_readings"] == 0 and r["prior_observed_hours"] == 1
    assert r["candidate_status"] == "REVIEW_PRESSURE" and r["evaluation_status"] == "Evaluated: breach"


def test_outside_window_not_evaluated(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 300, 300, 0), (D(2020, 1, 9), 360, 40, 6)], D(2020, 1, 9))
    assert r["prior_loaded_readings"] is None and r["evaluation_status"] == "Not evaluated"


def test_both_thresholds_required(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 300, 300, 30), (D(2020, 1, 2), 360, 40, 6)], D(2020, 1, 2))
    assert r["rule_eligible"] is True and r["candidate_status"] == "NO_CANDIDATE"  # 0.15 < 2 x 0.10


def test_missing_rate_defence(spark):
    r = evaluate(spark, [(D(2020, 1, 1), 300, 300, None), (D(2020, 1, 2), 360, 40, 6)], D(2020, 1, 2))
    assert r["prior_low_fraction"] is None and r["evaluation_status"] == "Not evaluated"
    assert r["exclusion_reason"] == "Missing rate despite sufficient counts"
    assert r["candidate_status"] == "NO_CANDIDATE"  # legacy status falls through (D12)


@pytest.mark.parametrize("chunk_days", [1, 3, 28])
def test_chunk_size_does_not_change_baseline(spark, chunk_days):
    from hourwise.operators.baseline import trailing_baseline
    rows = [(D(2020, 1, 1) + dt.timedelta(hours=7 * i), 100, 50 + i, i) for i in range(60)]
    h = hourly_rows(spark, rows)
    a = {r.hour_ts: (r.prior_loaded_readings, r.prior_observed_hours)
         for r in trailing_baseline(h, 7 * 86400, keys=[], chunk_days=chunk_days).collect()}
    b = {r.hour_ts: (r.prior_loaded_readings, r.prior_observed_hours)
         for r in trailing_baseline(h, 7 * 86400, keys=[], chunk_days=1000).collect()}
    assert a == b
