"""Registered saved queries K01-K16 of the semantic metric layer (M0-M7).

Period-scoped unless marked full-source; the period filter sits above the
baseline window (the investigation table is computed on all hours first).
"""

from __future__ import annotations

from hourwise.operators import intervals, marts, quality as Q, review
from hourwise.plans import oracle as O
from hourwise.plans.catalog import BREACHES, REVIEWED, SPEC, _sql, candidates, hourly, incidents, investigation, query, readings, reports
from hourwise.plans.catalog_more import HI, HI_SQL, LO, LO_SQL, QUALITY, demo_state
from hourwise.plans.metrics import datasets, metric_query
from hourwise.sources.readings import LOGGED_SQL, logged_reports
from hourwise.spec import REVIEW_PRESSURE

DS = datasets(SPEC)
RANGE = (LO, HI)
ALL = O.chain(upto="all")
_PH = f"hour_ts >= {LO_SQL} AND hour_ts < {HI_SQL}"
_PS = f"starts_at >= {LO_SQL} AND starts_at < {HI_SQL}"
_PD = f"reading_date >= CAST({LO_SQL} AS DATE) AND reading_date < CAST({HI_SQL} AS DATE)"


def _inv(spark, d):
    return investigation(spark, d)


@query("k01_observations", _sql(ALL, f"SELECT CAST(COALESCE(SUM(readings), 0) AS BIGINT) AS observations "
                                     f"FROM hourly WHERE {_PH}"))
def k01(spark, d):
    """K1: Observations (mart_hourly, period)."""
    return metric_query(hourly(spark, d), DS["mart_hourly"], ["observations"], time_range=RANGE)


@query("k02_candidate_hours", _sql(ALL, f"SELECT COUNT(*) FILTER (WHERE candidate_status = 'REVIEW_PRESSURE') "
                                        f"AS candidate_hours FROM investigation WHERE {_PH}"))
def k02(spark, d):
    """K2: Candidate hours."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], ["candidate_hours"], time_range=RANGE)


@query("k03_candidate_incidents", _sql(ALL, f"SELECT COUNT(*) AS candidate_incidents FROM incidents WHERE {_PS}"))
def k03(spark, d):
    """K3: Candidate incidents (filtered by incident start)."""
    return metric_query(incidents(spark, d), DS["mart_incidents"], ["candidate_incidents"], time_range=RANGE)


@query("k04_eligible_hours", _sql(ALL, f"SELECT COUNT(*) FILTER (WHERE rule_eligible) AS eligible_hours "
                                       f"FROM investigation WHERE {_PH}"))
def k04(spark, d):
    """K4: Eligible hours."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], ["eligible_hours"], time_range=RANGE)


@query("k05_eligibility_pct", _sql(ALL, f"SELECT CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE rule_eligible) "
                                        f"/ NULLIF(COUNT(*), 0) AS eligibility_pct FROM investigation WHERE {_PH}",
                                   ["eligibility_pct"]))
def k05(spark, d):
    """K5: Eligibility % (NULL for an empty period)."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], ["eligibility_pct"], time_range=RANGE)


@query("k06_not_evaluated_hours", _sql(ALL, f"SELECT COUNT(*) FILTER (WHERE evaluation_status = 'Not evaluated') "
                                            f"AS not_evaluated_hours FROM investigation WHERE {_PH}"))
def k06(spark, d):
    """K6: Not evaluated hours."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], ["not_evaluated_hours"], time_range=RANGE)


def _daily_series(metric, avg_col):
    body = f"""s AS (
  SELECT CAST(reading_date AS TIMESTAMP) AS ts,
    SUM({avg_col} * readings) / NULLIF(SUM(readings), 0) AS {metric}
  FROM daily WHERE {_PD} GROUP BY 1),
grid AS (SELECT UNNEST(generate_series(MIN(ts), MAX(ts), INTERVAL 1 DAY)) AS ts FROM s)"""
    return _sql(ALL + [body], f"SELECT g.ts, s.{metric} FROM grid g LEFT JOIN s ON s.ts = g.ts", [metric])


@query("k07_daily_panel_pressure", _daily_series("panel_pressure", "avg_panel_pressure_bar"))
def k07(spark, d):
    """K7: daily panel pressure (daily mart, reweighted), resampled daily with NULL gaps."""
    daily = marts.daily_mart(hourly(spark, d))
    return metric_query(daily, DS["mart_daily"], ["panel_pressure"], time_range=RANGE, grain="day",
                        timeseries=True, resample=True)


@query("k08_daily_oil_temperature", _daily_series("oil_temperature", "avg_oil_temperature_c"))
def k08(spark, d):
    """K8: daily oil temperature, resampled daily."""
    daily = marts.daily_mart(hourly(spark, d))
    return metric_query(daily, DS["mart_daily"], ["oil_temperature"], time_range=RANGE, grain="day",
                        timeseries=True, resample=True)


_LAB = SPEC.state_labels()
_STATES_SQL = f"""states AS (
  SELECT h.hour_ts, s.operating_state, s.observations FROM hourly h,
    (SELECT '{_LAB["loaded"]}' AS operating_state, h.loaded_readings AS observations
     UNION ALL SELECT '{_LAB["unloaded"]}', h.unloaded_readings
     UNION ALL SELECT '{_LAB["idle"]}', h.idle_readings) s)"""


@query("k09_operating_states", _sql(ALL + [_STATES_SQL], f"""
SELECT operating_state, CAST(COALESCE(SUM(observations), 0) AS BIGINT) AS state_observations
FROM states WHERE {_PH} GROUP BY operating_state"""))
def k09(spark, d):
    """K9: operating-state observations by state."""
    states = marts.operating_states(hourly(spark, d), SPEC)
    return metric_query(states, DS["analytics_operating_states"], ["state_observations"],
                        group_by=["operating_state"], time_range=RANGE)


@query("k10_evaluation_coverage", _sql(ALL, f"""
SELECT evaluation_status, COUNT(*) AS observed_hours FROM investigation WHERE {_PH} GROUP BY evaluation_status"""))
def k10(spark, d):
    """Observed hours by evaluation status."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], ["observed_hours"],
                        group_by=["evaluation_status"], time_range=RANGE)


@query("k11_exclusion_counts", _sql(ALL, f"""
SELECT COUNT(*) FILTER (WHERE current_samples_insufficient AND NOT baseline_samples_insufficient) AS current_samples_only,
  COUNT(*) FILTER (WHERE baseline_samples_insufficient AND NOT current_samples_insufficient) AS baseline_samples_only,
  COUNT(*) FILTER (WHERE current_samples_insufficient AND baseline_samples_insufficient) AS both_sample_requirements,
  COUNT(*) FILTER (WHERE NOT current_samples_insufficient AND NOT baseline_samples_insufficient AND NOT rule_eligible)
    AS missing_rates
FROM investigation WHERE {_PH}"""))
def k11(spark, d):
    """Mutually exclusive exclusion counts."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"],
                        ["current_samples_only", "baseline_samples_only", "both_sample_requirements", "missing_rates"],
                        time_range=RANGE)


_K12 = ["low_pressure_pct", "prior_share_pct", "rule_floor_pct", "multiple_prior_pct"]


@query("k12_hourly_share_baseline", _sql(ALL + [f"""s AS (
  SELECT hour_ts AS ts,
    CAST(100 AS DOUBLE) * SUM(low_pressure_loaded_readings) / NULLIF(SUM(loaded_readings), 0) AS low_pressure_pct,
    CASE WHEN COUNT(*) = 1 THEN CAST(100 AS DOUBLE) * MAX(prior_low_fraction) END AS prior_share_pct,
    CAST({100.0 * SPEC.share_floor} AS DOUBLE) AS rule_floor_pct,
    CASE WHEN COUNT(*) = 1 THEN CAST({100.0 * SPEC.prior_multiple} AS DOUBLE) * MAX(prior_low_fraction) END
      AS multiple_prior_pct
  FROM investigation WHERE {_PH} GROUP BY 1),
grid AS (SELECT UNNEST(generate_series(MIN(ts), MAX(ts), INTERVAL 1 HOUR)) AS ts FROM s)"""],
    "SELECT g.ts, " + ", ".join(f"s.{m}" for m in _K12) + " FROM grid g LEFT JOIN s ON s.ts = g.ts", _K12))
def k12(spark, d):
    """Hourly share, prior baseline, floor and multiple of prior (hour grain, resampled)."""
    return metric_query(_inv(spark, d), DS["mart_hourly_investigation"], _K12, time_range=RANGE, grain="hour",
                        timeseries=True, resample=True)


_K13 = ["incident_id", "starts_at", "ends_at", "candidate_hours", "readings", "loaded_readings", "low_pressure_share",
        "peak_hour_share", "overlaps_reported_failure", "rule_version"]


@query("k13_incident_queue", _sql(ALL, f"""
SELECT DISTINCT incident_id, CAST(date_trunc('day', starts_at) AS TIMESTAMP) AS starts_at, ends_at, candidate_hours,
  readings, loaded_readings, low_pressure_share, peak_hour_share, overlaps_reported_failure, rule_version
FROM incidents WHERE {_PS}""", ["low_pressure_share", "peak_hour_share"]))
def k13(spark, d):
    """Incident queue, raw mode (distinct rows, start truncated to day), ordered by start."""
    return metric_query(incidents(spark, d), DS["mart_incidents"], time_range=RANGE, grain="day",
                        raw_columns=_K13, order_by=["starts_at", "incident_id"])


@query("k14_maintenance_context", _sql(ALL + [BREACHES], f"""
SELECT * REPLACE (date_trunc('day', starts_at)::TIMESTAMP AS starts_at) FROM ({REVIEWED}) q"""))
def k14(spark, d):
    """Maintenance context, full source, raw mode."""
    rv = review.report_review(reports(spark), candidates(spark, d))
    return metric_query(rv, DS["mart_report_review"], grain="day", raw_columns=rv.columns,
                        order_by=["starts_at", "report_id"])


_K15 = ["raw_observations", "hourly_observations", "observed_hours", "observed_dates", "unobserved_hour_windows",
        "duplicate_timestamps", "missing_core_sensor_rows", "reconciliation_difference",
        "state_reconciliation_difference", "is_complete_source"]
_K16 = ["source_name", "first_observation", "last_observation", "pipeline_loaded_at", "source_sha256",
        "timestamp_context"]


def _quality(spark, d):
    rd = readings(spark, d)
    return Q.data_quality(rd, hourly(spark, d), demo_state(rd))


@query("k15_quality", _sql(ALL + [QUALITY], f"SELECT DISTINCT {', '.join(_K15)} FROM quality"))
def k15(spark, d):
    """Data quality and reconciliation (full source, raw mode)."""
    return metric_query(_quality(spark, d), DS["analytics_data_quality"], raw_columns=_K15)


@query("k16_provenance", _sql(ALL + [QUALITY], f"SELECT DISTINCT {', '.join(_K16)} FROM quality"))
def k16(spark, d):
    """Source period and provenance (full source, raw mode)."""
    return metric_query(_quality(spark, d), DS["analytics_data_quality"], raw_columns=_K16)



# ---------------------------------------------------------------- the other metrics of M1, M2, M5, M7

_REST = ["observations", "loaded_observations", "low_pressure_pct", "panel_pressure", "oil_temperature", "pressure_gap"]
_REST_DOUBLES = _REST[2:]


def _rest_sql(table, time, mean):
    weighted = ", ".join(f"SUM({mean(c)}) / NULLIF(SUM(readings), 0) AS {m}" for m, c in (
        ("panel_pressure", "panel_pressure"), ("oil_temperature", "oil_temperature"), ("pressure_gap", "pressure_gap")))
    return f"""
SELECT date_trunc('day', {time})::TIMESTAMP AS ts, CAST(SUM(readings) AS BIGINT) AS observations,
  CAST(SUM(loaded_readings) AS BIGINT) AS loaded_observations,
  100.0 * SUM(low_pressure_loaded_readings) / NULLIF(SUM(loaded_readings), 0) AS low_pressure_pct, {weighted}
FROM {table} GROUP BY 1"""


_DAILY_MEAN = {"panel_pressure": "avg_panel_pressure_bar", "oil_temperature": "avg_oil_temperature_c",
               "pressure_gap": "avg_pressure_gap_bar"}


@query("m1_hourly_metrics_by_day", _sql(ALL, _rest_sql("hourly", "hour_ts", lambda c: f"{c}_sum"), _REST_DOUBLES))
def m1(spark, d):
    """M1: every metric of the hourly mart, by day."""
    return metric_query(hourly(spark, d), DS["mart_hourly"], _REST, grain="day", timeseries=True)


@query("m2_daily_metrics", _sql(ALL, _rest_sql("daily", "reading_date", lambda c: f"{_DAILY_MEAN[c]} * readings"), _REST_DOUBLES))
def m2(spark, d):
    """M2: every metric of the daily mart, by day."""
    return metric_query(marts.daily_mart(hourly(spark, d)), DS["mart_daily"], _REST, grain="day", timeseries=True)


@query("m5_maintenance_reports", _sql([LOGGED_SQL], """
SELECT date_trunc('day', starts_at) AS ts, COUNT(*) AS maintenance_reports FROM logged GROUP BY ALL"""))
def m5(spark, d):
    """M5: maintenance reports by day, of the reports logged in the events."""
    reviewed = intervals.review_counts(logged_reports(spark, d), candidates(spark, d), ["report_id"], REVIEW_PRESSURE)
    return metric_query(reviewed, DS["mart_report_review"], ["maintenance_reports"], grain="day", timeseries=True)


@query("m7_source_rows", _sql(ALL, "SELECT COUNT(*) AS source_rows FROM readings"))
def m7(spark, d):
    """M7: source rows of the load."""
    return metric_query(_quality(spark, d), DS["analytics_data_quality"], ["source_rows"])
