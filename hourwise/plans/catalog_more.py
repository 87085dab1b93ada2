"""Registered queries: time grid, period scoping, quality, audit, comparison."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from hourwise.operators import audit as A, compare as U, marts, period as P, quality as Q, review, timegrid as T
from hourwise.functions.columns import ntz_lit
from hourwise.operators import rule, incidents as inc
from hourwise.plans import oracle as O
from hourwise.plans.catalog import (ASSET, BREACHES, CAND_DOUBLES, DAILY_DOUBLES, INC_DOUBLES, REVIEWED, SPEC, _sql, candidates,
                                    hourly, incidents, investigation, query, readings, reports)
from hourwise.session import materialize
from hourwise.sources.readings import READINGS_SQL

# Period used by the period-scoped queries (inclusive dates) and its half-open bounds.
PERIOD = ("2024-01-08", "2024-01-21")
LO, HI = P.bounds(*PERIOD)
LO_SQL, HI_SQL = f"TIMESTAMP '{LO:%Y-%m-%d %H:%M:%S}'", f"TIMESTAMP '{HI:%Y-%m-%d %H:%M:%S}'"
# A selection wider than the data, so the dense grid shows unobserved days.
DENSE = ("2023-12-30", "2024-02-02")
DLO, DHI = P.bounds(*DENSE)


def daily(spark, d, keys=()):
    return marts.daily_mart(hourly(spark, d, keys), list(keys))


def period(spark, d, *names):
    """The named period inputs (hourly, daily, incidents, reports), cut to PERIOD; no others are built."""
    build = {"hourly": investigation, "daily": daily, "incidents": incidents, "reports": lambda s, _: reports(s)}
    return P.select_period({n: build[n](spark, d) for n in names}, *PERIOD)


ALL = O.chain(upto="all")


# ---------------------------------------------------------------- period

@query("period_hourly", _sql(ALL, f"SELECT * FROM investigation WHERE hour_ts >= {LO_SQL} AND hour_ts < {HI_SQL}",
                             CAND_DOUBLES))
def q_period_hourly(spark, d):
    """Investigation hours of the selected dates (filter above the baseline window)."""
    return period(spark, d, "hourly")["hourly"]


@query("period_daily", _sql(ALL, f"SELECT * FROM daily WHERE reading_date >= CAST({LO_SQL} AS DATE) "
                                 f"AND reading_date < CAST({HI_SQL} AS DATE)", DAILY_DOUBLES))
def q_period_daily(spark, d):
    """Daily rows of the selected dates."""
    return period(spark, d, "daily")["daily"]


@query("period_incidents_overlap", _sql(ALL, f"SELECT * FROM incidents WHERE starts_at < {HI_SQL} "
                                             f"AND ends_at > {LO_SQL}", INC_DOUBLES))
def q_period_incidents_overlap(spark, d):
    """P10: incidents overlapping the selection."""
    return period(spark, d, "incidents")["incidents"]


_PO = f"starts_at < {HI_SQL} AND ends_at > {LO_SQL}"


@query("period_reports_overlap", _sql(O.chain(upto="candidates") + [BREACHES], f"SELECT * FROM ({REVIEWED}) r WHERE {_PO}"))
def q_period_reports_overlap(spark, d):
    """P10: reviewed reports (C4) overlapping the selection."""
    return P.overlapping(review.report_review(reports(spark), candidates(spark, d)), LO, HI)


_PD = f"reading_date >= CAST({LO_SQL} AS DATE) AND reading_date < CAST({HI_SQL} AS DATE)"
_PH = f"hour_ts >= {LO_SQL} AND hour_ts < {HI_SQL}"


@query("period_kpis", _sql(ALL, f"""
SELECT (SELECT CAST(COALESCE(SUM(readings), 0) AS BIGINT) FROM daily WHERE {_PD}) AS readings,
  (SELECT CAST(COALESCE(SUM(loaded_readings), 0) AS BIGINT) FROM daily WHERE {_PD}) AS loaded_readings,
  (SELECT CAST(SUM(low_pressure_loaded_readings) AS DOUBLE) / NULLIF(SUM(loaded_readings), 0) FROM daily WHERE {_PD})
    AS low_pressure_share,
  (SELECT COUNT(*) FILTER (WHERE candidate_status = 'REVIEW_PRESSURE') FROM investigation WHERE {_PH}) AS candidate_hours,
  (SELECT COUNT(*) FROM incidents WHERE {_PO}) AS incidents,
  (SELECT COUNT(*) FROM reports WHERE {_PO}) AS reports""", ["low_pressure_share"]))
def q_period_kpis(spark, d):
    """Period KPIs (share of sums, NULL when nothing loaded)."""
    return P.kpis(period(spark, d, "hourly", "daily", "incidents", "reports"))


_LAB = SPEC.state_labels()


@query("state_totals", _sql(ALL, f"""
SELECT '{_LAB["loaded"]}' AS operating_state, CAST(COALESCE(SUM(loaded_readings), 0) AS BIGINT) AS observations
  FROM investigation WHERE {_PH}
UNION ALL SELECT '{_LAB["unloaded"]}', CAST(COALESCE(SUM(unloaded_readings), 0) AS BIGINT) FROM investigation WHERE {_PH}
UNION ALL SELECT '{_LAB["idle"]}', CAST(COALESCE(SUM(idle_readings), 0) AS BIGINT) FROM investigation WHERE {_PH}"""))
def q_state_totals(spark, d):
    """Operating-state totals over the selection."""
    return P.state_totals(period(spark, d, "hourly")["hourly"], SPEC)


@query("status_histogram", _sql(ALL, f"""
SELECT candidate_status, COUNT(*) AS hours FROM investigation WHERE {_PH} GROUP BY candidate_status"""))
def q_status_histogram(spark, d):
    """Hours per candidate status in the selection."""
    return P.status_histogram(period(spark, d, "hourly")["hourly"])


@query("review_queue", _sql(ALL, """
SELECT incident_id, starts_at, ends_at, candidate_hours, low_pressure_share, overlaps_reported_failure
FROM incidents ORDER BY starts_at DESC, incident_id""", ["low_pressure_share"]))
def q_review_queue(spark, d):
    """O3: incidents newest first with a column subset."""
    return P.review_queue(incidents(spark, d))


# ---------------------------------------------------------------- time grid

_DLO_SQL, _DHI_SQL = f"TIMESTAMP '{DLO:%Y-%m-%d %H:%M:%S}'", f"TIMESTAMP '{DHI:%Y-%m-%d %H:%M:%S}'"


@query("daily_trend_dense", _sql(O.chain(upto="daily"), f"""
SELECT CAST(g.d AS DATE) AS reading_date, x.low_pressure_loaded_fraction, x.avg_panel_pressure_bar,
  x.avg_pressure_gap_bar, x.avg_oil_temperature_c
FROM generate_series({_DLO_SQL}, {_DHI_SQL} - INTERVAL 1 DAY, INTERVAL 1 DAY) AS g(d)
LEFT JOIN daily x ON x.reading_date = CAST(g.d AS DATE)""", DAILY_DOUBLES))
def q_daily_trend_dense(spark, d):
    """Daily trend reindexed to the selected date range (gaps are NULL rows)."""
    return P.daily_trend_dense(daily(spark, d), *DENSE)


_ASFREQ_GRID = """b AS (SELECT asset_id, MIN(hour_ts) AS lo, MAX(hour_ts) AS hi FROM investigation GROUP BY asset_id),
grid AS (SELECT asset_id, UNNEST(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM b)"""


@query("hourly_asfreq", _sql(O.chain(ASSET) + [_ASFREQ_GRID], """
SELECT g.asset_id, g.hour_ts, i.current_low_fraction, i.prior_low_fraction
FROM grid g LEFT JOIN investigation i ON i.asset_id = g.asset_id AND i.hour_ts = g.hour_ts""",
                             ["current_low_fraction", "prior_low_fraction"]))
def q_hourly_asfreq(spark, d):
    """Per-asset hourly share series resampled between its first and last point."""
    inv = investigation(spark, d, ASSET).select("asset_id", "hour_ts", "current_low_fraction", "prior_low_fraction")
    return T.asfreq(inv, "hour_ts", 3600, ASSET)


@query("resample_null_check", _sql(O.chain(ASSET) + [_ASFREQ_GRID], """
SELECT COUNT(*) AS grid_points, COUNT(*) FILTER (WHERE i.hour_ts IS NOT NULL) AS present_points,
  COUNT(*) FILTER (WHERE i.hour_ts IS NULL) AS inserted_points,
  COUNT(*) FILTER (WHERE i.hour_ts IS NULL AND (i.current_low_fraction IS NOT NULL OR i.prior_low_fraction IS NOT NULL))
    AS inserted_non_null_points
FROM grid g LEFT JOIN investigation i ON i.asset_id = g.asset_id AND i.hour_ts = g.hour_ts"""))
def q_resample_null_check(spark, d):
    """Resampling adds only NULL points."""
    inv = investigation(spark, d, ASSET).select("asset_id", "hour_ts", "current_low_fraction", "prior_low_fraction")
    res = T.asfreq(inv, "hour_ts", 3600, ASSET)
    return T.resample_null_check(inv, res, "hour_ts", ["current_low_fraction", "prior_low_fraction"], ASSET)


@query("unobserved_windows", _sql(O.chain(ASSET, upto="hourly"), """
SELECT asset_id, MIN(hour_ts) AS first_hour, MAX(hour_ts) AS last_hour,
  CAST(ROUND((epoch_us(MAX(hour_ts)) - epoch_us(MIN(hour_ts))) / 3600000000) + 1 AS BIGINT) AS expected_hours,
  COUNT(*) AS observed_hours,
  CAST(ROUND((epoch_us(MAX(hour_ts)) - epoch_us(MIN(hour_ts))) / 3600000000) + 1 AS BIGINT) - COUNT(*)
    AS unobserved_hour_windows
FROM hourly GROUP BY asset_id"""))
def q_unobserved_windows(spark, d):
    """T4: expected minus observed hour windows per asset."""
    return T.unobserved_windows(hourly(spark, d, ASSET), ASSET)


@query("incident_evidence", _sql(O.chain(upto="incidents"), """
SELECT g.incident_id, g.hour_ts, i.readings, i.loaded_readings, i.low_pressure_loaded_readings,
  i.current_low_fraction, i.prior_low_fraction, i.candidate_status
FROM (SELECT incident_id, UNNEST(generate_series(starts_at - INTERVAL 7 DAY, ends_at - INTERVAL 1 HOUR,
      INTERVAL 1 HOUR)) AS hour_ts FROM incidents) g
LEFT JOIN investigation i ON i.hour_ts = g.hour_ts""", ["current_low_fraction", "prior_low_fraction"]))
def q_incident_evidence(spark, d):
    """T5: dense hourly evidence [start - 7 d, end) for every incident."""
    inv = investigation(spark, d)
    return review.incident_evidence(inc.incidents(inv, SPEC, materialize_input=False), inv, SPEC.lookback_days)


@query("report_context", _sql(ALL, """
SELECT w.*, CAST((epoch_us(window_end) - epoch_us(window_start)) / 3600000000 AS BIGINT) AS expected_hours,
  (SELECT COUNT(*) FROM investigation i WHERE i.hour_ts >= w.window_start AND i.hour_ts < w.window_end) AS observed_hours,
  CAST((epoch_us(window_end) - epoch_us(window_start)) / 3600000000 AS BIGINT)
    - (SELECT COUNT(*) FROM investigation i WHERE i.hour_ts >= w.window_start AND i.hour_ts < w.window_end)
    AS missing_hours,
  (SELECT COUNT(*) FROM investigation i WHERE i.hour_ts >= w.window_start AND i.hour_ts < w.window_end
     AND i.candidate_status = 'REVIEW_PRESSURE') AS candidate_hours
FROM (SELECT report_id, report_type, starts_at, ends_at,
        date_trunc('hour', starts_at - INTERVAL 3 DAY) AS window_start,
        CASE WHEN date_trunc('hour', ends_at + INTERVAL 3 DAY) = ends_at + INTERVAL 3 DAY
             THEN ends_at + INTERVAL 3 DAY ELSE date_trunc('hour', ends_at + INTERVAL 3 DAY) + INTERVAL 1 HOUR END
          AS window_end
      FROM reports) w"""))
def q_report_context(spark, d):
    """Per-report context window (+-3 days): observed, missing and candidate hours."""
    return review.report_context(reports(spark), investigation(spark, d), 3)


@query("report_clip", _sql(ALL, f"""
SELECT b.*, (SELECT COUNT(*) FROM investigation i
             WHERE i.hour_ts < b.band_end AND i.hour_ts + INTERVAL 1 HOUR > b.band_start) AS observed_hours_in_band
FROM (SELECT report_id, report_type, starts_at, ends_at, GREATEST(starts_at, {LO_SQL}) AS band_start,
        LEAST(ends_at, {HI_SQL}) AS band_end FROM reports WHERE {_PO}) b"""))
def q_report_clip(spark, d):
    """Report bands clipped to the selection, with the observed hours inside each band."""
    return review.clip_reports(reports(spark), LO, HI, hours=investigation(spark, d))


# ---------------------------------------------------------------- quality (Q1-Q5)

def demo_state(rd):
    """Provenance row of the load (count recorded at ingest)."""
    return rd.agg(F.count(F.lit(1)).alias("original_rows")).select(
        "original_rows", F.lit(True).alias("is_complete_source"),
        F.lit(None).cast("timestamp_ntz").alias("pipeline_loaded_at"), F.lit("events.parquet").alias("source_name"),
        F.lit(None).cast("string").alias("source_sha256"))


QUALITY = f"""quality AS (
  WITH stamps AS (SELECT observed_at, COUNT(*) AS n, SUM(CASE WHEN tp3 IS NULL OR oil_temperature IS NULL OR motor_current IS NULL
                         THEN 1 ELSE 0 END) AS incomplete FROM readings GROUP BY observed_at),
  src AS (SELECT CAST(SUM(n) AS BIGINT) AS raw_observations, MIN(observed_at) AS first_observation,
                 MAX(observed_at) AS last_observation, CAST(SUM(n - 1) AS BIGINT) AS duplicate_timestamps,
                 CAST(SUM(incomplete) AS BIGINT) AS missing_core_sensor_rows FROM stamps),
  hours AS (SELECT COUNT(*) AS observed_hours, COUNT(DISTINCT hour_ts::DATE) AS observed_dates,
                   CAST(SUM(readings) AS BIGINT) AS hourly_observations,
                   CAST(SUM(loaded_readings) + SUM(unloaded_readings) + SUM(idle_readings) AS BIGINT) AS state_observations FROM hourly)
  SELECT src.*, hours.*,
    datediff('hour', first_observation, last_observation) + 1 - observed_hours AS unobserved_hour_windows,
    raw_observations - hourly_observations AS reconciliation_difference,
    state_observations - hourly_observations AS state_reconciliation_difference, raw_observations AS original_rows,
    TRUE AS is_complete_source, CAST(NULL AS TIMESTAMP) AS pipeline_loaded_at, 'events.parquet' AS source_name,
    CAST(NULL AS VARCHAR) AS source_sha256, '{Q.TIMESTAMP_CONTEXT}' AS timestamp_context
  FROM src CROSS JOIN hours)"""


@query("data_quality", _sql(O.chain(upto="hourly") + [QUALITY], "SELECT * FROM quality"))
def q_data_quality(spark, d):
    """Q1: the full-source quality row (with the load's provenance fields)."""
    rd = readings(spark, d)
    return Q.data_quality(rd, hourly(spark, d), demo_state(rd))


@query("table_sizes", _sql(O.chain(upto="daily"), """
SELECT (SELECT COUNT(*) FROM readings) AS source_rows, (SELECT COUNT(*) FROM hourly) AS hourly_rows,
  (SELECT COUNT(*) FROM daily) AS daily_rows, (SELECT COUNT(*) FROM reports) AS public_report_windows"""))
def q_table_sizes(spark, d):
    """Q2: relation sizes."""
    rd = readings(spark, d)
    h = hourly(spark, d)
    return Q.table_sizes(rd, h, marts.daily_mart(h), reports(spark))


@query("lost_rows", _sql(O.chain(upto="hourly"), """
SELECT CAST((SELECT COUNT(*) FROM readings) - (SELECT COALESCE(SUM(readings), 0) FROM hourly) AS BIGINT) AS lost_rows"""))
def q_lost_rows(spark, d):
    """Q3: rows lost by the hourly aggregation (0)."""
    rd = readings(spark, d)
    return Q.lost_rows(rd, hourly(spark, d))


@query("duplicate_timestamps", _sql([READINGS_SQL], """
SELECT COUNT(*) - COUNT(DISTINCT observed_at) AS duplicate_timestamp_count, MIN(observed_at) AS first_reading,
  MAX(observed_at) AS last_reading FROM readings"""))
def q_duplicate_timestamps(spark, d):
    """Q4/A5: duplicate timestamps and bounds."""
    return Q.duplicate_timestamps(readings(spark, d))


_MLO, _MHI = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15)


@query("month_slice", _sql(O.chain(upto="hourly"), """
SELECT hour_ts, avg_panel_pressure_bar, avg_oil_temperature_c FROM hourly
WHERE hour_ts >= TIMESTAMP '2024-01-08 00:00:00' AND hour_ts < TIMESTAMP '2024-01-15 00:00:00' ORDER BY hour_ts""",
                             ["avg_panel_pressure_bar", "avg_oil_temperature_c"]))
def q_month_slice(spark, d):
    """Q5: ordered half-open hourly slice."""
    return Q.month_slice(hourly(spark, d), _MLO, _MHI)


# ---------------------------------------------------------------- audit (Q6-Q16, Q18)

# Every hour falls into one class of flags; the measures are sums over classes.
RECON_SQL = f"""
SELECT CAST(SUM(n) AS BIGINT) AS observed_hours, MIN(lo) AS first_hour, MAX(hi) AS last_hour,
  100.0 * SUM(n * ok) / SUM(n) AS eligibility_percentage, {", ".join(f"CAST(SUM(n * {x}) AS BIGINT) AS {name}" for name, x in {
    "eligible_hours": "ok", "not_evaluated_hours": "(verdict = 'Not evaluated')::INT", "evaluated_breach": "(verdict = 'Evaluated: breach')::INT",
    "evaluated_no_breach": "(verdict = 'Evaluated: no breach')::INT", "current_only": "short * (1 - thin)", "baseline_only": "thin * (1 - short)",
    "both": "short * thin", "zero_current_loaded": "(load_class = 0)::INT", "current_loaded_below_min": "(load_class = 1)::INT",
    "null_prior_counts": "no_prior", "null_current_rate": "no_rate", "null_prior_rate": "no_prior_rate",
    "eligible_null_rate": "ok * GREATEST(no_rate, no_prior_rate)", "complete_prior_hour_windows": "whole"}.items())}
FROM (SELECT COUNT(*) AS n, MIN(hour_ts) AS lo, MAX(hour_ts) AS hi, rule_eligible::INT AS ok, evaluation_status AS verdict,
        current_samples_insufficient::INT AS short, baseline_samples_insufficient::INT AS thin,
        CASE WHEN loaded_readings = 0 THEN 0 WHEN loaded_readings < {SPEC.min_current_loaded} THEN 1 ELSE 2 END AS load_class,
        (prior_loaded_readings IS NULL)::INT AS no_prior, (current_low_fraction IS NULL)::INT AS no_rate,
        (prior_low_fraction IS NULL)::INT AS no_prior_rate, (prior_observed_hours = {SPEC.window_hours})::INT AS whole
      FROM investigation GROUP BY ALL) AS classes"""


@query("audit_reconciliation", _sql(ALL, RECON_SQL, ["eligibility_percentage"]))
def q_audit_reconciliation(spark, d):
    """Q6: eligibility reconciliation measures."""
    return A.reconciliation(investigation(spark, d), SPEC)


@query("audit_exclusion_periods", _sql(ALL, """
SELECT reason AS exclusion_reason, len(times) AS hours, times[1] AS first_hour, times[-1] AS last_hour
FROM (SELECT exclusion_reason AS reason, list_sort(list(hour_ts)) AS times FROM investigation GROUP BY reason)"""))
def q_audit_exclusion_periods(spark, d):
    """Q7: periods per exclusion reason."""
    return A.exclusion_periods(investigation(spark, d))


_LC, _LP = SPEC.loaded_current, SPEC.low_pressure
_RAW_HOURS = f"""per_hour AS (
  SELECT date_trunc('hour', observed_at)::TIMESTAMP AS hour_ts, COUNT(*) AS readings,
    COUNT(CASE WHEN motor_current >= {_LC} THEN 1 END) AS loaded,
    COUNT(CASE WHEN motor_current >= {_LC} AND tp3 < {_LP} THEN 1 END) AS low
  FROM readings GROUP BY ALL),
rebuilt AS (
  SELECT this.*, before.prior_loaded, before.prior_low, before.prior_hours
  FROM per_hour this, LATERAL (
    SELECT CAST(SUM(w.loaded) AS BIGINT) AS prior_loaded, CAST(SUM(w.low) AS BIGINT) AS prior_low, COUNT(*) AS prior_hours
    FROM per_hour w WHERE w.hour_ts BETWEEN this.hour_ts - INTERVAL {24 * SPEC.lookback_days} HOURS
                                        AND this.hour_ts - INTERVAL 1 HOUR) before)"""

# An hour is odd if its row is in only one of the two row sets.
_ROW_COLS = "hour_ts, readings, loaded, low, prior_loaded, prior_low, prior_hours"
_MISMATCH_SQL = f"""
WITH windowed(hour_ts, readings, loaded, low, prior_loaded, prior_low, prior_hours, eligible) AS (
  SELECT hour_ts, readings, loaded_readings, low_pressure_loaded_readings, prior_loaded_readings, prior_low_readings,
    prior_observed_hours, rule_eligible FROM investigation),
joined AS (SELECT *, loaded >= {SPEC.min_current_loaded} AND COALESCE(prior_loaded, 0) >= {SPEC.min_prior_loaded} AS eligible FROM rebuilt),
odd_rows AS ((SELECT {_ROW_COLS} FROM windowed EXCEPT SELECT {_ROW_COLS} FROM joined)
             UNION ALL (SELECT {_ROW_COLS} FROM joined EXCEPT SELECT {_ROW_COLS} FROM windowed)),
odd_flags AS ((SELECT hour_ts, eligible FROM windowed EXCEPT SELECT hour_ts, eligible FROM joined)
              UNION ALL (SELECT hour_ts, eligible FROM joined EXCEPT SELECT hour_ts, eligible FROM windowed))
SELECT (SELECT COUNT(*) FROM (SELECT hour_ts FROM windowed UNION SELECT hour_ts FROM joined)) AS compared_hours,
  (SELECT COUNT(DISTINCT hour_ts) FROM odd_rows) AS mismatched_hours,
  (SELECT COUNT(DISTINCT hour_ts) FROM odd_flags) AS mismatched_eligibility"""


@query("baseline_self_join", _sql([READINGS_SQL, _RAW_HOURS], "SELECT * FROM rebuilt"))
def q_baseline_self_join(spark, d):
    """Raw hour counts joined to their trailing 7 days (day-bucketed equi join)."""
    return A.independent_window(readings(spark, d), SPEC)


@query("window_vs_join_mismatch", _sql(ALL + [_RAW_HOURS], f"SELECT * FROM ({_MISMATCH_SQL}) m"))
def q_window_vs_join_mismatch(spark, d):
    """Window vs self-join derivations, null-safe mismatches."""
    return A.window_vs_join(readings(spark, d), investigation(spark, d), SPEC)


# Neighbours are found by joining numbered rows; the median is the middle element of the sorted list of steps.
_STEPS = """times AS (SELECT source_row, epoch_us(observed_at) AS us FROM readings),
by_time AS (SELECT us, ROW_NUMBER() OVER (ORDER BY us) AS k FROM times),
by_row AS (SELECT us, ROW_NUMBER() OVER (ORDER BY source_row) AS k FROM times),
steps AS (SELECT list_sort(list(y.us - x.us)) AS us FROM by_time x JOIN by_time y ON y.k = x.k + 1)"""


@query("audit_cadence", _sql([READINGS_SQL, _STEPS], """
SELECT (SELECT COUNT(*) FROM times) AS observations,
  (SELECT COUNT(*) FROM times) - (SELECT COUNT(DISTINCT us) FROM times) AS duplicate_timestamps,
  (SELECT COUNT(*) FROM by_row x JOIN by_row y ON y.k = x.k + 1 WHERE y.us < x.us) AS source_order_reversals,
  us[(len(us) + 1) // 2] / 1e6 AS median_interval_seconds, len(list_filter(us, lambda d: d > 20000000)) AS gaps_over_20_seconds,
  us[-1] / 1e6 AS largest_gap_seconds FROM steps""", ["median_interval_seconds", "largest_gap_seconds"]))
def q_audit_cadence(spark, d):
    """Cadence and order via stitched LAG and an exact weighted discrete median."""
    return A.cadence(readings(spark, d))


def _pct(col, ps, prefix):
    return ",\n  ".join(f"CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY {col}) AS BIGINT) AS {prefix}_p{int(p * 100):03d}"
                        for p in ps)


@query("audit_sample_distribution", _sql(ALL, f"""
SELECT {_pct('loaded_readings', [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0], 'loaded')},
  {_pct('readings', [0.0, 0.25, 0.5, 0.75, 1.0], 'total')},
  COUNT(*) FILTER (WHERE loaded_readings < {SPEC.min_current_loaded} AND readings >= {350 * SPEC.min_current_loaded // 30})
    AS excluded_current_despite_high_total,
  COUNT(*) FILTER (WHERE prior_observed_hours < {SPEC.window_hours}) AS incomplete_prior_windows,
  COUNT(*) FILTER (WHERE prior_observed_hours < {SPEC.window_hours} AND rule_eligible)
    AS eligible_despite_incomplete_prior_window
FROM investigation"""))
def q_audit_sample_distribution(spark, d):
    """Discrete percentiles of hourly sample counts."""
    return A.sample_distribution(investigation(spark, d), SPEC)


@query("audit_largest_gaps", _sql([READINGS_SQL], """
SELECT previous_at, observed_at, CAST(epoch_us(observed_at) - epoch_us(previous_at) AS DOUBLE) / 1000000 AS gap_seconds
FROM (SELECT observed_at, LAG(observed_at) OVER (ORDER BY observed_at) AS previous_at FROM readings) g
WHERE previous_at IS NOT NULL ORDER BY gap_seconds DESC, observed_at LIMIT 10""", ["gap_seconds"]))
def q_audit_largest_gaps(spark, d):
    """Q11/O2: ten largest gaps (top-k report)."""
    return A.largest_gaps(readings(spark, d), 10)


# Readings by (valve, compressor signal, loaded by current, low pressure, an input missing): both audits sum over these cells.
_CELLS = f"""cells AS (
  SELECT dv_electric AS valve, comp, motor_current >= {_LC} AS loaded, tp3 < {_LP} AS low,
    observed_at IS NULL OR motor_current IS NULL OR tp3 IS NULL AS missing, COUNT(*) AS n, COUNT(motor_current) AS known,
    SUM(motor_current) AS total, MIN(motor_current) AS least, MAX(motor_current) AS most
  FROM readings GROUP BY ALL)"""


def _cells(condition):
    return f"CAST(COALESCE(SUM(CASE WHEN {condition} THEN n END), 0) AS BIGINT)"


@query("audit_proxy_comparison", _sql([READINGS_SQL, _CELLS], f"""
SELECT valve AS dv_electric, comp, CAST(SUM(n) AS BIGINT) AS observations, {_cells("loaded")} AS current_loaded,
  {_cells("loaded AND low")} AS current_loaded_low_pressure, MIN(least) AS min_current_a, MAX(most) AS max_current_a,
  SUM(total) / SUM(known) AS mean_current_a FROM cells GROUP BY valve, comp""",
                                        ["min_current_a", "max_current_a", "mean_current_a"]))
def q_audit_proxy_comparison(spark, d):
    """Current statistics by (dv_electric, comp)."""
    return A.proxy_comparison(readings(spark, d), SPEC)


@query("audit_integrity", _sql([READINGS_SQL, _CELLS], f"""
SELECT {_cells("missing")} AS null_rule_inputs, {_cells("loaded")} AS current_proxy_loaded_observations,
  {_cells("valve = 1")} AS valve_loaded_observations, {_cells("loaded AND valve = 1")} AS agreeing_loaded_observations,
  {_cells("loaded AND valve = 0")} AS proxy_only_observations, {_cells("NOT loaded AND valve = 1")} AS valve_only_observations,
  {_cells("loaded AND low")} AS rule_low_pressure_observations FROM cells"""))
def q_audit_integrity(spark, d):
    """Q13: NULL inputs and loaded-definition agreement."""
    return A.integrity(readings(spark, d), SPEC)


@query("audit_invariants", _sql(ALL + [_RAW_HOURS, f"r AS ({RECON_SQL})", f"m AS ({_MISMATCH_SQL})"], f"""
SELECT c.*, c.expected = c.actual AS ok FROM (
  SELECT 'eligible_plus_not_evaluated_equals_observed' AS "check", observed_hours AS expected,
         eligible_hours + not_evaluated_hours AS actual FROM r
  UNION ALL SELECT 'evaluated_split_equals_eligible', eligible_hours, evaluated_no_breach + evaluated_breach FROM r
  UNION ALL SELECT 'exclusion_reasons_sum_to_not_evaluated', not_evaluated_hours,
    (SELECT COUNT(*) FROM investigation WHERE exclusion_reason <> '{SPEC.exclusion_labels()["none"]}') FROM r
  UNION ALL SELECT 'eligible_null_rate_is_zero', 0, eligible_null_rate FROM r
  UNION ALL SELECT 'compared_equals_observed', observed_hours, (SELECT compared_hours FROM m) FROM r
  UNION ALL SELECT 'window_mismatches_zero', 0, (SELECT mismatched_hours FROM m) FROM r
  UNION ALL SELECT 'eligibility_mismatches_zero', 0, (SELECT mismatched_eligibility FROM m) FROM r) c"""))
def q_audit_invariants(spark, d):
    """Q14: audit invariants as an assertion table."""
    inv = investigation(spark, d)
    return A.invariants(A.reconciliation(inv, SPEC), A.window_vs_join(readings(spark, d), inv, SPEC), A.missing_rates(inv))


_ROLLUP_PERIODS = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)), (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15))]


def _rollup_sql():
    parts = []
    for lo, hi in _ROLLUP_PERIODS:
        l, h = f"TIMESTAMP '{lo:%Y-%m-%d %H:%M:%S}'", f"TIMESTAMP '{hi:%Y-%m-%d %H:%M:%S}'"
        raw = (f"(SELECT COUNT(*) AS n, AVG(tp3) AS panel, AVG(oil_temperature) AS oil, "
               f"COUNT(*) FILTER (WHERE motor_current >= {_LC}) AS loaded, "
               f"COUNT(*) FILTER (WHERE motor_current >= {_LC} AND tp3 < {_LP}) AS low "
               f"FROM readings WHERE observed_at >= {l} AND observed_at < {h})")
        for model, table, tcol, panel, oil, lo_v, hi_v in [
                ("hourly_mart", "hourly", "hour_ts", "panel_pressure_sum", "oil_temperature_sum", l, h),
                ("daily_mart", "daily", "reading_date", "avg_panel_pressure_bar * readings",
                 "avg_oil_temperature_c * readings", f"CAST({l} AS DATE)", f"CAST({h} AS DATE)")]:
            m = (f"(SELECT SUM(readings) AS n, SUM({panel}) / NULLIF(SUM(readings), 0) AS panel, "
                 f"SUM({oil}) / NULLIF(SUM(readings), 0) AS oil, SUM(loaded_readings) AS loaded, "
                 f"SUM(low_pressure_loaded_readings) AS low FROM {table} WHERE {tcol} >= {lo_v} AND {tcol} < {hi_v})")
            close = " AND ".join(
                f"((r.{c} IS NULL AND m.{c} IS NULL) OR ABS(r.{c} - m.{c}) <= GREATEST(1e-10 * GREATEST(ABS(r.{c}), "
                f"ABS(m.{c})), 1e-8))" for c in ["n", "panel", "oil", "loaded", "low"])
            parts.append(f"SELECT '{model}' AS model, '{lo:%Y-%m-%d}' AS start_inclusive, '{hi:%Y-%m-%d}' AS end_exclusive, "
                         f"r.n AS raw_observation_count, r.panel AS panel_pressure_bar, r.oil AS oil_temperature_c, "
                         f"r.loaded AS loaded_observations, r.low AS low_pressure_loaded_observations, "
                         f"COALESCE({close}, FALSE) AS weighted_rollup_matches_raw FROM {raw} r, {m} m")
    return "\nUNION ALL ".join(parts)


@query("weighted_rollup_check", _sql(O.chain(upto="daily"), _rollup_sql(), ["panel_pressure_bar", "oil_temperature_c"]))
def q_weighted_rollup_check(spark, d):
    """Raw vs hourly/daily weighted roll-ups for two periods (1e-10 relative)."""
    rd = readings(spark, d)
    h = hourly(spark, d)
    return A.weighted_rollup_check(rd, h, marts.daily_mart(h), SPEC, _ROLLUP_PERIODS)


@query("regression_counts", _sql(ALL, """
SELECT COUNT(*) AS observed_hours, COUNT(*) FILTER (WHERE rule_eligible) AS eligible_hours,
  COUNT(*) FILTER (WHERE evaluation_status = 'Evaluated: breach') AS breach_hours FROM investigation"""))
def q_regression_counts(spark, d):
    """Q18: observed / eligible / breach hours."""
    return A.regression_counts(investigation(spark, d))


# ---------------------------------------------------------------- comparison

VARIANT = replace(SPEC, prior_multiple=1.2)
_CAND_COLS = ["hour_ts", "loaded_readings", "low_pressure_loaded_readings", "prior_loaded_readings",
              "prior_low_readings", "candidate_status"]


@query("table_diff", _sql(O.chain(upto="candidates") + O.chain(upto="candidates", spec=VARIANT, pre="v_", base=False),
                          f"""
SELECT *, 'before_only' AS side FROM (SELECT {', '.join(_CAND_COLS)} FROM candidates
  EXCEPT ALL SELECT {', '.join(_CAND_COLS)} FROM v_candidates) a
UNION ALL
SELECT *, 'after_only' AS side FROM (SELECT {', '.join(_CAND_COLS)} FROM v_candidates
  EXCEPT ALL SELECT {', '.join(_CAND_COLS)} FROM candidates) b"""))
def q_table_diff(spark, d):
    """Candidate table before vs after a rule change, volatile columns ignored."""
    h = hourly(spark, d)
    before = rule.candidate_hours(h, SPEC).select(*_CAND_COLS)
    after = rule.candidate_hours(h, VARIANT).select(*_CAND_COLS)
    return U.table_diff(before, after)


_DIRECT_DAILY = f"""direct AS (
  SELECT CAST(observed_at AS DATE) AS reading_date, COUNT(*) AS readings,
    COUNT(*) FILTER (WHERE motor_current >= {_LC}) AS loaded_readings,
    COUNT(*) FILTER (WHERE motor_current >= {_LC} AND tp3 < {_LP}) AS low_pressure_loaded_readings,
    AVG(tp3) AS avg_panel_pressure_bar, AVG(ABS(tp3 - reservoirs)) AS avg_pressure_gap_bar,
    AVG(oil_temperature) AS avg_oil_temperature_c
  FROM readings GROUP BY 1)"""
_TOL_COLS = ["readings", "loaded_readings", "low_pressure_loaded_readings", "avg_panel_pressure_bar",
             "avg_pressure_gap_bar", "avg_oil_temperature_c"]


def _tol_sql():
    def close(c):
        if c.startswith("avg"):
            return (f"CASE WHEN l.{c} IS NULL AND r.{c} IS NULL THEN TRUE WHEN l.{c} IS NULL OR r.{c} IS NULL THEN FALSE "
                    f"ELSE ABS(l.{c} - r.{c}) <= GREATEST(1e-9 * GREATEST(ABS(l.{c}), ABS(r.{c})), 1e-9) END")
        return f"l.{c} IS NOT DISTINCT FROM r.{c}"
    checks = ", ".join(f"{close(c)} AS {c}_matches" for c in _TOL_COLS)
    return f"""
SELECT *, in_left AND in_right AND {' AND '.join(f'{c}_matches' for c in _TOL_COLS)} AS all_match FROM (
  SELECT COALESCE(l.reading_date, r.reading_date) AS reading_date, l.reading_date IS NOT NULL AS in_left,
    r.reading_date IS NOT NULL AS in_right, {checks}
  FROM direct l FULL JOIN daily r ON l.reading_date = r.reading_date) q"""


@query("tolerance_compare", _sql(O.chain(upto="daily") + [_DIRECT_DAILY], _tol_sql()))
def q_tolerance_compare(spark, d):
    """Daily metrics from raw vs from the hourly mart, with numeric tolerance."""
    rd = readings(spark, d)
    return U.tolerance_compare(A.direct_daily(rd, SPEC), marts.daily_mart(hourly(spark, d)),
                               ["reading_date"], _TOL_COLS, rel=1e-9, abs_tol=1e-9)


_CUT = "TIMESTAMP '2024-01-25 00:00:00'"
#: The earlier run in the query named these incidents in another way (a defect the check must report).
_RENAMED_HOURS = 6


@query("id_stability", _sql(
    O.chain(upto="incidents") + [f"prior_readings AS (SELECT * FROM readings WHERE observed_at < {_CUT})"]
    + O.chain(upto="incidents", pre="p_", base=False, source="prior_readings"), f"""
SELECT p.starts_at, p.prior_id AS incident_id
FROM (SELECT starts_at, CASE WHEN hour(starts_at) = {_RENAMED_HOURS} THEN 'old-' || incident_id ELSE incident_id END AS prior_id
      FROM p_incidents) p
LEFT JOIN incidents i ON i.starts_at = p.starts_at AND i.incident_id = p.prior_id WHERE i.incident_id IS NULL"""))
def q_id_stability(spark, d):
    """Incident ids of an earlier run (data before the cut) must survive a rerun on all data; the incidents
    that the earlier run named differently are reported."""
    rd = readings(spark, d)
    prior_rd = rd.filter(F.col("observed_at") < ntz_lit(dt.datetime(2024, 1, 25)))
    rep = reports(spark)

    def run(r):
        return inc.incidents(rule.investigation(marts.hourly_mart(r, SPEC), rep, SPEC), SPEC, materialize_input=False)
    prior = run(prior_rd).withColumn("incident_id", F.when(
        F.hour("starts_at") == _RENAMED_HOURS, F.concat(F.lit("old-"), "incident_id")).otherwise(F.col("incident_id")))
    return U.id_stability(prior, run(rd), ["starts_at"], "incident_id")


def _recheck_sql():
    spec = SPEC
    status = (f"CASE WHEN a.loaded < {spec.min_current_loaded} OR COALESCE(a.prior_loaded, 0) < {spec.min_prior_loaded} "
              f"THEN 'INSUFFICIENT_HISTORY' WHEN CAST(a.low AS DOUBLE) / NULLIF(a.loaded, 0) >= {spec.share_floor} AND "
              f"CAST(a.low AS DOUBLE) / NULLIF(a.loaded, 0) >= {spec.prior_multiple} * "
              f"(CAST(a.prior_low AS DOUBLE) / NULLIF(a.prior_loaded, 0)) THEN 'REVIEW_PRESSURE' ELSE 'NO_CANDIDATE' END")
    return f"""
SELECT 'daily_metrics' AS "check", CAST(COUNT(*) AS BIGINT) AS compared,
  CAST(COUNT(*) FILTER (WHERE NOT all_match) AS BIGINT) AS mismatches FROM tol
UNION ALL
SELECT 'hourly_candidate_status', CAST(COUNT(*) AS BIGINT),
  CAST(COUNT(*) FILTER (WHERE ({status}) IS DISTINCT FROM b.candidate_status) AS BIGINT)
FROM rebuilt a FULL JOIN investigation b USING (hour_ts)
UNION ALL
SELECT 'incident_islands', CAST(s.n AS BIGINT),
  CAST(ABS(s.n - (SELECT COUNT(*) FROM incidents))
       + (SELECT COUNT(*) FROM starts WHERE starts_at NOT IN (SELECT starts_at FROM incidents))
       + ABS((SELECT COUNT(*) FROM investigation WHERE candidate_status = 'REVIEW_PRESSURE')
             - (SELECT COALESCE(SUM(candidate_hours), 0) FROM incidents)) AS BIGINT)
FROM (SELECT COUNT(*) AS n FROM starts) s"""


_STARTS = """starts AS (
  SELECT c.hour_ts AS starts_at FROM investigation c WHERE c.candidate_status = 'REVIEW_PRESSURE'
    AND NOT EXISTS (SELECT 1 FROM investigation p WHERE p.candidate_status = 'REVIEW_PRESSURE'
                    AND p.hour_ts = c.hour_ts - INTERVAL 1 HOUR))"""


@query("independent_recheck", _sql(
    O.chain(upto="all") + [_RAW_HOURS, _DIRECT_DAILY, f"tol AS ({_tol_sql()})", _STARTS], _recheck_sql()))
def q_independent_recheck(spark, d):
    """Q16: daily metrics, hourly status and island sizes re-derived a second way (mismatches must be 0)."""
    # the marts' side of all three checks derives from one written hourly table
    h = materialize(hourly(spark, d), "recheck_hourly")
    inv = materialize(rule.investigation(h, reports(spark), SPEC), "recheck_investigation")
    return A.independent_recheck(readings(spark, d), marts.daily_mart(h), inv, inc.incidents(inv, SPEC, materialize_input=False), SPEC)
