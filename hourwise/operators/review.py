"""Report context: reports x candidate hours (C4, C5, C6) and the per-report
evidence/context windows (T5, T6, T7).

Range joins between report intervals and hours are rewritten as equi-joins:
each report is enumerated into the hour slots its join predicate can match
(``sequence``; size = hours covered by reports, independent of the readings
volume), joined to the hour table on ``hour_ts``, counted, and finally
right-joined to the report list so reports without matches show 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import ceil_hour, join_keys, ntz_lit, trunc_hour
from hourwise import spec as S

REPORT_KEY = ["report_id", "report_type", "starts_at", "ends_at"]


def _hours(x: int):
    return F.expr(f"INTERVAL {x} HOURS")


def report_slots(reports: DataFrame, first, last, step_seconds: int = 3600) -> DataFrame:
    """One row per (report, aligned hour in [first, last])."""
    return reports.select(*REPORT_KEY, F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step_seconds} SECONDS")))
                          .alias("hour_ts"))


def _review_counts(reports: DataFrame, candidates: DataFrame, first, last, counts: dict) -> DataFrame:
    cand = candidates.filter(F.col("candidate_status") == S.REVIEW_PRESSURE).select("hour_ts")
    matched = (report_slots(reports, first, last).join(cand, on="hour_ts", how="inner")
               .groupBy("report_id").agg(*[F.count_if(cond).alias(name) for name, cond in counts.items()]))
    out = reports.select(*REPORT_KEY).join(matched, on="report_id", how="left")
    return out.select(*REPORT_KEY, *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in counts])


def report_review(reports: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose hour *ends* in the prior 24 h, and candidates overlapping the report."""
    h, s, e = F.col("hour_ts"), F.col("starts_at"), F.col("ends_at")
    one = _hours(1)
    counts = {
        "candidate_hours_ending_in_prior_24h": h + one <= s,
        "candidate_hours_overlapping_report": (h < e) & (h + one > s),
    }
    # join predicate h + 1h > s - 24h AND h < e  <=>  trunc(s - 24h) <= h <= trunc(e - 1us)
    first = trunc_hour(s - _hours(24))
    last = trunc_hour(e - F.expr("INTERVAL 1 MICROSECOND"))
    return _review_counts(reports, candidates, first, last, counts)


def retrospective_review(reports: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates *starting* in [s - 24h, s) and in [s, e); ordered by report start."""
    h, s, e = F.col("hour_ts"), F.col("starts_at"), F.col("ends_at")
    counts = {
        "candidate_hours_in_prior_24h": (h >= s - _hours(24)) & (h < s),
        "candidate_hours_during_report": (h >= s) & (h < e),
    }
    first = ceil_hour(s - _hours(24))
    last = trunc_hour(e - F.expr("INTERVAL 1 MICROSECOND"))
    return _review_counts(reports, candidates, first, last, counts).orderBy("starts_at")


def candidate_totals(investigation: DataFrame) -> DataFrame:
    rev = F.col("candidate_status") == S.REVIEW_PRESSURE
    return investigation.agg(
        F.count_if(rev).alias("review_candidate_hours"),
        F.count_if(rev & F.col("overlaps_reported_failure")).alias("candidates_overlapping_reports"))


def report_context(reports: DataFrame, investigation: DataFrame, days: int = 3) -> DataFrame:
    """Per report: hour window [floor(s - N d), ceil(e + N d)); observed, missing, candidate hours."""
    if days < 0:
        raise ValueError("context days must not be negative")
    s, e = F.col("starts_at"), F.col("ends_at")
    nd = F.expr(f"INTERVAL {days} DAYS")
    win = reports.select(*REPORT_KEY, trunc_hour(s - nd).alias("window_start"), ceil_hour(e + nd).alias("window_end"))
    slots = win.select("report_id", F.explode(F.sequence(
        "window_start", F.col("window_end") - _hours(1), _hours(1))).alias("hour_ts"))
    hours = investigation.select("hour_ts", "candidate_status").groupBy("hour_ts").agg(
        F.count_if(F.col("candidate_status") == S.REVIEW_PRESSURE).alias("_cand"))
    obs = (slots.join(hours, on="hour_ts", how="inner").groupBy("report_id")
           .agg(F.count(F.lit(1)).alias("observed_hours"), F.count_if(F.col("_cand") > 0).alias("candidate_hours")))
    expected = (F.unix_seconds(F.col("window_end").cast("timestamp"))
                - F.unix_seconds(F.col("window_start").cast("timestamp"))) / 3600
    return (win.join(obs, on="report_id", how="left")
            .select(*REPORT_KEY, "window_start", "window_end",
                    expected.cast("bigint").alias("expected_hours"),
                    F.coalesce("observed_hours", F.lit(0)).cast("bigint").alias("observed_hours"),
                    (expected.cast("bigint") - F.coalesce("observed_hours", F.lit(0))).cast("bigint")
                    .alias("missing_hours"),
                    F.coalesce("candidate_hours", F.lit(0)).cast("bigint").alias("candidate_hours")))


def incident_evidence(incidents: DataFrame, investigation: DataFrame, lookback_days: int = 7,
                      keys: list[str] | None = None) -> DataFrame:
    """Dense hourly evidence for every incident over ``[start - lookback, end)``; gaps stay NULL."""
    keys = list(keys or [])
    grid = incidents.select(*keys, "incident_id", F.explode(F.sequence(
        F.col("starts_at") - F.expr(f"INTERVAL {lookback_days} DAYS"), F.col("ends_at") - _hours(1), _hours(1)))
        .alias("hour_ts"))
    vals = investigation.select(*keys, "hour_ts", "readings", "loaded_readings", "low_pressure_loaded_readings",
                                "current_low_fraction", "prior_low_fraction", "candidate_status")
    return join_keys(grid, vals, [*keys, "hour_ts"], "left")


def clip_reports(reports: DataFrame, lo, hi, hours: DataFrame | None = None) -> DataFrame:
    """Reports overlapping [lo, hi) with bands clipped to the range (overlay bands).

    With ``hours``, also counts the observed hours overlapping each clipped band
    (band enumerated into hour slots, equi-joined on ``hour_ts``).
    """
    lo_c, hi_c = ntz_lit(lo), ntz_lit(hi)
    bands = (reports.filter((F.col("starts_at") < hi_c) & (F.col("ends_at") > lo_c))
             .select(*REPORT_KEY, F.greatest("starts_at", lo_c).alias("band_start"),
                     F.least("ends_at", hi_c).alias("band_end")))
    if hours is None:
        return bands
    slots = bands.select("report_id", F.explode(F.sequence(
        trunc_hour("band_start"), trunc_hour(F.col("band_end") - F.expr("INTERVAL 1 MICROSECOND")), _hours(1)))
        .alias("hour_ts"))
    observed = hours.select("hour_ts").distinct()
    counts = slots.join(observed, on="hour_ts", how="inner").groupBy("report_id").agg(
        F.count(F.lit(1)).alias("observed_hours_in_band"))
    return (bands.join(counts, on="report_id", how="left")
            .withColumn("observed_hours_in_band", F.coalesce("observed_hours_in_band", F.lit(0)).cast("bigint")))
