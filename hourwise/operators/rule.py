"""Versioned threshold rule: candidate hours (C1), report overlap (J1), and the
33-column investigation table (C2) that keeps "not evaluated" apart from
"evaluated, no breach".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import ratio, trunc_hour
from hourwise.operators.baseline import trailing_baseline
from hourwise.operators.marts import HOURLY_COLUMNS
from hourwise import spec as S
from hourwise.spec import RuleSpec

CANDIDATE_EXTRA = ["prior_low_readings", "prior_loaded_readings", "prior_observed_hours",
                   "current_low_fraction", "prior_low_fraction", "rule_version", "candidate_status"]

INVESTIGATION_COLUMNS = HOURLY_COLUMNS + CANDIDATE_EXTRA + [
    "overlaps_reported_failure", "current_samples_insufficient", "baseline_samples_insufficient",
    "rule_eligible", "evaluation_status", "exclusion_reason", "required_current_loaded_observations",
    "required_prior_loaded_observations", "baseline_start_inclusive", "baseline_end_exclusive",
    "prior_unobserved_hour_windows"]


def candidate_hours(hourly: DataFrame, spec: RuleSpec, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    base = trailing_baseline(hourly, spec.lookback_seconds, spec.grain_seconds, keys=keys)
    cur = F.col("current_low_fraction")
    prior = F.col("prior_low_fraction")
    status = (F.when((F.col("loaded_readings") < spec.min_current_loaded)
                     | (F.coalesce(F.col("prior_loaded_readings"), F.lit(0)) < spec.min_prior_loaded),
                     F.lit(S.INSUFFICIENT_HISTORY))
              .when((cur >= F.lit(spec.share_floor)) & (cur >= F.lit(spec.prior_multiple) * prior),
                    F.lit(S.REVIEW_PRESSURE))
              .otherwise(F.lit(S.NO_CANDIDATE)))
    rates = base.withColumns({
        "current_low_fraction": ratio("low_pressure_loaded_readings", "loaded_readings"),
        "prior_low_fraction": ratio("prior_low_readings", "prior_loaded_readings")})
    return (rates.withColumns({"rule_version": F.lit(spec.version), "candidate_status": status})
            .select(*keys, *HOURLY_COLUMNS, *CANDIDATE_EXTRA))


def overlapping_hours(reports: DataFrame, grain_seconds: int = 3600) -> DataFrame:
    """Distinct hour starts ``h`` with ``h < ends_at AND h + grain > starts_at`` for some report.

    Enumerated per report with ``sequence`` (size = covered hours, independent of
    the readings volume), so the overlap mark becomes an equi-join on ``hour_ts``.
    """
    step = F.expr(f"INTERVAL {grain_seconds} SECONDS")
    first = trunc_hour("starts_at")
    last = trunc_hour(F.col("ends_at") - F.expr("INTERVAL 1 MICROSECOND"))
    return (reports.select(F.explode(F.sequence(first, last, step)).alias("hour_ts"))
            .distinct())


def mark_report_overlap(hours: DataFrame, reports: DataFrame, grain_seconds: int = 3600,
                        name: str = "overlaps_reported_failure") -> DataFrame:
    """EXISTS-style mark join: every input row kept, plus a non-null boolean flag."""
    oh = overlapping_hours(reports, grain_seconds).withColumn("_hit", F.lit(True))
    return (hours.join(oh, on="hour_ts", how="left")
            .withColumn(name, F.coalesce(F.col("_hit"), F.lit(False)))
            .drop("_hit"))


def eligibility_columns(df: DataFrame, spec: RuleSpec) -> DataFrame:
    lab = spec.exclusion_labels()
    cur_ins = F.col("current_samples_insufficient")
    base_ins = F.col("baseline_samples_insufficient")
    rate_missing = F.col("current_low_fraction").isNull() | F.col("prior_low_fraction").isNull()
    flags = df.withColumns({
        "current_samples_insufficient": F.coalesce(F.col("loaded_readings"), F.lit(0)) < spec.min_current_loaded,
        "baseline_samples_insufficient": F.coalesce(F.col("prior_loaded_readings"), F.lit(0)) < spec.min_prior_loaded})
    return flags.withColumns({
        "rule_eligible": ~(cur_ins | base_ins) & ~rate_missing,
        "evaluation_status": (F.when(cur_ins | base_ins | rate_missing, F.lit(S.NOT_EVALUATED))
                              .when(F.col("candidate_status") == S.REVIEW_PRESSURE, F.lit(S.EVALUATED_BREACH))
                              .when(F.col("candidate_status") == S.NO_CANDIDATE, F.lit(S.EVALUATED_NO_BREACH))
                              .otherwise(F.lit(S.NOT_EVALUATED))),
        "exclusion_reason": (F.when(cur_ins & base_ins, F.lit(lab["both"]))
                             .when(cur_ins, F.lit(lab["current"]))
                             .when(base_ins, F.lit(lab["baseline"]))
                             .when(rate_missing, F.lit(lab["missing"]))
                             .otherwise(F.lit(lab["none"]))),
        "required_current_loaded_observations": F.lit(spec.min_current_loaded).cast("int"),
        "required_prior_loaded_observations": F.lit(spec.min_prior_loaded).cast("int"),
        "baseline_start_inclusive": F.col("hour_ts") - F.expr(f"INTERVAL {spec.lookback_seconds} SECONDS"),
        "baseline_end_exclusive": F.col("hour_ts"),
        "prior_unobserved_hour_windows": (F.lit(spec.window_hours) - F.col("prior_observed_hours")).cast("bigint")})


def investigation(hourly: DataFrame, reports: DataFrame, spec: RuleSpec,
                  keys: list[str] | None = None, candidates: DataFrame | None = None) -> DataFrame:
    keys = list(keys or [])
    cand = candidates if candidates is not None else candidate_hours(hourly, spec, keys)
    marked = mark_report_overlap(cand, reports, spec.grain_seconds)
    return eligibility_columns(marked, spec).select(*keys, *INVESTIGATION_COLUMNS)
