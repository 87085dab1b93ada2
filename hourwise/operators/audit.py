"""Reproducible audit queries (Q6-Q16, Q18): each re-derives a result a
second way or states an invariant as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import null_safe_differs, ratio, trunc_hour, within_tolerance
from hourwise.operators.baseline import trailing_baseline_join
from hourwise.operators.marts import state_predicates
from hourwise.operators.period import combine_rows, half_open
from hourwise.operators.timegrid import distinct_time_deltas, stitched_lag, weighted_percentile_disc
from hourwise import spec as S
from hourwise.session import materialize
from hourwise.spec import RuleSpec


def reconciliation(inv: DataFrame, spec: RuleSpec) -> DataFrame:
    """Q6: 17 reconciliation measures + bounds in one aggregate."""
    cur, base = F.col("current_samples_insufficient"), F.col("baseline_samples_insufficient")
    elig = F.col("rule_eligible")
    st = F.col("evaluation_status")
    n = F.count(F.lit(1))
    return inv.agg(
        n.alias("observed_hours"),
        F.count_if(elig).alias("eligible_hours"),
        (F.lit(100.0) * F.count_if(elig) / F.nullif(n, F.lit(0))).alias("eligibility_percentage"),
        F.count_if(st == S.NOT_EVALUATED).alias("not_evaluated_hours"),
        F.count_if(st == S.EVALUATED_NO_BREACH).alias("evaluated_no_breach"),
        F.count_if(st == S.EVALUATED_BREACH).alias("evaluated_breach"),
        F.count_if(cur & ~base).alias("current_only"),
        F.count_if(base & ~cur).alias("baseline_only"),
        F.count_if(cur & base).alias("both"),
        F.count_if(F.col("loaded_readings") == 0).alias("zero_current_loaded"),
        F.count_if(F.col("loaded_readings").between(1, spec.min_current_loaded - 1)).alias("current_loaded_below_min"),
        F.count_if(F.col("prior_loaded_readings").isNull()).alias("null_prior_counts"),
        F.count_if(F.col("current_low_fraction").isNull()).alias("null_current_rate"),
        F.count_if(F.col("prior_low_fraction").isNull()).alias("null_prior_rate"),
        F.count_if(elig & (F.col("current_low_fraction").isNull() | F.col("prior_low_fraction").isNull()))
        .alias("eligible_null_rate"),
        F.count_if(F.col("prior_observed_hours") == spec.window_hours).alias("complete_prior_hour_windows"),
        F.min("hour_ts").alias("first_hour"), F.max("hour_ts").alias("last_hour"))


def exclusion_periods(inv: DataFrame) -> DataFrame:
    """Q7: hours, first and last hour per exclusion reason."""
    return (inv.groupBy("exclusion_reason")
            .agg(F.count(F.lit(1)).alias("hours"), F.min("hour_ts").alias("first_hour"),
                 F.max("hour_ts").alias("last_hour"))
            .orderBy("exclusion_reason"))


def raw_hours(readings: DataFrame, spec: RuleSpec, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    p = state_predicates(spec)
    return (readings.groupBy(*keys, trunc_hour("observed_at").alias("hour_ts"))
            .agg(F.count(F.lit(1)).alias("readings"), F.count_if(p["loaded"]).alias("loaded"),
                 F.count_if(p["low"]).alias("low")))


def independent_window(readings: DataFrame, spec: RuleSpec, keys: list[str] | None = None) -> DataFrame:
    """Raw -> hour counts -> bucketed self range join (J4): the window's second derivation."""
    return trailing_baseline_join(raw_hours(readings, spec, keys), spec.lookback_seconds, keys)


def window_vs_join(readings: DataFrame, inv: DataFrame, spec: RuleSpec) -> DataFrame:
    """Q8 (J5, P13, U3): full join of the two derivations; null-safe row mismatch counts."""
    a = independent_window(readings, spec)
    b = inv.select("hour_ts", F.col("readings").alias("b_readings"), "loaded_readings",
                   "low_pressure_loaded_readings", "prior_loaded_readings", "prior_low_readings",
                   "prior_observed_hours", "rule_eligible")
    j = a.join(b, on="hour_ts", how="full")
    differs = null_safe_differs(
        ["readings", "loaded", "low", "prior_loaded", "prior_low", "prior_hours"],
        ["b_readings", "loaded_readings", "low_pressure_loaded_readings", "prior_loaded_readings",
         "prior_low_readings", "prior_observed_hours"])
    elig_a = (F.col("loaded") >= spec.min_current_loaded) & (F.coalesce("prior_loaded", F.lit(0)) >= spec.min_prior_loaded)
    return j.agg(F.count(F.lit(1)).alias("compared_hours"),
                 F.count_if(differs).alias("mismatched_hours"),
                 F.count_if(~elig_a.eqNullSafe(F.col("rule_eligible"))).alias("mismatched_eligibility"))


def cadence(readings: DataFrame, row_bucket: int = 1_000_000, gap_seconds: float = 20.0) -> DataFrame:
    """Q9: duplicates, source-order reversals, discrete median interval, gaps, largest gap."""
    d = materialize(distinct_time_deltas(readings), "time_deltas")  # read by three aggregates
    # time order: n-1 zero deltas per timestamp plus one delta per distinct timestamp
    time_stats = d.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("observations"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_timestamps"),
        F.count_if(F.col("delta_seconds") > gap_seconds).alias("gaps_over_20_seconds"),
        F.max(F.when(F.col("n") > 1, F.lit(0.0)).otherwise(F.col("delta_seconds"))).alias("_maxdup"),
        F.max("delta_seconds").alias("_maxd"))
    weights = (d.select(F.col("delta_seconds").alias("v"), F.lit(1).cast("bigint").alias("w"))
               .unionByName(d.filter(F.col("n") > 1).select(F.lit(0.0).alias("v"),
                                                              (F.col("n") - 1).cast("bigint").alias("w"))))
    median = weighted_percentile_disc(weights, "v", "w", 0.5).select(F.col("v").alias("median_interval_seconds"))
    # source order: LAG by unique source_row, bucketed by row range
    src = stitched_lag(readings.select("source_row", "observed_at"), "source_row", "observed_at", "_prev",
                       F.floor(F.col("source_row") / F.lit(row_bucket)))
    rev = src.agg(F.count_if(F.col("observed_at") < F.col("_prev")).alias("source_order_reversals"))
    row = combine_rows(time_stats, median, rev)
    return row.select("observations", "duplicate_timestamps", "source_order_reversals", "median_interval_seconds",
                      "gaps_over_20_seconds",
                      F.greatest("_maxd", "_maxdup").alias("largest_gap_seconds"))


def largest_gaps(readings: DataFrame, n: int = 10) -> DataFrame:
    """Q11: the n largest consecutive gaps (ties broken by the later timestamp)."""
    d = materialize(distinct_time_deltas(readings), "time_deltas")  # read twice (steps, zero gaps)
    steps = d.filter(F.col("previous_at").isNotNull()).select("previous_at", "observed_at",
                                                               F.col("delta_seconds").alias("gap_seconds"))
    # duplicate timestamps contribute zero gaps; at most n of them can ever be selected
    zeros = (d.filter(F.col("n") > 1)
             .select(F.col("observed_at").alias("previous_at"), "observed_at",
                     F.lit(0.0).alias("gap_seconds"),
                     F.explode(F.sequence(F.lit(1), F.least(F.col("n") - 1, F.lit(n)).cast("int"))).alias("_i"))
             .drop("_i"))
    return steps.unionByName(zeros).orderBy(F.col("gap_seconds").desc(), F.col("observed_at")).limit(n)


def sample_distribution(inv: DataFrame, spec: RuleSpec) -> DataFrame:
    """Q10: discrete percentiles of hourly loaded/total readings (one column each) and counts."""
    lp = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    tp = [0.0, 0.25, 0.5, 0.75, 1.0]
    def pd(col, p):
        return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {col})").cast("bigint")
    cols = [pd("loaded_readings", p).alias(f"loaded_p{int(p * 100):03d}") for p in lp]
    cols += [pd("readings", p).alias(f"total_p{int(p * 100):03d}") for p in tp]
    big = 350 * spec.min_current_loaded // 30
    incomplete = F.col("prior_observed_hours") < spec.window_hours
    return inv.agg(*cols,
                   F.count_if((F.col("loaded_readings") < spec.min_current_loaded) & (F.col("readings") >= big))
                   .alias("excluded_current_despite_high_total"),
                   F.count_if(incomplete).alias("incomplete_prior_windows"),
                   F.count_if(incomplete & F.col("rule_eligible")).alias("eligible_despite_incomplete_prior_window"))


def proxy_comparison(readings: DataFrame, spec: RuleSpec) -> DataFrame:
    """Q12: observations and current statistics by (dv_electric, comp)."""
    p = state_predicates(spec)
    return (readings.groupBy("dv_electric", "comp")
            .agg(F.count(F.lit(1)).alias("observations"), F.count_if(p["loaded"]).alias("current_loaded"),
                 F.count_if(p["low"]).alias("current_loaded_low_pressure"),
                 F.min("motor_current").alias("min_current_a"), F.max("motor_current").alias("max_current_a"),
                 F.avg("motor_current").alias("mean_current_a"))
            .orderBy("dv_electric", "comp"))


def integrity(readings: DataFrame, spec: RuleSpec) -> DataFrame:
    """Q13: NULL rule inputs and the 2x2 agreement of current-proxy vs valve loaded."""
    p = state_predicates(spec)
    valve = F.col("dv_electric") == 1
    return readings.agg(
        F.count_if(F.col("observed_at").isNull() | F.col("motor_current").isNull() | F.col("tp3").isNull())
        .alias("null_rule_inputs"),
        F.count_if(p["loaded"]).alias("current_proxy_loaded_observations"),
        F.count_if(valve).alias("valve_loaded_observations"),
        F.count_if(p["loaded"] & valve).alias("agreeing_loaded_observations"),
        F.count_if(p["loaded"] & (F.col("dv_electric") == 0)).alias("proxy_only_observations"),
        F.count_if(~p["loaded"] & valve).alias("valve_only_observations"),
        F.count_if(p["low"]).alias("rule_low_pressure_observations"))


def missing_rates(investigation: DataFrame) -> DataFrame:
    """Hours with enough samples on both sides that are not eligible all the same: a rate is missing."""
    enough = ~F.col("current_samples_insufficient") & ~F.col("baseline_samples_insufficient")
    return investigation.agg(F.count_if(enough & ~F.col("rule_eligible")).alias("missing_rates"))


def invariants(recon: DataFrame, window_check: DataFrame, missing: DataFrame) -> DataFrame:
    """Q14: audit invariants as rows ``(check, expected, actual, ok)``."""
    row = combine_rows(recon, window_check, missing)
    checks = {
        "eligible_plus_not_evaluated_equals_observed": (F.col("observed_hours"),
                                                        F.col("eligible_hours") + F.col("not_evaluated_hours")),
        "evaluated_split_equals_eligible": (F.col("eligible_hours"),
                                            F.col("evaluated_no_breach") + F.col("evaluated_breach")),
        "exclusion_reasons_sum_to_not_evaluated": (
            F.col("not_evaluated_hours"),
            F.col("current_only") + F.col("baseline_only") + F.col("both") + F.col("missing_rates")),
        "eligible_null_rate_is_zero": (F.lit(0).cast("bigint"), F.col("eligible_null_rate")),
        "compared_equals_observed": (F.col("observed_hours"), F.col("compared_hours")),
        "window_mismatches_zero": (F.lit(0).cast("bigint"), F.col("mismatched_hours")),
        "eligibility_mismatches_zero": (F.lit(0).cast("bigint"), F.col("mismatched_eligibility")),
    }
    arr = F.array(*[F.struct(F.lit(k).alias("check"), e.cast("bigint").alias("expected"),
                             a.cast("bigint").alias("actual")) for k, (e, a) in checks.items()])
    return row.select(F.inline(arr)).withColumn("ok", F.col("expected") == F.col("actual"))


def weighted_rollup_check(readings: DataFrame, hourly: DataFrame, daily: DataFrame, spec: RuleSpec,
                          periods: list[tuple]) -> DataFrame:
    """Q15: raw aggregates vs hourly (sum form) and daily (mean*n form) roll-ups per period."""
    p = state_predicates(spec)
    # both marts are read once per period: write them once
    hourly, daily = materialize(hourly, "rollup_hourly"), materialize(daily, "rollup_daily")
    out = None
    for lo, hi in periods:
        raw = half_open(readings, "observed_at", lo, hi).agg(
            F.count(F.lit(1)).alias("raw_observation_count"), F.avg("tp3").alias("raw_panel"),
            F.avg("oil_temperature").alias("raw_oil"), F.count_if(p["loaded"]).alias("raw_loaded"),
            F.count_if(p["low"]).alias("raw_low"))
        for model, src, tcol, panel, oil in [
                ("hourly_mart", hourly, "hour_ts", F.col("panel_pressure_sum"), F.col("oil_temperature_sum")),
                ("daily_mart", daily, "reading_date", F.col("avg_panel_pressure_bar") * F.col("readings"),
                 F.col("avg_oil_temperature_c") * F.col("readings"))]:
            rolled = half_open(src, tcol, lo, hi).agg(
                F.sum("readings").alias("m_n"), ratio(F.sum(panel), F.sum("readings")).alias("m_panel"),
                ratio(F.sum(oil), F.sum("readings")).alias("m_oil"),
                F.sum("loaded_readings").alias("m_loaded"), F.sum("low_pressure_loaded_readings").alias("m_low"))
            row = combine_rows(raw, rolled).select(
                F.lit(model).alias("model"), F.lit(str(lo)[:10]).alias("start_inclusive"),
                F.lit(str(hi)[:10]).alias("end_exclusive"), "raw_observation_count",
                F.col("raw_panel").alias("panel_pressure_bar"), F.col("raw_oil").alias("oil_temperature_c"),
                F.col("raw_loaded").alias("loaded_observations"),
                F.col("raw_low").alias("low_pressure_loaded_observations"),
                (within_tolerance("raw_observation_count", "m_n") & within_tolerance("raw_panel", "m_panel")
                 & within_tolerance("raw_oil", "m_oil") & within_tolerance("raw_loaded", "m_loaded")
                 & within_tolerance("raw_low", "m_low")).alias("weighted_rollup_matches_raw"))
            out = row if out is None else out.unionByName(row)
    return out


def regression_counts(inv: DataFrame) -> DataFrame:
    """Q18: observed, eligible and breach hours (alert-admin regression counts)."""
    return inv.agg(F.count(F.lit(1)).alias("observed_hours"),
                   F.count_if(F.col("rule_eligible")).alias("eligible_hours"),
                   F.count_if(F.col("evaluation_status") == S.EVALUATED_BREACH).alias("breach_hours"))


def direct_daily(readings: DataFrame, spec: RuleSpec) -> DataFrame:
    """Daily aggregates straight from raw readings (no hourly mart), for Q16."""
    p = state_predicates(spec)
    gap = F.abs(F.col("tp3") - F.col("reservoirs"))
    return (readings.groupBy(F.to_date("observed_at").alias("reading_date"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.count_if(p["loaded"]).cast("bigint").alias("loaded_readings"),
                 F.count_if(p["low"]).cast("bigint").alias("low_pressure_loaded_readings"),
                 F.avg("tp3").alias("avg_panel_pressure_bar"), F.avg(gap).alias("avg_pressure_gap_bar"),
                 F.avg("oil_temperature").alias("avg_oil_temperature_c")))


def independent_recheck(readings: DataFrame, daily: DataFrame, inv: DataFrame, incidents: DataFrame,
                        spec: RuleSpec) -> DataFrame:
    """Q16: re-derive daily metrics, hourly status and island sizes a second way; count mismatches."""
    from hourwise.operators.compare import tolerance_compare
    inv = materialize(inv, "recheck_investigation")  # read by the status and the islands checks
    cols = ["readings", "loaded_readings", "low_pressure_loaded_readings", "avg_panel_pressure_bar",
            "avg_pressure_gap_bar", "avg_oil_temperature_c"]
    dd = tolerance_compare(direct_daily(readings, spec), daily, ["reading_date"], cols, rel=1e-9, abs_tol=1e-9)
    daily_row = dd.agg(F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("all_match")).alias("mismatches"))

    j = independent_window(readings, spec)
    cur = ratio("low", "loaded")
    prior = ratio("prior_low", "prior_loaded")
    status = (F.when((F.col("loaded") < spec.min_current_loaded)
                     | (F.coalesce("prior_loaded", F.lit(0)) < spec.min_prior_loaded), F.lit(S.INSUFFICIENT_HISTORY))
              .when((cur >= spec.share_floor) & (cur >= F.lit(spec.prior_multiple) * prior), F.lit(S.REVIEW_PRESSURE))
              .otherwise(F.lit(S.NO_CANDIDATE)))
    st = j.select("hour_ts", status.alias("status_join")).join(
        inv.select("hour_ts", "candidate_status"), on="hour_ts", how="full")
    status_row = st.agg(F.count(F.lit(1)).alias("compared"),
                        F.count_if(~F.col("status_join").eqNullSafe(F.col("candidate_status"))).alias("mismatches"))

    # islands a second way: a candidate hour starts an island iff the previous hour is not a candidate
    cand = inv.filter(F.col("candidate_status") == S.REVIEW_PRESSURE).select("hour_ts")
    prev = cand.select((F.col("hour_ts") + F.expr(f"INTERVAL {spec.grain_seconds} SECONDS")).alias("hour_ts"))
    starts = cand.join(prev, on="hour_ts", how="left_anti").select(F.col("hour_ts").alias("starts_at"))
    cnt_starts = starts.agg(F.count(F.lit(1)).alias("_a"))
    cnt_inc = incidents.agg(F.count(F.lit(1)).alias("_b"))
    missing = starts.join(incidents.select("starts_at"), on="starts_at", how="left_anti").agg(
        F.count(F.lit(1)).alias("_m"))
    hours_total = combine_rows(cand.agg(F.count(F.lit(1)).alias("_h")),
                               incidents.agg(F.coalesce(F.sum("candidate_hours"), F.lit(0)).alias("_ih")))
    isl = combine_rows(cnt_starts, cnt_inc, missing, hours_total).select(
        F.col("_a").alias("compared"),
        (F.abs(F.col("_a") - F.col("_b")) + F.col("_m") + F.abs(F.col("_h") - F.col("_ih"))).alias("mismatches"))

    def tag(df, name):
        return df.select(F.lit(name).alias("check"), F.col("compared").cast("bigint"),
                         F.col("mismatches").cast("bigint"))
    return (tag(daily_row, "daily_metrics").unionByName(tag(status_row, "hourly_candidate_status"))
            .unionByName(tag(isl, "incident_islands")))

