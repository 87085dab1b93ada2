"""Semantic metric layer (M0-M7).

A dataset is a DataFrame plus its time column and a registry of named metric
expressions (aggregate ``Column`` builders).  ``metric_query`` renders one
DataFrame: half-open period filter on the dataset's time column -> optional
time-grain truncation and group-by -> metrics -> order -> optional resample
(``asfreq``: NULL rows between the first and last returned point).  Raw mode
(``raw_columns``) returns distinct rows of the listed columns with the time
column truncated to the grain, as the BI table view does.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import date_lit, ntz_lit, ratio
from hourwise.operators.timegrid import asfreq
from hourwise import spec as S
from hourwise.spec import RuleSpec

MetricFn = Callable[[], Column]


@dataclass
class Dataset:
    name: str
    time_col: str | None
    metrics: dict[str, tuple[str, MetricFn]] = field(default_factory=dict)


def _pct(num: Column, den: Column) -> Column:
    return F.lit(100.0) * ratio(num, den)


def common_metrics(daily: bool = False) -> dict[str, tuple[str, MetricFn]]:
    def weighted(sum_col, avg_col):
        if daily:
            return lambda: ratio(F.sum(F.col(avg_col) * F.col("readings")), F.sum("readings"))
        return lambda: ratio(F.sum(sum_col), F.sum("readings"))
    return {
        "observations": ("Observations", lambda: F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint")),
        "loaded_observations": ("Loaded observations",
                                lambda: F.coalesce(F.sum("loaded_readings"), F.lit(0)).cast("bigint")),
        "low_pressure_pct": ("Low pressure among loaded (%)",
                             lambda: _pct(F.sum("low_pressure_loaded_readings"), F.sum("loaded_readings"))),
        "panel_pressure": ("Panel pressure", weighted("panel_pressure_sum", "avg_panel_pressure_bar")),
        "oil_temperature": ("Oil temperature", weighted("oil_temperature_sum", "avg_oil_temperature_c")),
        "pressure_gap": ("Pressure gap", weighted("pressure_gap_sum", "avg_pressure_gap_bar")),
    }


def datasets(spec: RuleSpec) -> dict[str, Dataset]:
    """Dataset registry; metric expressions are built lazily (no Spark needed at definition time)."""
    def cur():
        return F.col("current_samples_insufficient")

    def base():
        return F.col("baseline_samples_insufficient")

    def n():
        return F.count(F.lit(1))
    inv = dict(common_metrics())
    inv.update({
        "candidate_hours": ("Candidate hours", lambda: F.count_if(F.col("candidate_status") == S.REVIEW_PRESSURE)),
        "eligible_hours": ("Eligible hours", lambda: F.count_if(F.col("rule_eligible"))),
        "eligibility_pct": ("Eligibility (%)", lambda: _pct(F.count_if(F.col("rule_eligible")), n())),
        "not_evaluated_hours": ("Not evaluated hours",
                                lambda: F.count_if(F.col("evaluation_status") == S.NOT_EVALUATED)),
        "current_samples_only": ("Current samples only", lambda: F.count_if(cur() & ~base())),
        "baseline_samples_only": ("Baseline samples only", lambda: F.count_if(base() & ~cur())),
        "both_sample_requirements": ("Both sample requirements", lambda: F.count_if(cur() & base())),
        "missing_rates": ("Missing rates", lambda: F.count_if(~cur() & ~base() & ~F.col("rule_eligible"))),
        "observed_hours": ("Observed hours", n),
        # point-only metrics: a value only when the group holds exactly one hour
        "prior_share_pct": ("Prior 7-day loaded share (%)",
                            lambda: F.when(n() == 1, F.lit(100.0) * F.max("prior_low_fraction"))),
        "rule_floor_pct": ("Rule floor (%)", lambda: F.lit(100.0 * spec.share_floor)),
        "multiple_prior_pct": ("Multiple of prior baseline (%)",
                               lambda: F.when(n() == 1,
                                              F.lit(100.0 * spec.prior_multiple) * F.max("prior_low_fraction"))),
    })
    return {
        "mart_hourly": Dataset("mart_hourly", "hour_ts", common_metrics()),
        "mart_daily": Dataset("mart_daily", "reading_date", common_metrics(daily=True)),
        "mart_hourly_investigation": Dataset("mart_hourly_investigation", "hour_ts", inv),
        "mart_incidents": Dataset("mart_incidents", "starts_at",
                                  {"candidate_incidents": ("Candidate incidents", n)}),
        "mart_report_review": Dataset("mart_report_review", "starts_at",
                                      {"maintenance_reports": ("Maintenance reports", n)}),
        "analytics_operating_states": Dataset("analytics_operating_states", "hour_ts", {
            "state_observations": ("State observations",
                                   lambda: F.coalesce(F.sum("observations"), F.lit(0)).cast("bigint"))}),
        "analytics_data_quality": Dataset("analytics_data_quality", None, {
            "source_rows": ("Source rows", lambda: F.max("raw_observations"))}),
    }


GRAINS = {"hour": ("hour", 3600), "day": ("day", 86400)}


def _trunc(col: str, grain: str) -> Column:
    return F.date_trunc(GRAINS[grain][0], F.col(col).cast("timestamp_ntz")).cast("timestamp_ntz")


def metric_query(df: DataFrame, dataset: Dataset, metrics: list[str] | None = None,
                 group_by: list[str] | None = None, time_range: tuple | None = None, grain: str | None = None,
                 timeseries: bool = False, order_by: list | None = None, row_limit: int | None = None,
                 resample: bool = False, raw_columns: list[str] | None = None) -> DataFrame:
    """M0: render a metric query over a dataset DataFrame."""
    t = dataset.time_col
    if time_range is not None and t is not None:
        lo, hi = time_range
        c = F.col(t)
        if dict(df.dtypes)[t] == "date":
            df = df.filter((c >= date_lit(lo)) & (c < date_lit(hi)))
        else:
            df = df.filter((c >= ntz_lit(lo)) & (c < ntz_lit(hi)))
    if raw_columns is not None:
        cols = [(_trunc(c, grain).alias(c) if (c == t and grain) else F.col(c)) for c in raw_columns]
        out = df.select(*cols).distinct()
    else:
        group = list(group_by or [])
        exprs = [F.col(g) for g in group]
        if timeseries:
            exprs = [_trunc(t, grain or "day").alias("ts")] + exprs
        aggs = [dataset.metrics[m][1]().alias(m) for m in (metrics or [])]
        out = df.groupBy(*exprs).agg(*aggs) if exprs else df.agg(*aggs)
        if timeseries and resample:
            out = asfreq(out, "ts", GRAINS[grain or "day"][1], list(group))
    if order_by:
        out = out.orderBy(*order_by)
    if row_limit is not None:
        out = out.limit(row_limit)
    return out
