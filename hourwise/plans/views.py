"""Temporary views with the reference's relation names, so existing SQL runs on Spark SQL.

``register_views`` defines every relation lazily (no data is computed or kept
until a query runs, so each view follows its source): ``readings``, ``failure_reports``, ``mart_hourly``, ``mart_daily``,
``mart_candidate_hours``, ``mart_hourly_investigation``, ``mart_incidents``,
``mart_report_review``, ``analytics_operating_states``, ``analytics_data_quality``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourwise.operators import incidents as inc, marts, quality, review, rule
from hourwise.sources.snapshot import provenance_row
from hourwise.spec import RuleSpec


def register_views(spark: SparkSession, readings: DataFrame, reports: DataFrame, spec: RuleSpec,
                   state: DataFrame | None = None, source_name: str = "readings") -> dict[str, DataFrame]:
    hourly = marts.hourly_mart(readings, spec)
    cand = rule.candidate_hours(hourly, spec)
    inv = rule.investigation(hourly, reports, spec, candidates=cand)
    if state is None:
        state = provenance_row(readings, "unrecorded", source_name, None, True).select(
            "original_rows", "is_complete_source", "loaded_at", "source_name", "source_sha256")
    state = state.withColumnRenamed("loaded_at", "pipeline_loaded_at")
    views = {
        "readings": readings,
        "failure_reports": reports,
        "mart_hourly": hourly,
        "mart_daily": marts.daily_mart(hourly),
        "mart_candidate_hours": cand,
        "mart_hourly_investigation": inv,
        "mart_incidents": inc.incidents(inv, spec, materialize_input=False),
        "mart_report_review": review.report_review(reports, cand),
        "analytics_operating_states": marts.operating_states(hourly, spec),
        "analytics_data_quality": quality.data_quality(readings, hourly, state),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
