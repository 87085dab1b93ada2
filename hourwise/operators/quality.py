"""Data-quality queries (Q1-Q5, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import seconds_between, trunc_hour
from hourwise.operators.period import combine_rows, half_open

TIMESTAMP_CONTEXT = "Historical source; timestamp timezone unspecified"


def raw_profile(readings: DataFrame) -> DataFrame:
    """One row: count, bounds, duplicate timestamps, rows missing a core sensor."""
    per_ts = readings.groupBy("observed_at").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("tp3").isNull() | F.col("oil_temperature").isNull()
                   | F.col("motor_current").isNull()).alias("_miss"))
    return per_ts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("raw_observations"),
        F.min("observed_at").alias("first_observation"),
        F.max("observed_at").alias("last_observation"),
        F.coalesce(F.sum(F.col("_n") - F.when(F.col("observed_at").isNotNull(), 1).otherwise(0)), F.lit(0))
        .cast("bigint").alias("duplicate_timestamps"),
        F.coalesce(F.sum("_miss"), F.lit(0)).cast("bigint").alias("missing_core_sensor_rows"))


def data_quality(readings: DataFrame, hourly: DataFrame, state: DataFrame) -> DataFrame:
    """Q1: the 18-column full-source quality row."""
    raw = raw_profile(readings)
    hr = hourly.agg(F.count(F.lit(1)).alias("observed_hours"),
                    F.countDistinct(F.to_date("hour_ts")).alias("observed_dates"),
                    F.sum("readings").cast("bigint").alias("hourly_observations"),
                    F.sum(F.col("loaded_readings") + F.col("unloaded_readings") + F.col("idle_readings"))
                    .cast("bigint").alias("state_observations"))
    row = combine_rows(raw, hr, state)
    span = F.round(seconds_between(trunc_hour("last_observation"), trunc_hour("first_observation")) / 3600 + 1).cast("bigint")
    return row.select(
        "raw_observations", "first_observation", "last_observation", "duplicate_timestamps",
        "missing_core_sensor_rows", "observed_hours", "observed_dates", "hourly_observations",
        "state_observations",
        (span - F.col("observed_hours")).alias("unobserved_hour_windows"),
        (F.col("raw_observations") - F.col("hourly_observations")).alias("reconciliation_difference"),
        (F.col("state_observations") - F.col("hourly_observations")).alias("state_reconciliation_difference"),
        "original_rows", "is_complete_source", "pipeline_loaded_at", "source_name", "source_sha256",
        F.lit(TIMESTAMP_CONTEXT).alias("timestamp_context"))


def table_sizes(readings: DataFrame, hourly: DataFrame, daily: DataFrame, reports: DataFrame) -> DataFrame:
    """Q2: row counts of the four relations (one row, no cross join)."""
    return combine_rows(readings.agg(F.count(F.lit(1)).alias("source_rows")),
                        hourly.agg(F.count(F.lit(1)).alias("hourly_rows")),
                        daily.agg(F.count(F.lit(1)).alias("daily_rows")),
                        reports.agg(F.count(F.lit(1)).alias("public_report_windows")))


def lost_rows(readings: DataFrame, hourly: DataFrame) -> DataFrame:
    """Q3: raw rows minus Σ hourly readings (must be 0)."""
    row = combine_rows(readings.agg(F.count(F.lit(1)).alias("_raw")),
                       hourly.agg(F.coalesce(F.sum("readings"), F.lit(0)).alias("_hourly")))
    return row.select((F.col("_raw") - F.col("_hourly")).cast("bigint").alias("lost_rows"))


def duplicate_timestamps(readings: DataFrame) -> DataFrame:
    """Q4: duplicate timestamp count and reading bounds."""
    return raw_profile(readings).select(F.col("duplicate_timestamps").alias("duplicate_timestamp_count"),
                                        F.col("first_observation").alias("first_reading"),
                                        F.col("last_observation").alias("last_reading"))


def month_slice(hourly: DataFrame, lo, hi) -> DataFrame:
    """Q5: half-open hourly slice, ordered (plan via ``explain``)."""
    return (half_open(hourly, "hour_ts", lo, hi)
            .select("hour_ts", "avg_panel_pressure_bar", "avg_oil_temperature_c").orderBy("hour_ts"))
