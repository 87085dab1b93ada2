"""Readings adapter for the driver's tables, and the report interval table.

There is no sensor table in the test data; ``readings_from_events`` derives the
canonical raw-reading schema from ``events`` with narrow, pushdown-friendly
projections (no shuffle).  ``READINGS_SQL`` is the same derivation in ANSI SQL
for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, StringType, StructField, StructType, TimestampNTZType)

from hourwise.functions.columns import local_frame
from hourwise.session import ensure_utc

ASSETS = 8


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _flag(cond) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("smallint")


def readings_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    et = F.col("event_type")
    return events.select(
        (eid + 1).alias("source_row"),
        F.col("ts").cast("timestamp_ntz").alias("observed_at"),
        (F.col("user_id") % ASSETS).cast("bigint").alias("asset_id"),
        (eid % 13).cast("double").alias("tp2"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("tp3"),
        (eid % 7).cast("double").alias("h1"),
        (eid % 3).cast("double").alias("dv_pressure"),
        (eid % 100).cast("double").alias("reservoirs"),
        (eid % 50 + 40).cast("double").alias("oil_temperature"),
        F.col("value").cast("double").alias("motor_current"),
        _flag(et.isin("view", "click")).alias("comp"),
        _flag(et.isin("purchase", "click")).alias("dv_electric"),
        _flag(et == "signup").alias("towers"),
        (eid % 2).cast("smallint").alias("mpg"),
        _flag(et == "error").alias("lps"),
        _flag(F.col("value") >= 10).alias("pressure_switch"),
        (1 - eid % 2).cast("smallint").alias("oil_level"),
        (F.col("user_id") % 2).cast("double").alias("caudal_impulse"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return readings_from_events(load_table(spark, sf_dir, "events"))


READINGS_SQL = """readings AS (
  SELECT event_id + 1 AS source_row, CAST(ts AS TIMESTAMP) AS observed_at,
    CAST(user_id % 8 AS BIGINT) AS asset_id,
    CAST(event_id % 13 AS DOUBLE) AS tp2,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS tp3,
    CAST(event_id % 7 AS DOUBLE) AS h1,
    CAST(event_id % 3 AS DOUBLE) AS dv_pressure,
    CAST(event_id % 100 AS DOUBLE) AS reservoirs,
    CAST(event_id % 50 + 40 AS DOUBLE) AS oil_temperature,
    CAST(value AS DOUBLE) AS motor_current,
    CAST(CASE WHEN event_type IN ('view','click') THEN 1 ELSE 0 END AS SMALLINT) AS comp,
    CAST(CASE WHEN event_type IN ('purchase','click') THEN 1 ELSE 0 END AS SMALLINT) AS dv_electric,
    CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS SMALLINT) AS towers,
    CAST(event_id % 2 AS SMALLINT) AS mpg,
    CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS SMALLINT) AS lps,
    CAST(CASE WHEN value >= 10 THEN 1 ELSE 0 END AS SMALLINT) AS pressure_switch,
    CAST(1 - event_id % 2 AS SMALLINT) AS oil_level,
    CAST(user_id % 2 AS DOUBLE) AS caudal_impulse
  FROM events)"""


REPORT_SCHEMA = StructType([
    StructField("report_id", IntegerType(), False),
    StructField("starts_at", TimestampNTZType(), False),
    StructField("ends_at", TimestampNTZType(), False),
    StructField("report_type", StringType(), False),
])

# Four maintenance intervals inside the events period (lengths mirror the
# reference's seed: ~1 day, 6.5 h, 2 days 4.5 h, 4.5 h).
DEMO_REPORT_ROWS = [
    (1, dt.datetime(2024, 1, 9, 0, 0), dt.datetime(2024, 1, 9, 23, 59), "Reported air leak"),
    (2, dt.datetime(2024, 1, 14, 23, 30), dt.datetime(2024, 1, 15, 6, 0), "Reported air leak"),
    (3, dt.datetime(2024, 1, 20, 10, 0), dt.datetime(2024, 1, 22, 14, 30), "Reported air leak"),
    (4, dt.datetime(2024, 1, 27, 14, 30), dt.datetime(2024, 1, 27, 19, 0), "Reported air leak"),
]


def reports(spark: SparkSession, rows=None) -> DataFrame:
    """Report interval table ``[starts_at, ends_at)``; rows violating ends > starts are rejected."""
    rows = DEMO_REPORT_ROWS if rows is None else rows
    bad = [r for r in rows if not r[2] > r[1]]
    if bad:
        raise ValueError(f"report interval must satisfy ends_at > starts_at: {bad}")
    return local_frame(spark, rows, REPORT_SCHEMA)


REPORTS_SQL = """reports AS (
  SELECT * FROM (VALUES
    (1, TIMESTAMP '2024-01-09 00:00:00', TIMESTAMP '2024-01-09 23:59:00', 'Reported air leak'),
    (2, TIMESTAMP '2024-01-14 23:30:00', TIMESTAMP '2024-01-15 06:00:00', 'Reported air leak'),
    (3, TIMESTAMP '2024-01-20 10:00:00', TIMESTAMP '2024-01-22 14:30:00', 'Reported air leak'),
    (4, TIMESTAMP '2024-01-27 14:30:00', TIMESTAMP '2024-01-27 19:00:00', 'Reported air leak')
  ) AS t(report_id, starts_at, ends_at, report_type))"""


def logged_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports derived from the data: every error event opens one, for half an hour up to about seventeen months."""
    ensure_utc(spark)
    eid = F.col("event_id")
    hours = (eid % 997) * (eid % 13)
    start = F.col("ts").cast("timestamp_ntz")
    return (load_table(spark, sf_dir, "events").filter("event_type = 'error'")
            .select(eid.alias("report_id"), start.alias("starts_at"),
                    (start + F.make_dt_interval(hours=hours, mins=F.lit(30))).alias("ends_at"), F.lit("Logged fault").alias("report_type")))


LOGGED_SQL = """logged AS (
  SELECT event_id AS report_id, CAST(ts AS TIMESTAMP) AS starts_at,
    CAST(ts AS TIMESTAMP) + to_hours(CAST((event_id % 997) * (event_id % 13) AS BIGINT)) + INTERVAL 30 MINUTE AS ends_at,
    'Logged fault' AS report_type
  FROM events WHERE event_type = 'error')"""
