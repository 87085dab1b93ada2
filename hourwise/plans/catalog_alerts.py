"""Registered alert queries.

Ticks are derived from the data: one tick per observed hour per asset, value =
low-pressure loaded readings in that hour, condition ``value > 0``, grace 3 h;
the alert of asset 7 is inactive (produces no rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourwise.functions.columns import ntz_lit
from hourwise.operators import alerts as X
from hourwise.plans import oracle as O
from hourwise.plans.catalog import ASSET, _sql, hourly, investigation, query
from hourwise.sources.readings import READINGS_SQL, REPORTS_SQL

GRACE_S = 3 * 3600
INACTIVE = 7
CUT = dt.datetime(2024, 1, 20)
NOW = dt.datetime(2024, 1, 31)


def ticks(spark, d, before=None):
    h = hourly(spark, d, ASSET)
    if before is not None:
        h = h.filter(F.col("hour_ts") < ntz_lit(before))
    return h.select(F.concat(F.lit("asset-"), F.col("asset_id").cast("string")).alias("alert"),
                    F.col("hour_ts").alias("tick"), F.col("low_pressure_loaded_readings").cast("double").alias("value"))


def definitions(tk):
    return tk.select("alert").distinct().withColumn("active", F.col("alert") != F.lit(f"asset-{INACTIVE}"))


def state_log(spark, d, before=None):
    tk = ticks(spark, d, before)
    return X.alert_states(tk, GRACE_S, ">", 0.0, active=definitions(tk))


def _ticks_sql(before=None):
    cond = f" AND hour_ts < TIMESTAMP '{before:%Y-%m-%d %H:%M:%S}'" if before else ""
    return f"""ticks AS (SELECT 'asset-' || CAST(asset_id AS VARCHAR) AS alert, hour_ts AS tick,
    CAST(low_pressure_loaded_readings AS DOUBLE) AS value FROM hourly WHERE asset_id <> {INACTIVE}{cond}),
t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY alert ORDER BY tick) AS rn FROM ticks),
r AS (
  SELECT alert, rn, tick, value, CASE WHEN value > 0 THEN 'Success' ELSE 'Not triggered' END AS state,
    CASE WHEN value > 0 THEN tick END AS last_success FROM t WHERE rn = 1
  UNION ALL
  SELECT t.alert, t.rn, t.tick, t.value,
    CASE WHEN r.last_success IS NOT NULL AND t.tick - r.last_success < INTERVAL {GRACE_S} SECOND THEN 'On Grace'
         WHEN t.value > 0 THEN 'Success' ELSE 'Not triggered' END,
    CASE WHEN NOT (r.last_success IS NOT NULL AND t.tick - r.last_success < INTERVAL {GRACE_S} SECOND) AND t.value > 0
         THEN t.tick ELSE r.last_success END
  FROM r JOIN t ON t.alert = r.alert AND t.rn = r.rn + 1)"""


def _rsql(final, doubles=(), before=None):
    body = "WITH RECURSIVE " + ",\n".join([READINGS_SQL, REPORTS_SQL, O.hourly_cte(ASSET), _ticks_sql(before)])
    return O.rounded(body + "\n" + final, list(doubles))


@query("alert_state_log", _rsql("SELECT alert, tick, value, state FROM r", ["value"]))
def q_alert_state_log(spark, d):
    """Grace-suppressed alert execution log (inactive alerts excluded)."""
    return state_log(spark, d)


@query("alert_repeat_elapsed", _rsql(f"""
SELECT alert, tick, previous_success,
  CAST(epoch_us(tick) - epoch_us(previous_success) AS DOUBLE) / 1000000 AS elapsed_seconds,
  CAST(epoch_us(tick) - epoch_us(previous_success) AS DOUBLE) / 1000000 >= {GRACE_S} AS respects_grace
FROM (SELECT alert, tick, LAG(tick) OVER (PARTITION BY alert ORDER BY tick) AS previous_success
      FROM r WHERE state = 'Success') s
WHERE previous_success IS NOT NULL""", ["elapsed_seconds"]))
def q_alert_repeat_elapsed(spark, d):
    """Elapsed time between successive notifications (>= grace)."""
    return X.repeat_elapsed(state_log(spark, d), grace_seconds=GRACE_S)


@query("alert_log_latest_n", _rsql("""
SELECT alert, tick, value, state FROM r
QUALIFY ROW_NUMBER() OVER (PARTITION BY alert ORDER BY tick DESC) <= 30""", ["value"]))
def q_alert_log_latest_n(spark, d):
    """Newest 30 log rows per alert, ascending."""
    return X.latest_n(state_log(spark, d), 30)


@query("alert_log_prune", _rsql(f"""
SELECT alert, tick, value, state FROM r
WHERE tick >= TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' - INTERVAL 7 DAY""", ["value"]))
def q_alert_log_prune(spark, d):
    """Log retention (7 days before the evaluation time)."""
    return X.prune_retention(state_log(spark, d), 7, NOW)


def _log_id(alert="alert", tick="tick"):
    """Text that sorts by tick and asset, for any number of assets."""
    return F.concat(F.date_format(tick, "yyyyMMddHHmmssSSSSSS"), F.lit("-"), F.lpad(F.regexp_extract(F.col(alert), "([0-9]+)$", 1), 12, "0"))


def _incremental_sql():
    base = "WITH RECURSIVE " + ",\n".join([READINGS_SQL, REPORTS_SQL, O.hourly_cte(ASSET), _ticks_sql()])
    prior = _ticks_sql(CUT).replace("ticks AS", "p_ticks AS", 1).replace("FROM ticks", "FROM p_ticks") \
        .replace("t AS (", "p_t AS (", 1).replace("r AS (", "p_r AS (", 1).replace("FROM r JOIN t ON t.alert = r.alert AND t.rn = r.rn + 1",
                                                                                    "FROM p_r r JOIN p_t t ON t.alert = r.alert AND t.rn = r.rn + 1") \
        .replace("FROM t WHERE rn = 1", "FROM p_t WHERE rn = 1")
    idx = "strftime(tick, '%Y%m%d%H%M%S%f') || '-' || lpad(regexp_extract(alert, '([0-9]+)$', 1), 12, '0')"
    final = f"""
SELECT {idx} AS log_id, alert, tick, value, state FROM r
WHERE {idx} > (SELECT MAX({idx}) FROM p_r)"""
    return O.rounded(base + ",\n" + prior + "\n" + final, ["value"])


@query("incremental_log", _incremental_sql())
def q_incremental_log(spark, d):
    """Log rows above the previous poll's high-water mark (previous poll = data before the cut)."""
    prior = state_log(spark, d, CUT).withColumn("log_id", _log_id())
    log = state_log(spark, d).withColumn("log_id", _log_id()).select("log_id", "alert", "tick", "value", "state")
    return X.incremental(log, prior)


@query("alert_condition", _sql(O.chain(ASSET), """
SELECT 'asset-' || CAST(asset_id AS VARCHAR) AS alert,
  COUNT(*) FILTER (WHERE candidate_status = 'REVIEW_PRESSURE') AS value,
  COUNT(*) FILTER (WHERE candidate_status = 'REVIEW_PRESSURE') > 0 AS triggered
FROM investigation GROUP BY asset_id"""))
def q_alert_condition(spark, d):
    """Per-asset scalar condition (candidate hours) evaluated with the operator validator ``> 0``."""
    inv = investigation(spark, d, ASSET)
    vals = inv.groupBy(F.concat(F.lit("asset-"), F.col("asset_id").cast("string")).alias("alert")).agg(
        F.count_if(F.col("candidate_status") == "REVIEW_PRESSURE").alias("value"))
    return X.alert_condition(vals, ">", 0)


@query("historical_alert_count", _sql(O.chain(), """
SELECT COUNT(*) AS value, COUNT(*) > 0 AS triggered FROM investigation
WHERE rule_eligible AND evaluation_status = 'Evaluated: breach'
  AND hour_ts >= TIMESTAMP '2024-01-01 00:00:00' AND hour_ts < TIMESTAMP '2024-01-31 00:00:00'"""))
def q_historical_alert_count(spark, d):
    """Fixed-range eligible-breach count as an alert condition."""
    inv = investigation(spark, d)
    sel = inv.filter(F.col("rule_eligible") & (F.col("evaluation_status") == "Evaluated: breach")
                     & (F.col("hour_ts") >= ntz_lit(dt.datetime(2024, 1, 1)))
                     & (F.col("hour_ts") < ntz_lit(dt.datetime(2024, 1, 31))))
    return X.alert_condition(sel.agg(F.count(F.lit(1)).alias("value")), ">", 0)


@query("stream_alert_state_log", _rsql("SELECT alert, tick, value, state FROM r", ["value"]))
def q_stream_alert_state_log(spark, d):
    """X2 (stream form): ticks as a file stream, per-alert last-Success state in the state store."""
    import posixpath
    from hourwise.plans.catalog_sources import scratch
    from hourwise.streaming.alerts import alert_state_stream
    root = scratch(spark, "alert-stream")
    tk = ticks(spark, d)
    src = posixpath.join(root, "ticks")
    tk.write.parquet(src)
    stream = spark.readStream.schema(tk.schema).parquet(src)
    out = alert_state_stream(stream, GRACE_S, ">", 0.0, active=definitions(tk))
    sink = posixpath.join(root, "log")
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", posixpath.join(root, "_checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
