"""Registered queries of the incremental marts, as-of joins, sketches, the dyadic interval index, bucketed upserts and the
streams with sessions and timers."""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import functions as F

from hourwise.functions.columns import date_lit
from hourwise.operators import intervals as V, marts, rule, sketches as K
from hourwise.operators.alerts import SUCCESS
from hourwise.operators.asof import asof_join
from hourwise.plans import oracle as O
from hourwise.plans.catalog import (CAND_DOUBLES, DAILY_DOUBLES, INC_DOUBLES, SPEC, _sql, candidates, hourly, query, readings,
                                    reports)
from hourwise.plans.catalog_alerts import GRACE_S, _rsql, definitions, state_log, ticks
from hourwise.plans.catalog_sources import _LINES_SQL, scratch, write_line_files
from hourwise.plans.catalog_streaming import _FINAL, events_source
from hourwise.plans.incremental import Marts, changed_days
from hourwise.plans.refresh import ObservedCounts
from hourwise.plans.views import register_views
from hourwise.session import materialize
from hourwise.sources.buckets import BucketTable
from hourwise.sources.ranges import range_digests
from hourwise.sources.readings import LOGGED_SQL, READINGS_SQL, load_table, logged_reports
from hourwise.spec import REVIEW_PRESSURE
from hourwise.streaming.dedup import balance, deduplicated, split_late
from hourwise.streaming.hourly import stream_scored_hours
from hourwise.streaming.incidents import stream_incidents

# ---------------------------------------------------------------- incremental refresh

#: Days of which rows come later, and the share of their rows that does (one in LATER).
LATE_DAYS, LATER = (dt.date(2024, 1, 12), dt.date(2024, 1, 20)), 3


def _later():
    return F.to_date("observed_at").isin([date_lit(x) for x in LATE_DAYS]) & (F.col("source_row") % LATER == 0)


def refreshed(spark, d, keys=()):
    """A mart folder built without the late rows, and a function that refreshes it once they are there."""
    m, rd, rep = Marts(spark, scratch(spark, "marts"), SPEC, list(keys)), readings(spark, d), reports(spark)
    m.build(rd.filter(~_later()), rep)
    return m, lambda: m.refresh(rd, rep, changed_days(rd.filter(_later())))


def _files(m, name):
    return m.read(name).select("day", F.col("_metadata.file_path").alias("file")).distinct()


@query("incremental_scored_hours", _sql(O.chain(), "SELECT * FROM investigation", CAND_DOUBLES))
def q_incremental_scored_hours(spark, d):
    """Investigation hours after a refresh of the touched days only."""
    m, refresh = refreshed(spark, d)
    refresh()
    return m.read("scored").drop("day")


@query("incremental_daily_by_asset", _sql(O.chain(["asset_id"], upto="daily"), "SELECT * FROM daily", DAILY_DOUBLES))
def q_incremental_daily_by_asset(spark, d):
    """A2 per asset, after a refresh of the touched days only."""
    m, refresh = refreshed(spark, d, ["asset_id"])
    refresh()
    return m.read("daily").drop("day")


@query("incremental_incidents", _sql(O.chain(upto="incidents"), "SELECT * FROM incidents", INC_DOUBLES))
def q_incremental_incidents(spark, d):
    """Incidents after a refresh of the touched days only."""
    m, refresh = refreshed(spark, d)
    refresh()
    return m.read("incidents").drop("day")


def _days_sql():
    late = f"changed AS (SELECT DISTINCT CAST(observed_at AS DATE) AS day FROM readings WHERE source_row % {LATER} = 0 AND " \
           f"CAST(observed_at AS DATE) IN ({', '.join(f'DATE {str(x)!r}' for x in LATE_DAYS)}))"
    return _sql(O.chain(upto="daily") + [late], f"""
SELECT 'hourly' AS mart, reading_date AS day, reading_date IN (SELECT day FROM changed) AS rewritten FROM daily
UNION ALL SELECT 'daily', reading_date, reading_date IN (SELECT day FROM changed) FROM daily
UNION ALL SELECT 'scored', reading_date, EXISTS (SELECT 1 FROM changed c WHERE reading_date - c.day BETWEEN 0 AND {SPEC.lookback_days}) FROM daily""")


@query("incremental_days", _days_sql())
def q_incremental_days(spark, d):
    """The days of each mart whose files a refresh replaced (all other files stay)."""
    m, refresh = refreshed(spark, d)
    names = ("hourly", "daily", "scored")
    before = {n: materialize(_files(m, n), "mart_files") for n in names}
    refresh()
    out = None
    for n in names:
        kept = _files(m, n).join(before[n].withColumn("kept", F.lit(True)), ["day", "file"], "left")
        days = kept.groupBy("day").agg((~F.bool_and(F.coalesce("kept", F.lit(False)))).alias("rewritten"))
        days = days.select(F.lit(n).alias("mart"), "day", "rewritten")
        out = days if out is None else out.unionByName(days)
    return out


@query("observed_counts", _sql([READINGS_SQL], """
SELECT COUNT(*) AS raw_rows, COUNT(*) AS hourly_rows, COUNT(*) AS daily_rows, MIN(observed_at) AS first_reading,
  MAX(observed_at) AS last_reading FROM readings"""))
def q_observed_counts(spark, d):
    """Totals observed in the jobs that scan the readings and write the marts."""
    seen, rd = ObservedCounts(), readings(spark, d)
    h = materialize(seen.watched_mart(marts.hourly_mart(seen.watched(rd), SPEC)), "mart_hourly")
    obs, total = seen.daily_export()
    materialize(marts.daily_mart(h).observe(obs, *total), "mart_daily")
    row = seen.counts(rd, h, marts.daily_mart(h)) | {k: v for k, v in seen.bounds().items() if k != "raw_rows"}
    names = ["raw_rows", "hourly_rows", "daily_rows", "first_reading", "last_reading"]
    return spark.createDataFrame([tuple(row[n] for n in names)], "raw_rows long, hourly_rows long, daily_rows long, "
                                 "first_reading timestamp_ntz, last_reading timestamp_ntz")


# ---------------------------------------------------------------- as-of joins

DAY_S, HALF_DAY_S = 86400, 43200


@query("asof_last_report", _sql([READINGS_SQL, LOGGED_SQL], f"""
SELECT source_row, observed_at, CASE WHEN age <= {DAY_S} THEN report_id END AS report_id, CASE WHEN age <= {DAY_S} THEN starts_at END AS report_started_at,
  CASE WHEN age <= {DAY_S} THEN age END AS seconds_since_report
FROM (SELECT l.source_row, l.observed_at, r.report_id, r.starts_at, (epoch_us(l.observed_at) - epoch_us(r.starts_at)) / 1e6 AS age
      FROM readings l ASOF LEFT JOIN (SELECT starts_at, MAX(report_id) AS report_id FROM logged GROUP BY starts_at) r
        ON l.observed_at >= r.starts_at) m""", ["seconds_since_report"]))
def q_asof_last_report(spark, d):
    """Every reading with the last report that began at or before it, at most a day ago."""
    return asof_join(readings(spark, d).select("source_row", "observed_at"), logged_reports(spark, d), "observed_at", "starts_at",
                     values={"report_id": "report_id", "starts_at": "report_started_at"}, tolerance_seconds=DAY_S, age="seconds_since_report")


@query("asof_last_success", _rsql(f"""
SELECT source_row, m.alert, observed_at, CASE WHEN age <= {HALF_DAY_S} THEN tick END AS last_success
FROM (SELECT l.source_row, l.alert, l.observed_at, s.tick, (epoch_us(l.observed_at) - epoch_us(s.tick)) / 1e6 AS age
      FROM (SELECT *, 'asset-' || CAST(asset_id AS VARCHAR) AS alert FROM readings) l
      ASOF LEFT JOIN (SELECT alert, tick FROM r WHERE state = 'Success') s ON l.alert = s.alert AND l.observed_at >= s.tick) m"""))
def q_asof_last_success(spark, d):
    """Every reading with the last notification of its asset's alert, at most twelve hours ago."""
    rd = readings(spark, d).select("source_row", F.concat(F.lit("asset-"), F.col("asset_id").cast("string")).alias("alert"), "observed_at")
    return asof_join(rd, state_log(spark, d).filter(F.col("state") == SUCCESS), "observed_at", "tick", ["alert"],
                     {"tick": "last_success"}, HALF_DAY_S)


# ---------------------------------------------------------------- sketches

def _sketch_sql(group, name):
    flags = ", ".join(f"TRUE AS {m}_p{p}_ok" for m in K.MEASURES for p in ("50", "95"))
    return _sql([READINGS_SQL], f"""
SELECT {group} AS {name}, COUNT(*) AS readings, COUNT(DISTINCT observed_at) AS distinct_times, TRUE AS distinct_ok, {flags}
FROM readings GROUP BY ALL""")


def _sketch_result(exact, name):
    return exact.select(name, "readings", "distinct_times", "distinct_ok", *[c for c in exact.columns if c.endswith("_ok") and c != "distinct_ok"])


@query("sketch_days", _sketch_sql("CAST(observed_at AS DATE)", "reading_date"))
def q_sketch_days(spark, d):
    """Hourly sketches merged to days; exact counts, and whether each estimate is within its bound."""
    h = materialize(K.hourly_sketches(readings(spark, d)), "sketches")
    est = materialize(K.estimates(K.merged(h, F.to_date("hour_ts").alias("reading_date")), ["reading_date"]), "estimates")
    return _sketch_result(K.against_exact(readings(spark, d), F.to_date("observed_at"), "reading_date", est), "reading_date")


@query("sketch_assets", _sketch_sql("asset_id", "asset_id"))
def q_sketch_assets(spark, d):
    """A5/A12 per asset: the hours of an asset merged over the whole period."""
    h = materialize(K.hourly_sketches(readings(spark, d), ["asset_id"]), "sketches")
    est = materialize(K.estimates(K.merged(h, "asset_id"), ["asset_id"]), "estimates")
    return _sketch_result(K.against_exact(readings(spark, d), F.col("asset_id"), "asset_id", est), "asset_id")


# ---------------------------------------------------------------- dyadic intervals

_HITS = "hits AS (SELECT hour_ts AS h FROM candidates WHERE candidate_status = 'REVIEW_PRESSURE')"
_IDS = ["report_id"]


def _count(cond, table="hits"):
    return f"(SELECT COUNT(*) FROM {table} WHERE {cond})"


@query("dyadic_overlap_flag", _sql(O.chain(upto="hourly") + [LOGGED_SQL], """
SELECT hour_ts, EXISTS (SELECT 1 FROM logged f WHERE f.starts_at < hour_ts + INTERVAL 1 HOUR AND f.ends_at > hour_ts) AS overlaps_reported_failure
FROM hourly"""))
def q_dyadic_overlap_flag(spark, d):
    """J1 over the interval index: hours that overlap any logged report."""
    return V.mark_overlap(hourly(spark, d).select("hour_ts"), logged_reports(spark, d))


@query("dyadic_report_review", _sql(O.chain(upto="candidates") + [LOGGED_SQL, _HITS], f"""
SELECT r.*, {_count("h + INTERVAL 1 HOUR <= r.starts_at AND h + INTERVAL 1 HOUR > r.starts_at - INTERVAL 24 HOUR")} AS candidate_hours_ending_in_prior_24h,
  {_count("h < r.ends_at AND h + INTERVAL 1 HOUR > r.starts_at")} AS candidate_hours_overlapping_report FROM logged r"""))
def q_dyadic_report_review(spark, d):
    """J2 over the interval index, for reports of up to years."""
    return V.review_counts(logged_reports(spark, d), candidates(spark, d), _IDS, REVIEW_PRESSURE)


@query("dyadic_retrospective_review", _sql(O.chain(upto="candidates") + [LOGGED_SQL, _HITS], f"""
SELECT r.*, {_count("h >= r.starts_at - INTERVAL 24 HOUR AND h < r.starts_at")} AS candidate_hours_in_prior_24h,
  {_count("h >= r.starts_at AND h < r.ends_at")} AS candidate_hours_during_report FROM logged r"""))
def q_dyadic_retrospective_review(spark, d):
    """J3 over the interval index, for reports of up to years."""
    return V.retrospective_counts(logged_reports(spark, d), candidates(spark, d), _IDS, REVIEW_PRESSURE)


@query("dyadic_report_context", _sql(O.chain(upto="candidates") + [LOGGED_SQL, _HITS, """w AS (
  SELECT *, date_trunc('hour', starts_at) - INTERVAL 21 DAY AS lo,
    date_trunc('hour', ends_at + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND) + INTERVAL 21 DAY AS hi FROM logged)"""], f"""
SELECT report_id, starts_at, ends_at, report_type, date_diff('hour', lo, hi) AS expected_hours,
  {_count("c.hour_ts >= lo AND c.hour_ts < hi", "candidates c")} AS observed_hours, {_count("h >= lo AND h < hi")} AS candidate_hours FROM w"""))
def q_dyadic_report_context(spark, d):
    """T6 over the interval index: three weeks around every logged report."""
    return V.context_counts(logged_reports(spark, d), candidates(spark, d), _IDS, 21, REVIEW_PRESSURE)


# ---------------------------------------------------------------- bucketed upsert

BUCKETS = 64


def upserted(spark, d):
    """Customers in buckets; those with an order of the last day on which there are orders get their order total."""
    orders, table = load_table(spark, d, "orders"), BucketTable(spark, scratch(spark, "buckets"))
    base = load_table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    table.create(base, ["c_custkey"], BUCKETS)
    last = orders.select(F.max("o_orderdate")).scalar()
    spent = (orders.filter(F.col("o_orderdate") == last).groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.lit("buyer").alias("c_name"), F.sum(F.col("o_totalprice").cast("double")).alias("c_acctbal")))
    return table, spent


@query("upsert_buckets", """
WITH spent AS (SELECT o_custkey, CAST(SUM(o_totalprice) AS DOUBLE) AS total FROM orders
               WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders) GROUP BY o_custkey)
SELECT coalesce(c_custkey, o_custkey) AS c_custkey, CASE WHEN o_custkey IS NULL THEN c_name ELSE 'buyer' END AS c_name,
  ROUND(CASE WHEN o_custkey IS NULL THEN CAST(c_acctbal AS DOUBLE) ELSE total END, 6) AS c_acctbal
FROM customer FULL JOIN spent ON c_custkey = o_custkey""")
def q_upsert_buckets(spark, d):
    """Insert-or-replace by key, rewriting only the key buckets of the updates."""
    table, updates = upserted(spark, d)
    table.upsert(updates)
    return table.read()


@query("upsert_untouched_files", "SELECT TRUE AS only_touched_rewritten, TRUE AS all_touched_rewritten")
def q_upsert_untouched_files(spark, d):
    """Whether the files that an upsert replaced are those of the buckets of its keys, all and only."""
    table, updates = upserted(spark, d)
    before = materialize(table.files(), "bucket_files")
    touched = table.upsert(updates)
    after = table.files().withColumn("new", F.lit(True))
    both = before.join(after, ["bucket", "file"], "full").withColumn("touched", F.col("bucket").isin(touched))
    gone = F.col("new").isNull()
    return both.agg(F.coalesce(F.bool_and(F.when(gone, F.col("touched"))), F.lit(True)).alias("only_touched_rewritten"),
                    F.coalesce(F.bool_and(F.when(F.col("touched") & F.col("new").isNotNull(), F.lit(True))), F.lit(True)).alias("all_touched_rewritten"))


# ---------------------------------------------------------------- streams with sessions and timers

@query("stream_session_incidents", _sql(O.chain(["asset_id"], upto="incidents"), f"""
SELECT * FROM incidents WHERE ends_at <= (SELECT MAX(hour_ts) - INTERVAL 1 HOUR FROM hourly WHERE {_FINAL})""", INC_DOUBLES))
def q_stream_session_incidents(spark, d):
    """W3/C3 on a stream: hours are scored as they become final, and runs of candidate hours close as sessions."""
    root, (source, glob) = scratch(spark, "stream-incidents"), events_source(spark, d)
    q = stream_scored_hours(spark, source, root, posixpath.join(root, "_checkpoint"), SPEC, glob=glob, keys=["asset_id"])
    q.awaitTermination()
    scored, sink = posixpath.join(root, "scored"), posixpath.join(root, "incidents")
    schema = rule.candidate_hours(hourly(spark, d, ["asset_id"]), SPEC, ["asset_id"]).schema
    q = stream_incidents(spark, scored, schema, sink, posixpath.join(root, "_sessions"), SPEC, keys=["asset_id"], reports=reports(spark))
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("stream_alert_timers", _rsql("""
SELECT alert, tick, value, state FROM r WHERE date_trunc('hour', tick) + INTERVAL 1 HOUR <= (SELECT MAX(tick) FROM ticks) - INTERVAL 1 HOUR""",
                                    ["value"]))
def q_stream_alert_timers(spark, d):
    """X2 (stream form) with event-time timers: every tick whose slot the watermark has passed."""
    from hourwise.streaming.timers import ROCKSDB, alert_states_with_timers
    root, tk = scratch(spark, "alert-timers"), ticks(spark, d)
    src, sink = posixpath.join(root, "ticks"), posixpath.join(root, "log")
    tk.write.parquet(src)
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        out = alert_states_with_timers(spark.readStream.schema(tk.schema).parquet(src), GRACE_S, ">", 0.0, active=definitions(tk))
        q = (out.writeStream.format("parquet").option("path", sink).outputMode("append")
             .option("checkpointLocation", posixpath.join(root, "_checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(sink)


# ---------------------------------------------------------------- stream deduplication with a late table

DELAY_S = 86400
FIRST, AGAIN, OLD = dt.datetime(2024, 1, 21), 3, 50
_FIRST = f"TIMESTAMP '{FIRST:%Y-%m-%d}'"
_BEFORE, _RECENT = f"observed_at < {_FIRST}", f"observed_at >= {_FIRST} - INTERVAL 6 HOUR"


def _deliveries(rd):
    """Readings as they arrive: those of the first weeks, then the rest with a part of the last hours sent again and some old ones
    sent for the first time, then everything of the last hours once more."""
    old, before = f"source_row % {OLD} = 0 AND observed_at < {_FIRST} - INTERVAL 3 DAY", _BEFORE
    return [rd.filter(f"{before} AND NOT ({old})"),
            rd.filter(f"NOT ({before})").unionByName(rd.filter(f"{before} AND {_RECENT} AND source_row % {AGAIN} = 0")).unionByName(rd.filter(old)),
            rd.filter(F.col("observed_at") >= rd.select(F.max("observed_at")).scalar() - F.expr("INTERVAL 6 HOURS"))]


@query("stream_dedup_balance", _sql([READINGS_SQL], f"""
SELECT n - old AS kept, again + last_hours AS duplicate, old AS late
FROM (SELECT COUNT(*) AS n, COUNT_IF(source_row % {OLD} = 0 AND observed_at < {_FIRST} - INTERVAL 3 DAY) AS old,
        COUNT_IF({_BEFORE} AND {_RECENT} AND source_row % {AGAIN} = 0) AS again,
        COUNT_IF(observed_at >= (SELECT MAX(observed_at) FROM readings) - INTERVAL 6 HOUR) AS last_hours FROM readings) c"""))
def q_stream_dedup_balance(spark, d):
    """Readings that arrive twice or late: kept + duplicate + late is all that came in."""
    root, rd = scratch(spark, "stream-dedup"), readings(spark, d).select("source_row", "observed_at", "asset_id", "motor_current")
    inbox, kept = posixpath.join(root, "inbox"), posixpath.join(root, "kept")
    for delivery in _deliveries(rd):
        delivery.write.mode("append").parquet(inbox)
        q = split_late(spark.readStream.schema(rd.schema).parquet(inbox), "observed_at", root, posixpath.join(root, "_split"), DELAY_S)
        q.awaitTermination()
        q = deduplicated(spark, root, rd.schema, ["source_row"], "observed_at", kept, posixpath.join(root, "_dedup"), DELAY_S)
        q.awaitTermination()
    return balance(spark, root, kept, rd.schema)


# ---------------------------------------------------------------- logical views

@query("sql_views", _sql(O.chain(upto="all"), """
SELECT i.hour_ts, i.candidate_status, d.readings AS day_readings, n.incident_id
FROM investigation i JOIN daily d ON d.reading_date = CAST(i.hour_ts AS DATE)
LEFT JOIN incidents n ON i.hour_ts >= n.starts_at AND i.hour_ts < n.ends_at"""))
def q_sql_views(spark, d):
    """Spark SQL over the logical views: hours with their day's readings and the incident they belong to."""
    register_views(spark, readings(spark, d), reports(spark), SPEC)
    return spark.sql("""
        SELECT h.hour_ts, h.candidate_status, m.readings AS day_readings, i.incident_id
        FROM mart_hourly_investigation h JOIN mart_daily m ON m.reading_date = to_date(h.hour_ts)
        LEFT JOIN (SELECT incident_id, explode(sequence(starts_at, ends_at - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_ts FROM mart_incidents) i
          ON i.hour_ts = h.hour_ts""")


# ---------------------------------------------------------------- digests by byte ranges

RANGE = 10_000


@query("range_digests", _sql([READINGS_SQL, _LINES_SQL], f"""
SELECT file, bytes, 'tree-' || sha256(string_agg(sha256(substr(body, k * {RANGE} + 1, {RANGE})), '' ORDER BY k)) AS sha256
FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(bytes / {RANGE}) AS BIGINT)))) AS k
      FROM (SELECT file, string_agg(line || chr(10), '' ORDER BY source_row) AS body, CAST(SUM(strlen(line) + 1) AS BIGINT) AS bytes
            FROM lines GROUP BY file) f) r GROUP BY file, bytes"""))
def q_range_digests(spark, d):
    """Digests of generated files of readings by byte ranges, one rule for files of any size."""
    x = range_digests(spark, write_line_files(spark, d), "part-*", RANGE)
    return x.select(F.regexp_extract("path", r"file=(\d+)", 1).cast("int").alias("file"), "bytes", "sha256")
