"""Registered source/sink queries: ingest (S1-S6), snapshots (S7-S18, S21), upsert.

File-producing steps write below the shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local temp folder.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid

from pyspark.sql import functions as F

from hourwise.operators import marts
from hourwise.plans import oracle as O
from hourwise.plans.catalog import CAND_DOUBLES, SPEC, _sql, hourly, incidents, investigation, query, readings, reports
from hourwise.operators import audit as A
from hourwise.plans.catalog_more import RECON_SQL
from hourwise.operators.review import REPORT_KEY, incident_evidence, report_context, report_slots
from hourwise.functions.columns import trunc_hour
from hourwise.session import checkpoint_dir
from hourwise.sources import csv_ingest as I, snapshot as S
from hourwise.sources.readings import READINGS_SQL, load_table
from hourwise.spec import READING_SCHEMA

# Reference CSV header spellings (fixed values of the source contract, physical order free).
CSV_HEADER = {"timestamp": "timestamp", "tp2": "TP2", "tp3": "TP3", "h1": "H1", "dv_pressure": "DV_pressure",
              "reservoirs": "Reservoirs", "oil_temperature": "Oil_temperature", "motor_current": "Motor_current",
              "comp": "COMP", "dv_electric": "DV_eletric", "towers": "Towers", "mpg": "MPG", "lps": "LPS",
              "pressure_switch": "Pressure_switch", "oil_level": "Oil_level", "caudal_impulse": "Caudal_impulses"}


#: Load and export times of the registered loads.
LOADED_AT, EXPORTED_AT = dt.datetime(2024, 2, 1, 6, 30), "2024-02-01T07:00:00"


def scratch(spark, kind: str) -> str:
    return posixpath.join(checkpoint_dir(spark), "hourwise", kind, uuid.uuid4().hex)


def _fmt_ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def dirty_strings(spark, d):
    """Readings rendered as CSV strings with deterministic defects (by event id)."""
    rd = readings(spark, d)
    eid = F.col("source_row") - 1
    cols = {
        "timestamp": F.when(eid % 83 == 0, F.concat(_fmt_ts("observed_at"), F.lit("+05:30")))
        .otherwise(_fmt_ts("observed_at")),
        "tp3": F.when(eid % 89 == 0, F.lit("inf")).otherwise(F.col("tp3").cast("string")),
        "h1": F.when(eid % 73 == 0, F.lit("1d")).otherwise(F.col("h1").cast("string")),
        "comp": F.when(eid % 97 == 0, F.lit("2.0")).otherwise(F.format_number(F.col("comp").cast("double"), 1)),
    }
    fields = []
    for f in READING_SCHEMA.fields:
        c = cols.get(f, F.col(f if f != "timestamp" else "observed_at").cast("string"))
        fields.append(c.alias(f))
    return rd.select("source_row", *fields)


#: Least files of a generated source, every other one with its columns reversed and all cells quoted; readings of a file of it at most.
DIRTY_FILES, FILE_ROWS = 4, 1_000_000


def write_dirty_csv(spark, d, file_rows: int = FILE_ROWS) -> str:
    """CSV files with the strings of ``dirty_strings`` and blank, all-empty and short lines (by event id)."""
    rows, path = dirty_strings(spark, d), scratch(spark, "dirty_csv")
    total = rows.count()
    eid = F.col("source_row") - 1
    plain = [F.coalesce(F.col(f), F.lit("")) for f in READING_SCHEMA.fields]
    quoted = [F.concat(F.lit('"'), c, F.lit('"')) for c in reversed(plain)]
    files = max(DIRTY_FILES, -(-total // file_rows))
    file = F.floor(eid * files / total).cast("long")
    cells = F.when(file % 2 == 0, F.array(*plain)).otherwise(F.array(*quoted))
    line = (F.when(eid % 79 == 0, F.lit("")).when(eid % 71 == 0, F.lit(",,,,"))
            .when(eid % 67 == 0, F.array_join(F.slice(cells, 1, 5), ",")).otherwise(F.array_join(cells, ",")))
    lines = rows.select(file.alias("file"), "source_row", line.alias("value"))
    names = [CSV_HEADER[f] for f in READING_SCHEMA.fields]
    heads = spark.range(files).select(
        F.col("id").alias("file"), F.lit(0).cast("long").alias("source_row"),
        F.when(F.col("id") % 2 == 0, ",".join(names)).otherwise(",".join(f'"{n}"' for n in reversed(names))).alias("value"))
    # rows are numbered in the order of the files' names
    (lines.unionByName(heads).withColumn("file", F.format_string("%012d", "file")).repartition("file").sortWithinPartitions("file", "source_row").drop("source_row")
     .write.partitionBy("file").text(path))
    return path


def _validate_sql():
    tsq = "CAST(event_id AS BIGINT) % 83 = 0"
    ts = (f"CASE WHEN {tsq} THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+05:30' "
          f"ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END")
    checks = [
        f"CASE WHEN t IS NULL THEN 'bad_timestamp' WHEN regexp_matches(t, '{I.ZONE_SUFFIX}') AND NOT regexp_matches(t, "
        f"'{I.ISO_NAIVE}') THEN 'timezone' WHEN NOT regexp_matches(t, '{I.ISO_NAIVE}') OR TRY_CAST(t AS TIMESTAMP) IS NULL "
        f"THEN 'bad_timestamp' END"]

    def num(c):
        return (f"CASE WHEN {c} IS NULL THEN 'missing_field:{c}' WHEN regexp_matches(lower({c}), '{I.NON_FINITE}') "
                f"THEN 'non_finite:{c}' WHEN NOT regexp_matches({c}, '{I.DECIMAL}') THEN 'unparseable:{c}' END")
    for a in READING_SCHEMA.analog:
        checks.append(num(a))
    for dg in READING_SCHEMA.digital:
        checks.append(f"COALESCE({num(dg)}, CASE WHEN TRY_CAST(trim({dg}) AS DOUBLE) NOT IN (0, 1) "
                      f"THEN 'not_0_1:{dg}' END)")
    imp = READING_SCHEMA.impulse
    checks.append(f"COALESCE({num(imp)}, CASE WHEN TRY_CAST(trim({imp}) AS DOUBLE) < 0 THEN 'invalid_impulse:{imp}' END)")
    strings = f"""s AS (
  SELECT source_row, event_id % 79 = 0 OR event_id % 71 = 0 AS blank, event_id % 67 = 0 AS short, {ts} AS t,
    CASE WHEN event_id % 89 = 0 THEN 'inf' ELSE CAST(tp3 AS VARCHAR) END AS tp3,
    CASE WHEN event_id % 73 = 0 THEN '1d' ELSE CAST(h1 AS VARCHAR) END AS h1,
    CASE WHEN event_id % 97 = 0 THEN '2.0' ELSE CAST(CAST(comp AS DOUBLE) AS VARCHAR) END AS comp,
    {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in READING_SCHEMA.fields
               if c not in ('timestamp', 'tp3', 'h1', 'comp'))}
  FROM (SELECT r.*, r.source_row - 1 AS event_id, e.ts FROM readings r JOIN events e ON e.event_id = r.source_row - 1) x)"""
    final = f"""
SELECT source_row, CASE WHEN v = '' THEN TRY_CAST(t AS TIMESTAMP) END AS observed_at, v AS violations
FROM (SELECT source_row, t, CASE WHEN blank THEN 'blank_row' WHEN short THEN 'short_row' ELSE concat_ws('|', {', '.join(checks)}) END AS v FROM s) q"""
    return O.with_(READINGS_SQL, strings) + final


@query("validate_rows", _validate_sql())
def q_validate_rows(spark, d):
    """Generated CSV files with quotes, two column orders and defects; violation codes per row."""
    res = I.scan_csv(spark, write_dirty_csv(spark, d))
    good = res.valid.select("source_row", "observed_at", F.lit("").alias("violations"))
    bad = res.quarantine.select("source_row", F.lit(None).cast("timestamp_ntz").alias("observed_at"),
                                F.array_join("violations", "|").alias("violations"))
    return good.unionByName(bad)


def write_readings_csv(spark, rd) -> str:
    """Render readings as header-per-part CSV files (source header spellings), key-ordered across files."""
    path = scratch(spark, "csv")
    cols = [(_fmt_ts("observed_at") if f == "timestamp" else F.col(f).cast("string")).alias(CSV_HEADER[f])
            for f in READING_SCHEMA.fields]
    # range-partitioned into one ordered part file per core: part file order = row order
    n = spark.sparkContext.defaultParallelism
    (rd.repartitionByRange(n, "source_row").sortWithinPartitions("source_row")
     .select(F.col("source_row").cast("string").alias(""), *cols)
     .write.option("header", True).csv(path))
    return path


@query("row_numbering", _sql([READINGS_SQL], "SELECT source_row, observed_at FROM readings"))
def q_row_numbering(spark, d):
    """CSV written by Spark (many part files), scanned as text; source_row recovered in file order."""
    res = I.scan_csv(spark, write_readings_csv(spark, readings(spark, d)))
    return res.valid.select("source_row", "observed_at")


@query("completeness_gate", _sql([READINGS_SQL], """
SELECT COUNT(*) AS row_count, CAST((SELECT COUNT(*) FROM events) AS BIGINT) AS expected_rows, FALSE AS allow_subset,
  COUNT(*) > 0 AND COUNT(*) = (SELECT COUNT(*) FROM events) AS passes FROM readings"""))
def q_completeness_gate(spark, d):
    """Exact expected count (recorded source size) unless a subset is allowed; zero rows fail."""
    expected = load_table(spark, d, "events").count()
    return I.completeness_gate(readings(spark, d), expected, allow_subset=False)


def write_line_files(spark, d, file_rows: int = FILE_ROWS):
    """Readings as one text line each, in files of ``file_rows`` rows at most (DIRTY_FILES files at least), in row order: content that
    SQL can digest too."""
    path, rd = scratch(spark, "lines"), readings(spark, d)
    total = rd.count()
    files = max(DIRTY_FILES, -(-total // file_rows))
    text = F.concat_ws(",", F.col("source_row").cast("string"), F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss"),
                       F.col("lps").cast("int").cast("string"))
    rows = rd.select(F.floor((F.col("source_row") - 1) * files / total).cast("int").alias("file"), "source_row", text.alias("value"))
    (rows.repartition("file").sortWithinPartitions("file", "source_row").drop("source_row").write.partitionBy("file").text(path))
    return path


_LINES_SQL = f"""lines AS (
  SELECT CAST(floor((source_row - 1) * files / total) AS INTEGER) AS file, source_row,
    source_row || ',' || strftime(observed_at, '%Y-%m-%d %H:%M:%S') || ',' || CAST(lps AS INTEGER) AS line
  FROM readings, (SELECT COUNT(*) AS total, GREATEST({DIRTY_FILES}, CAST(ceil(COUNT(*) / {FILE_ROWS}) AS BIGINT)) AS files FROM readings))"""


@query("file_digests", _sql([READINGS_SQL, _LINES_SQL], """
SELECT file, CAST(SUM(strlen(line) + 1) AS BIGINT) AS bytes,
  sha256(string_agg(line || chr(10), '' ORDER BY source_row)) AS sha256 FROM lines GROUP BY file"""))
def q_file_digests(spark, d):
    """Sha-256 and size of generated files of readings (computed on executors)."""
    return S.file_digests(spark, write_line_files(spark, d), "part-*").select(
        F.regexp_extract("path", r"file=(\d+)", 1).cast("int").alias("file"), "bytes", "sha256")


@query("tree_digests", _sql([READINGS_SQL, _LINES_SQL], f"""
SELECT file, 'tree-' || sha256(string_agg(h, '' ORDER BY chunk)) AS sha256 FROM (
  SELECT file, chunk, sha256(string_agg(sha256(line), '' ORDER BY source_row)) AS h FROM (
    SELECT *, (row_number() OVER (PARTITION BY file ORDER BY source_row) - 1) // {S.CHUNK_LINES} AS chunk FROM lines) c
  GROUP BY file, chunk) t GROUP BY file"""))
def q_tree_digests(spark, d):
    """Digests of files by chunks of lines, as files over one row's limit get them."""
    return S.file_digests(spark, write_line_files(spark, d), "part-*", whole_bytes=0).select(
        F.regexp_extract("path", r"file=(\d+)", 1).cast("int").alias("file"), "sha256")


_EXPORT_SCHEMA = ("reading_date date, readings bigint, loaded_readings bigint, unloaded_readings bigint, "
                  "idle_readings bigint, low_pressure_loaded_readings bigint, low_pressure_loaded_fraction double, "
                  "avg_panel_pressure_bar double, avg_pressure_gap_bar double, avg_oil_temperature_c double")


@query("export_ordered", _sql(O.chain(upto="daily"), "SELECT * FROM daily",
                              ["low_pressure_loaded_fraction", "avg_panel_pressure_bar", "avg_pressure_gap_bar",
                               "avg_oil_temperature_c"]))
def q_export_ordered(spark, d):
    """Daily mart exported ordered by date as CSV and read back with an explicit schema."""
    path = scratch(spark, "export")
    S.export_ordered(marts.daily_mart(hourly(spark, d)), ["reading_date"], path)
    return spark.read.option("header", True).schema(_EXPORT_SCHEMA).csv(path)


def exported(spark, df, order):
    """A selection as ordered CSV, read back with the types it was written with."""
    folder = scratch(spark, "evidence")
    S.export_ordered(df, order, posixpath.join(folder, "rows"))
    return S.read_table(spark, folder, "rows", df.schema.simpleString()[7:-1])


_HOURS = "hour_ts >= TIMESTAMP '2024-01-08 00:00:00' AND hour_ts < TIMESTAMP '2024-01-22 00:00:00' AND candidate_status = 'REVIEW_PRESSURE'"


@query("export_hours", _sql(O.chain(), f"SELECT * FROM investigation WHERE {_HOURS}", CAND_DOUBLES))
def q_export_hours(spark, d):
    """The review hours of a period, exported."""
    return exported(spark, investigation(spark, d).filter(_HOURS.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")), ["hour_ts"])


@query("export_incident", _sql(O.chain(upto="incidents"), """
SELECT g.incident_id, g.hour_ts, i.readings, i.loaded_readings, i.low_pressure_loaded_readings, i.current_low_fraction,
  i.prior_low_fraction, i.candidate_status
FROM (SELECT incident_id, UNNEST(generate_series(starts_at - INTERVAL 7 DAY, ends_at - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_ts
      FROM (SELECT * FROM incidents ORDER BY candidate_hours DESC, starts_at LIMIT 1) longest) g
LEFT JOIN investigation i ON i.hour_ts = g.hour_ts""", ["current_low_fraction", "prior_low_fraction"]))
def q_export_incident(spark, d):
    """The evidence of one incident (the longest), exported."""
    inv = investigation(spark, d)
    one = incidents(spark, d).orderBy(F.desc("candidate_hours"), "starts_at").limit(1)
    return exported(spark, incident_evidence(one, inv, SPEC.lookback_days), ["hour_ts"])


@query("export_report_context", _sql(O.chain(), """
SELECT *, expected_hours - observed_hours AS missing_hours FROM (
  SELECT w.report_id, w.report_type, w.starts_at, w.ends_at, w.opens AS window_start, w.closes AS window_end,
    date_diff('hour', w.opens, w.closes) AS expected_hours,
    (SELECT COUNT(*) FROM investigation i WHERE i.hour_ts >= w.opens AND i.hour_ts < w.closes) AS observed_hours,
    (SELECT COUNT(*) FROM investigation i WHERE i.hour_ts >= w.opens AND i.hour_ts < w.closes
       AND i.candidate_status = 'REVIEW_PRESSURE') AS candidate_hours
  FROM (SELECT *, date_trunc('hour', starts_at - INTERVAL 21 DAY) AS opens,
          date_trunc('hour', ends_at + INTERVAL 21 DAY + INTERVAL 59 MINUTE + INTERVAL 59 SECOND) AS closes FROM reports) w) q"""))
def q_export_report_context(spark, d):
    """Three weeks of context of every report, exported."""
    return exported(spark, report_context(reports(spark), investigation(spark, d), 21), ["report_id"])


@query("provenance_row", _sql([READINGS_SQL], """
SELECT 'sf-run' AS run_id, CAST(NULL AS VARCHAR) AS source_sha256, COUNT(*) AS original_rows,
  TIMESTAMP '2024-02-01 06:30:00' AS loaded_at, 'events.parquet' AS source_name, TRUE AS is_complete_source,
  MIN(observed_at) AS first_reading, MAX(observed_at) AS last_reading,
  COUNT(*) - COUNT(DISTINCT observed_at) AS duplicate_timestamps FROM readings"""))
def q_provenance_row(spark, d):
    """Singleton load-state row."""
    return S.provenance_row(readings(spark, d), "sf-run", "events.parquet", None, True, LOADED_AT)


def _publish(spark, d):
    from hourwise.plans.refresh import refresh
    root = scratch(spark, "snapshots")
    sha = S.source_digest(spark, posixpath.join(d, "events.parquet"), "*.parquet")
    refresh(spark, readings(spark, d), reports(spark), SPEC, root, "sf-run", "events.parquet", source_sha256=sha,
            snapshot_id="sf-run-snapshot", loaded_at=LOADED_AT, exported_at=EXPORTED_AT)
    return root


@query("snapshot_manifest", _sql([READINGS_SQL], f"""
SELECT 'sf-run-snapshot' AS snapshot_id, 'sf-run' AS run_id, TRUE AS source_digest_recorded, COUNT(*) AS original_reading_count,
  strftime(MIN(observed_at), '%Y-%m-%dT%H:%M:%S') AS first_reading, strftime(MAX(observed_at), '%Y-%m-%dT%H:%M:%S') AS last_reading,
  COUNT(*) - COUNT(DISTINCT observed_at) AS duplicate_timestamps, '{LOADED_AT.isoformat()}' AS loaded_at,
  '{EXPORTED_AT}' AS exported_at, 'Original naive timestamps; source timezone unspecified.' AS timestamp_policy FROM readings"""))
def q_snapshot_manifest(spark, d):
    """Gated publish of five ordered tables; the manifest read back as a row."""
    root = _publish(spark, d)
    folder, _ = S.current_snapshot(spark, root)
    m = spark.read.option("multiLine", True).json(posixpath.join(folder, S.MANIFEST))
    second = lambda c: F.substring(c, 1, 19).alias(c)
    return m.select("snapshot_id", "run_id", F.col("source_sha256").rlike("^[0-9a-f]{64}$").alias("source_digest_recorded"),
                    "original_reading_count", second("first_reading"), second("last_reading"), "duplicate_timestamps",
                    "loaded_at", "exported_at", "timestamp_policy")


@query("snapshot_verify", _sql(O.chain(upto="all"), """
SELECT 'daily_metrics' AS "table", COUNT(*) AS "rows", CAST(SUM(readings) AS BIGINT) AS readings, TRUE AS ok FROM daily
UNION ALL SELECT 'hourly_investigation', COUNT(*), CAST(SUM(readings) AS BIGINT), TRUE FROM investigation
UNION ALL SELECT 'incidents', COUNT(*), CAST(SUM(readings) AS BIGINT), TRUE FROM incidents
UNION ALL SELECT 'failure_reports', COUNT(*), NULL, TRUE FROM reports
UNION ALL SELECT 'report_review', COUNT(*), NULL, TRUE FROM reports"""))
def q_snapshot_verify(spark, d):
    """Tables of the current snapshot read back with their types, and whether all of their part files have the
    recorded digests."""
    root = _publish(spark, d)
    frames, _ = S.read_snapshot(spark, root)
    checked = (S.verify_snapshot(spark, root).groupBy(F.element_at(F.split("file", "/"), 1).alias("table"))
               .agg(F.bool_and("ok").alias("ok")))
    sums = None
    for name, df in frames.items():
        total = F.sum("readings") if "readings" in df.columns else F.lit(None)
        row = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("readings"))
        sums = row if sums is None else sums.unionByName(row)
    return sums.join(checked, "table").select("table", "rows", "readings", "ok")


_JSON_COLUMNS = ["observed_hours", "eligible_hours", "not_evaluated_hours", "current_only", "baseline_only", "both"]


@query("json_rows", _sql(O.chain(upto="all") + [f"audit AS ({RECON_SQL})"], f"""
SELECT '{{' || concat_ws(',', {", ".join(f"""'"{c}":' || "{c}" """ for c in _JSON_COLUMNS)},
  '"first_hour":"' || strftime(first_hour, '%Y-%m-%dT%H:%M:%S') || '.000"') || '}}' AS json FROM audit"""))
def q_json_rows(spark, d):
    """Audit result rows as JSON documents (NULL fields kept)."""
    return S.json_rows(A.reconciliation(investigation(spark, d), SPEC).select(*_JSON_COLUMNS, "first_hour"))


_UPSERT_TYPE = "Candidate incident review"
_OVERLAP_TYPE = "Reported air leak (candidate overlap)"


@query("upsert_reports", _sql(O.chain(upto="incidents") + [f"""upd AS (
  SELECT CAST(epoch(starts_at) / 3600 AS INTEGER) AS report_id, starts_at, ends_at, '{_UPSERT_TYPE}' AS report_type
  FROM incidents WHERE candidate_hours >= 2
  UNION ALL
  SELECT r.report_id, r.starts_at, r.ends_at, '{_OVERLAP_TYPE}' FROM reports r
  WHERE EXISTS (SELECT 1 FROM incidents i WHERE i.starts_at < r.ends_at AND i.ends_at > r.starts_at))"""],
                                """
SELECT * FROM reports WHERE report_id NOT IN (SELECT report_id FROM upd) UNION ALL SELECT * FROM upd"""))
def q_upsert_reports(spark, d):
    """Keyed insert-or-replace of report intervals from incident reviews."""
    rep = reports(spark)
    inc_df = incidents(spark, d)
    new = inc_df.filter(F.col("candidate_hours") >= 2).select(
        (F.unix_seconds(F.col("starts_at").cast("timestamp")) / 3600).cast("int").alias("report_id"),
        "starts_at", "ends_at", F.lit(_UPSERT_TYPE).alias("report_type"))
    inc_hours = inc_df.select(F.explode(F.sequence("starts_at", F.col("ends_at") - F.expr("INTERVAL 1 HOUR"),
                                                   F.expr("INTERVAL 1 HOUR"))).alias("hour_ts")).distinct()
    slots = report_slots(rep, trunc_hour("starts_at"), trunc_hour(F.col("ends_at") - F.expr("INTERVAL 1 MICROSECOND")))
    hit = slots.join(inc_hours, on="hour_ts", how="left_semi").select("report_id").distinct()
    restated = rep.join(hit, on="report_id", how="left_semi").withColumn("report_type", F.lit(_OVERLAP_TYPE))
    return S.upsert(rep, new.unionByName(restated.select(*REPORT_KEY)), ["report_id"])
