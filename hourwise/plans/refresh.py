"""Full refresh (S7): readings -> materialised hourly mart -> every derived table
-> reconciliation gate -> published snapshot.

Raw readings are scanned once in full: for the hourly mart (map-side combined, then
written once as a parquet table under the cluster's ``spark.checkpoint.dir``). Row count and
time bounds are observed in that very scan, the mart's total in the mart's write and the daily total in
the export of the daily table, so the gate needs no job of its own. Only the exact number of duplicate
timestamps takes a second pass, over one column; ``count_duplicates=False`` leaves it out (and null in the manifest).
In the mart's job it would have to shuffle every sum by timestamp, about ten times as many bytes.

Observed numbers can be too high if tasks ran twice (a lost executor). If they do not agree, they are counted again by
plain aggregates before the snapshot is refused. Daily mart, baseline, rule, incidents and report review
all derive from the materialised mart. Any failure before the pointer swap leaves the previous snapshot published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourwise.operators import incidents as inc, marts, review, rule
from hourwise.session import checkpoint_dir, materialize
from hourwise.sources import snapshot as S
from hourwise.spec import RuleSpec


@dataclass
class RefreshResult:
    snapshot_path: str
    state: dict
    counts: dict
    tables: dict


def _total(column: str):
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


class ObservedCounts:
    """Row totals of raw readings, hourly and daily mart, taken in the jobs that read and write them."""

    def __init__(self):
        self.scan, self.mart, self.daily = Observation("raw_readings"), Observation("hourly_mart"), Observation("daily_mart")

    def watched(self, readings: DataFrame) -> DataFrame:
        return readings.observe(self.scan, F.count(F.lit(1)).alias("raw_rows"), F.min("observed_at").alias("first_reading"),
                                F.max("observed_at").alias("last_reading"))

    def watched_mart(self, hourly: DataFrame) -> DataFrame:
        return hourly.observe(self.mart, _total("readings").alias("hourly_rows"))

    def daily_export(self) -> tuple:
        return self.daily, [_total("readings").alias("daily_rows")]

    def bounds(self) -> dict:
        """Rows, first and last reading; the mart must have been written."""
        return dict(self.scan.get)

    def counts(self, readings: DataFrame, hourly: DataFrame, daily: DataFrame) -> dict:
        seen = {"raw_rows": self.scan.get["raw_rows"], **self.mart.get, **self.daily.get}
        if len(set(seen.values())) == 1:
            return seen
        return S.reconcile_counts(readings, hourly, daily).first().asDict()


def refresh(spark: SparkSession, readings: DataFrame, reports: DataFrame, spec: RuleSpec, root: str,
            run_id: str, source_name: str, source_sha256: str | None = None, complete: bool = True,
            snapshot_id: str | None = None, loaded_at=None, exported_at: str | None = None,
            count_duplicates: bool = True) -> RefreshResult:
    checkpoint_dir(spark)
    loaded_at, seen = loaded_at or S.now(), ObservedCounts()
    # the materialised mart
    hourly = materialize(seen.watched_mart(marts.hourly_mart(seen.watched(readings), spec)), "mart_hourly")
    if count_duplicates:
        state = S.provenance_row(readings.select("observed_at"), run_id, source_name, source_sha256, complete,
                                 loaded_at).first().asDict()
    else:
        b = seen.bounds()
        state = {"run_id": run_id, "source_sha256": source_sha256, "original_rows": b["raw_rows"], "loaded_at": loaded_at,
                 "source_name": source_name, "is_complete_source": complete, "first_reading": b["first_reading"],
                 "last_reading": b["last_reading"], "duplicate_timestamps": None}
    daily = marts.daily_mart(hourly)
    cand = materialize(rule.candidate_hours(hourly, spec), "mart_candidate_hours")
    inv = rule.investigation(hourly, reports, spec, candidates=cand)
    tables = {"hourly_investigation": (inv, ["hour_ts"]), "daily_metrics": (daily, ["reading_date"]),
              "failure_reports": (reports, ["report_id"]), "incidents": (inc.incidents(inv, spec, materialize_input=False), ["starts_at"]),
              "report_review": (review.report_review(reports, cand), ["report_id"])}
    counts: dict = {}

    def gate_counts() -> dict:
        counts.update(seen.counts(readings, hourly, daily))
        return counts
    path = S.publish_snapshot(spark, root, snapshot_id or run_id, tables, state, gate_counts, spec.as_dict(), exported_at,
                              observed={"daily_metrics": seen.daily_export()})
    return RefreshResult(path, state, counts, tables)
