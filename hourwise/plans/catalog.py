"""Named query registry: one Spark plan per operator, each paired (where the
semantics are SQL-expressible) with an independent DuckDB oracle string.

Every query reads the driver tables (``events`` -> readings adapter) at the
given scale-factor directory, so its work grows with the data.  Double
columns are rounded to 6 places on both sides (float summation order differs
between engines).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from hourwise.functions.columns import round_doubles
from hourwise.operators import marts, rule, incidents as inc, review
from hourwise.plans import oracle as O
from hourwise.session import ensure_utc
from hourwise.sources import readings as R
from hourwise.spec import DEMO_V1

SPEC = DEMO_V1
ASSET = ["asset_id"]


@dataclass
class QueryDef:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, QueryDef] = {}


def query(name: str, sql: str | None = None, rounding: bool = True):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounding else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = QueryDef(name, run, sql)
        return run
    return deco


# ---------------------------------------------------------------- plan pieces
# Every call builds its plan anew from the files as they are now; nothing is kept between queries and
# nothing runs before the result is read.

def readings(spark, d):
    return R.readings(spark, d)


def reports(spark):
    return R.reports(spark)


def hourly(spark, d, keys=()):
    return marts.hourly_mart(readings(spark, d), SPEC, list(keys))


def candidates(spark, d, keys=()):
    return rule.candidate_hours(hourly(spark, d, keys), SPEC, list(keys))


def investigation(spark, d, keys=()):
    h = hourly(spark, d, keys)
    return rule.investigation(h, reports(spark), SPEC, list(keys),
                              candidates=rule.candidate_hours(h, SPEC, list(keys)))


def incidents(spark, d, keys=()):
    return inc.incidents(investigation(spark, d, keys), SPEC, list(keys), materialize_input=False)


def _sql(ctes, final, doubles=()):
    return O.rounded(O.with_(*ctes) + final, list(doubles))


HOURLY_DOUBLES = ["panel_pressure_sum", "oil_temperature_sum", "pressure_gap_sum", "avg_panel_pressure_bar",
                  "avg_reservoir_pressure_bar", "avg_motor_current_a", "avg_oil_temperature_c", "avg_pressure_gap_bar"]
CAND_DOUBLES = HOURLY_DOUBLES + ["current_low_fraction", "prior_low_fraction"]
DAILY_DOUBLES = ["low_pressure_loaded_fraction", "avg_panel_pressure_bar", "avg_pressure_gap_bar",
                 "avg_oil_temperature_c"]
INC_DOUBLES = ["low_pressure_share", "peak_hour_share"]


# ---------------------------------------------------------------- marts

@query("hourly_mart", _sql(O.chain(), "SELECT * FROM hourly", HOURLY_DOUBLES))
def q_hourly_mart(spark, d):
    """A1: hourly mart over all readings."""
    return hourly(spark, d)


@query("hourly_mart_by_asset", _sql(O.chain(ASSET), "SELECT * FROM hourly", HOURLY_DOUBLES))
def q_hourly_mart_by_asset(spark, d):
    """A1 with asset keys."""
    return hourly(spark, d, ASSET)


@query("daily_mart", _sql(O.chain(upto="daily"), "SELECT * FROM daily", DAILY_DOUBLES))
def q_daily_mart(spark, d):
    """A2: daily roll-up of the hourly mart."""
    return marts.daily_mart(hourly(spark, d))


@query("daily_mart_by_asset", _sql(O.chain(ASSET, upto="daily"), "SELECT * FROM daily", DAILY_DOUBLES))
def q_daily_mart_by_asset(spark, d):
    """A2 per asset."""
    return marts.daily_mart(hourly(spark, d, ASSET), ASSET)


_STATES = SPEC.state_labels()


@query("operating_states", _sql(O.chain(), f"""
SELECT h.hour_ts, s.operating_state, s.observations FROM hourly h,
  (SELECT '{_STATES["loaded"]}' AS operating_state, h.loaded_readings AS observations
   UNION ALL SELECT '{_STATES["unloaded"]}', h.unloaded_readings
   UNION ALL SELECT '{_STATES["idle"]}', h.idle_readings) s"""))
def q_operating_states(spark, d):
    """Operating-state long form (unpivot)."""
    return marts.operating_states(hourly(spark, d), SPEC)


# ---------------------------------------------------------------- rule

@query("candidate_hours", _sql(O.chain(upto="candidates"), "SELECT * FROM candidates", CAND_DOUBLES))
def q_candidate_hours(spark, d):
    """Trailing 7-day calendar baseline + rule status."""
    return candidates(spark, d)


@query("candidate_hours_by_asset", _sql(O.chain(ASSET, upto="candidates"), "SELECT * FROM candidates", CAND_DOUBLES))
def q_candidate_hours_by_asset(spark, d):
    """C1 per asset."""
    return candidates(spark, d, ASSET)


@query("investigation", _sql(O.chain(), "SELECT * FROM investigation", CAND_DOUBLES))
def q_investigation(spark, d):
    """C2 (flagship): 33-column investigation table."""
    return investigation(spark, d)


@query("investigation_by_asset", _sql(O.chain(ASSET), "SELECT * FROM investigation", CAND_DOUBLES))
def q_investigation_by_asset(spark, d):
    """C2 per asset."""
    return investigation(spark, d, ASSET)


@query("report_overlap_flag", _sql(O.chain(), """
SELECT hour_ts, overlaps_reported_failure FROM investigation"""))
def q_report_overlap_flag(spark, d):
    """EXISTS mark join of hours against report intervals."""
    return rule.mark_report_overlap(hourly(spark, d).select("hour_ts"), reports(spark))


# ---------------------------------------------------------------- incidents

@query("incidents", _sql(O.chain(upto="incidents"), "SELECT * FROM incidents", INC_DOUBLES))
def q_incidents(spark, d):
    """Gaps-and-islands incidents with stable ids."""
    return incidents(spark, d)


@query("incidents_by_asset", _sql(O.chain(ASSET, upto="incidents"), "SELECT * FROM incidents", INC_DOUBLES))
def q_incidents_by_asset(spark, d):
    """C3 per asset (asset in the id text)."""
    return incidents(spark, d, ASSET)


# ---------------------------------------------------------------- report context

#: Review hours as intervals, for the counts set beside each report.
BREACHES = """breaches AS (
  SELECT hour_ts AS opens, hour_ts + INTERVAL 1 HOUR AS closes FROM candidates WHERE candidate_status = 'REVIEW_PRESSURE')"""
REVIEWED = """
SELECT r.report_id, r.report_type, r.starts_at, r.ends_at,
  (SELECT COUNT(*) FROM breaches b WHERE b.closes <= r.starts_at AND b.closes > r.starts_at - INTERVAL 1 DAY)
    AS candidate_hours_ending_in_prior_24h,
  (SELECT COUNT(*) FROM breaches b WHERE GREATEST(b.opens, r.starts_at) < LEAST(b.closes, r.ends_at))
    AS candidate_hours_overlapping_report
FROM reports r"""


@query("report_review", _sql(O.chain(upto="candidates") + [BREACHES], REVIEWED))
def q_report_review(spark, d):
    """Per report, candidate hours ending in the prior 24 h and overlapping it."""
    return review.report_review(reports(spark), candidates(spark, d))


@query("retrospective_review", _sql(O.chain(upto="candidates") + [BREACHES], """
SELECT r.*, (SELECT COUNT(*) FROM breaches b WHERE epoch(r.starts_at - b.opens) > 0 AND epoch(r.starts_at - b.opens) <= 86400)
    AS candidate_hours_in_prior_24h,
  (SELECT COUNT(*) FROM breaches b WHERE epoch(b.opens - r.starts_at) >= 0 AND epoch(r.ends_at - b.opens) > 0)
    AS candidate_hours_during_report
FROM reports r ORDER BY r.starts_at"""))
def q_retrospective_review(spark, d):
    """Hour-start semantics, ordered by report start."""
    return review.retrospective_review(reports(spark), candidates(spark, d))


@query("candidate_totals", _sql(O.chain() + ["hits AS (SELECT * FROM investigation WHERE candidate_status = 'REVIEW_PRESSURE')"], """
SELECT (SELECT COUNT(*) FROM hits) AS review_candidate_hours,
  (SELECT COUNT(DISTINCT h.hour_ts) FROM hits h JOIN reports r ON r.starts_at < h.hour_ts + INTERVAL 1 HOUR AND r.ends_at > h.hour_ts)
    AS candidates_overlapping_reports"""))
def q_candidate_totals(spark, d):
    """Candidate and overlap totals."""
    return review.candidate_totals(investigation(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


def _load_all():
    # modules that register further queries on import
    import hourwise.plans.catalog_more  # noqa: F401
    import hourwise.plans.catalog_metrics  # noqa: F401
    import hourwise.plans.catalog_alerts  # noqa: F401
    import hourwise.plans.catalog_sources  # noqa: F401
    import hourwise.plans.catalog_streaming  # noqa: F401
    import hourwise.plans.catalog_marts  # noqa: F401
