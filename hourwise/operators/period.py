"""Period scoping and KPIs.

The period filter is applied *above* the baseline window, so an hour keeps its
full 7-day context when the visible period narrows (Catalyst keeps filters on
a window's order column above the Window node; see tests/test_plans.py).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import date_lit, ntz_lit, ratio
from hourwise.operators.timegrid import densify
from hourwise import spec as S


def bounds(start, end) -> tuple[dt.datetime, dt.datetime]:
    """Inclusive dates -> half-open ``[lo, hi)`` with ``hi = end + 1 day``."""
    lo = dt.datetime.combine(_date(start), dt.time())
    hi = dt.datetime.combine(_date(end), dt.time()) + dt.timedelta(days=1)
    return lo, hi


def _date(x):
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x))


def _ts(x):
    return ntz_lit(x)


def half_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """``lo <= col < hi`` (sargable; pushed to the scan when col is stored)."""
    c = F.col(col)
    if col == "reading_date":
        return df.filter((c >= date_lit(lo)) & (c < date_lit(hi)))
    return df.filter((c >= _ts(lo)) & (c < _ts(hi)))


def overlapping(df: DataFrame, lo, hi, start: str = "starts_at", end: str = "ends_at") -> DataFrame:
    """P10: intervals with ``start < hi AND end > lo``."""
    return df.filter((F.col(start) < _ts(hi)) & (F.col(end) > _ts(lo)))


def select_period(tables: dict[str, DataFrame], start, end) -> dict[str, DataFrame]:
    """hourly/daily by half-open range, incidents/reports by interval overlap; any subset of them."""
    lo, hi = bounds(start, end)
    cut = {
        "hourly": lambda t: half_open(t, "hour_ts", lo, hi),
        "daily": lambda t: half_open(t, "reading_date", lo, hi),
        "incidents": lambda t: overlapping(t, lo, hi),
        "reports": lambda t: overlapping(t, lo, hi),
    }
    return {name: cut[name](t) for name, t in tables.items()}


def combine_rows(*one_row_frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates with disjoint columns into one row (union + agg, no join)."""
    first, *rest = one_row_frames
    u = first
    for f in rest:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in one_row_frames:
        cols += f.columns
    return u.agg(*[F.max(c).alias(c) for c in cols])


def kpis(selection: dict[str, DataFrame]) -> DataFrame:
    """Readings, loaded, share (NULL when no loaded), candidates, incidents, reports."""
    d, h = selection["daily"], selection["hourly"]
    daily = d.agg(F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("readings"),
                  F.coalesce(F.sum("loaded_readings"), F.lit(0)).cast("bigint").alias("loaded_readings"),
                  ratio(F.sum("low_pressure_loaded_readings"), F.sum("loaded_readings")).alias("low_pressure_share"))
    hourly = h.agg(F.count_if(F.col("candidate_status") == S.REVIEW_PRESSURE).cast("bigint").alias("candidate_hours"))
    inc = selection["incidents"].agg(F.count(F.lit(1)).alias("incidents"))
    rep = selection["reports"].agg(F.count(F.lit(1)).alias("reports"))
    return combine_rows(daily, hourly, inc, rep)


def state_totals(hourly: DataFrame, spec: S.RuleSpec) -> DataFrame:
    """loaded/unloaded/idle totals over a selection, one row per state."""
    lab = spec.state_labels()
    tot = hourly.agg(*[F.coalesce(F.sum(f"{s}_readings"), F.lit(0)).cast("bigint").alias(s)
                       for s in ("loaded", "unloaded", "idle")])
    states = F.array(*[F.struct(F.lit(lab[s]).alias("operating_state"), F.col(s).alias("observations"))
                       for s in ("loaded", "unloaded", "idle")])
    return tot.select(F.inline(states))


def status_histogram(hourly: DataFrame, col: str = "candidate_status") -> DataFrame:
    """Hours per status; a NULL status stays its own group."""
    return hourly.groupBy(col).agg(F.count(F.lit(1)).alias("hours"))


def review_queue(incidents: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """O3: newest first, column subset."""
    columns = columns or ["incident_id", "starts_at", "ends_at", "candidate_hours", "low_pressure_share",
                          "overlaps_reported_failure"]
    return incidents.orderBy(F.col("starts_at").desc(), F.col("incident_id")).select(*columns)


def daily_trend_dense(daily: DataFrame, start, end, keys: list[str] | None = None) -> DataFrame:
    """Period daily trend (share, pressure, gap, temperature) on the full selected date grid."""
    lo, hi = bounds(start, end)
    sel = half_open(daily, "reading_date", lo, hi).select(
        *(keys or []), F.col("reading_date").cast("timestamp_ntz").alias("day"),
        "low_pressure_loaded_fraction", "avg_panel_pressure_bar", "avg_pressure_gap_bar", "avg_oil_temperature_c")
    dense = densify(sel, "day", 86400, lo, hi, keys)
    return dense.withColumn("reading_date", F.to_date("day")).drop("day")
