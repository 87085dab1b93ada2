"""Additive marts: raw -> hourly -> daily, and the operating-state long form.

The hourly mart keeps additive sums (not only means) so every coarser grain is
a roll-up of the mart, never a rescan of raw readings.  ``groupBy`` compiles to
partial + final HashAggregate, so raw rows are combined map-side before the
shuffle; the shuffle carries at most one row per (keys, hour) per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import ratio, trunc_hour
from hourwise.spec import RuleSpec

HOURLY_COLUMNS = [
    "hour_ts", "readings", "panel_pressure_sum", "oil_temperature_sum", "pressure_gap_sum",
    "avg_panel_pressure_bar", "avg_reservoir_pressure_bar", "avg_motor_current_a", "avg_oil_temperature_c",
    "avg_pressure_gap_bar", "loaded_readings", "unloaded_readings", "idle_readings",
    "low_pressure_loaded_readings", "lps_active_readings",
]

DAILY_COLUMNS = [
    "reading_date", "readings", "loaded_readings", "unloaded_readings", "idle_readings",
    "low_pressure_loaded_readings", "low_pressure_loaded_fraction", "avg_panel_pressure_bar",
    "avg_pressure_gap_bar", "avg_oil_temperature_c",
]


def state_predicates(spec: RuleSpec, current="motor_current", pressure="tp3"):
    cur, tp3 = F.col(current), F.col(pressure)
    loaded = cur >= spec.loaded_current
    return {
        "loaded": loaded,
        "unloaded": (cur >= spec.unloaded_current) & (cur < spec.loaded_current),
        "idle": cur < spec.unloaded_current,
        "low": loaded & (tp3 < spec.low_pressure),
    }


def hourly_mart(readings: DataFrame, spec: RuleSpec, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    p = state_predicates(spec)
    gap = F.abs(F.col("tp3") - F.col("reservoirs"))
    out = (readings
           .groupBy(*keys, trunc_hour("observed_at").alias("hour_ts"))
           .agg(F.count(F.lit(1)).alias("readings"),
                F.sum("tp3").alias("panel_pressure_sum"),
                F.sum("oil_temperature").alias("oil_temperature_sum"),
                F.sum(gap).alias("pressure_gap_sum"),
                F.avg("tp3").alias("avg_panel_pressure_bar"),
                F.avg("reservoirs").alias("avg_reservoir_pressure_bar"),
                F.avg("motor_current").alias("avg_motor_current_a"),
                F.avg("oil_temperature").alias("avg_oil_temperature_c"),
                F.avg(gap).alias("avg_pressure_gap_bar"),
                F.count_if(p["loaded"]).alias("loaded_readings"),
                F.count_if(p["unloaded"]).alias("unloaded_readings"),
                F.count_if(p["idle"]).alias("idle_readings"),
                F.count_if(p["low"]).alias("low_pressure_loaded_readings"),
                F.count_if(F.col("lps") == 1).alias("lps_active_readings")))
    return out.select(*keys, *HOURLY_COLUMNS)


def daily_mart(hourly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Second-level roll-up of the hourly mart: sums, shares of sums, weighted means."""
    keys = list(keys or [])
    s = {c: F.sum(c) for c in ["readings", "loaded_readings", "unloaded_readings", "idle_readings",
                               "low_pressure_loaded_readings", "panel_pressure_sum", "pressure_gap_sum",
                               "oil_temperature_sum"]}
    out = (hourly.groupBy(*keys, F.to_date("hour_ts").alias("reading_date"))
           .agg(s["readings"].cast("bigint").alias("readings"),
                s["loaded_readings"].cast("bigint").alias("loaded_readings"),
                s["unloaded_readings"].cast("bigint").alias("unloaded_readings"),
                s["idle_readings"].cast("bigint").alias("idle_readings"),
                s["low_pressure_loaded_readings"].cast("bigint").alias("low_pressure_loaded_readings"),
                ratio(s["low_pressure_loaded_readings"], s["loaded_readings"]).alias("low_pressure_loaded_fraction"),
                ratio(s["panel_pressure_sum"], s["readings"]).alias("avg_panel_pressure_bar"),
                ratio(s["pressure_gap_sum"], s["readings"]).alias("avg_pressure_gap_bar"),
                ratio(s["oil_temperature_sum"], s["readings"]).alias("avg_oil_temperature_c")))
    return out.select(*keys, *DAILY_COLUMNS)


def operating_states(hourly: DataFrame, spec: RuleSpec, keys: list[str] | None = None) -> DataFrame:
    """Three rows per hour: (hour_ts, operating_state, observations); a narrow unpivot (no join)."""
    keys = list(keys or [])
    lab = spec.state_labels()
    states = F.array(*[F.struct(F.lit(lab[s]).alias("operating_state"), F.col(f"{s}_readings").alias("observations"))
                       for s in ("loaded", "unloaded", "idle")])
    return hourly.select(*keys, "hour_ts", F.inline(states))
