"""Alert evaluation with grace suppression.

State rule per alert, ticks in time order, state = time of the last Success:
``On Grace`` if a Success exists and ``tick - last < grace`` (condition not
re-evaluated); else ``Success`` if ``value op threshold`` (state updated);
else ``Not triggered``.  Equality ``tick - last == grace`` counts as expired.

Batch plan (no per-alert collect of the whole log):

1. Only condition-true ticks can become Success.  They are cut into segments
   wherever two consecutive true ticks are >= grace apart: the first true tick
   of a segment is always a Success, so segments are independent.  Segment
   ids come from the chunked islands operator (partitioned by alert + chunk).
2. Inside a segment the greedy chain (next Success = first true tick >= last +
   grace) is sequential; it runs per segment with ``applyInPandas`` using
   binary-search jumps (one step per Success, not per tick).
3. Every tick then finds its last Success at or before it with a bucketed
   running max (per alert and day, plus a carry from earlier days), and the
   state follows from the rule above.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwise.functions.columns import ntz_lit
from hourwise.session import materialize
from hourwise.operators.incidents import assign_islands

def _ship_by_value() -> None:
    """Executor-side Python in this module travels with the task (pickled by value), so Python
    workers need no installed copy of the package."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: the package must then be on the executors' path
        pass


_ship_by_value()

NOT_TRIGGERED, SUCCESS, ON_GRACE = "Not triggered", "Success", "On Grace"

_OPS = {">": lambda c, t: c > t, ">=": lambda c, t: c >= t, "<": lambda c, t: c < t,
        "<=": lambda c, t: c <= t, "==": lambda c, t: c == t, "!=": lambda c, t: c != t}


def condition(value, op: str, threshold: float):
    """X1 operator validator: ``value op threshold`` (NULL value -> false)."""
    return F.coalesce(_OPS[op](value, F.lit(threshold)), F.lit(False))


def alert_condition(values: DataFrame, op: str = ">", threshold: float = 0.0,
                    value_col: str = "value") -> DataFrame:
    """One row per alert with the scalar condition value and whether it triggers."""
    return values.withColumn("triggered", condition(F.col(value_col), op, threshold))


#: A run of true ticks is worked on in chunks of so many grace windows.
CHUNK_WINDOWS = 256


def _jumps(ep: np.ndarray, grace_us: int) -> np.ndarray:
    """For every tick, the position of the first tick a grace window later."""
    return np.searchsorted(ep, ep + grace_us, side="left")


def _exits(grace_us: int):
    """Where a chunk (from ``_start`` on) is left, for each tick at which it can be entered: those up to the first one that is a
    grace window after its start."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ep = np.unique(pdf["_us"].to_numpy())
        after = np.searchsorted(ep, int(pdf["_start"].iloc[0]) + grace_us, side="left")
        entries = np.arange(min(len(ep), after + 1))
        jump, at = _jumps(ep, grace_us), entries.copy()
        while (moving := jump[at] < len(ep)).any():
            at = np.where(moving, jump[at], at)
        return pd.DataFrame({"_alert": pdf["_alert"].iloc[0], "_segment": pdf["_segment"].iloc[0], "_chunk": pdf["_chunk"].iloc[0],
                             "_in": ep[entries], "_out": ep[at] + grace_us})
    return run


def _following(part: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(chunk, entries, exits) of a group's chunks in order."""
    return [(int(c), p["_in"].to_numpy(), p["_out"].to_numpy())
            for c, p in part.sort_values(["_chunk", "_in"]).groupby("_chunk", sort=True)]


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where a group of chunks is left, for each tick at which its first chunk can be entered."""
    (_, entries, free), *rest = _following(pdf)
    for _, ins, outs in rest:
        at = np.searchsorted(ins, free, side="left")
        free = np.where(at < len(ins), outs[np.minimum(at, len(ins) - 1)], free)
    return pd.DataFrame({"_alert": pdf["_alert"].iloc[0], "_segment": pdf["_segment"].iloc[0], "_chunk": pdf["_group"].iloc[0],
                         "_in": entries, "_out": free})


def _walked(pdf: pd.DataFrame) -> pd.DataFrame:
    """The tick at which each chunk of a group is entered, given the tick at which the group is."""
    found, free = [], pdf["_entry"].iloc[0]
    for chunk, ins, outs in _following(pdf):
        if (i := int(np.searchsorted(ins, free, side="left"))) < len(ins):
            found.append((chunk, ins[i]))
            free = outs[i]
    return pd.DataFrame({"_alert": pdf["_alert"].iloc[0], "_segment": pdf["_segment"].iloc[0],
                         "_chunk": [c for c, _ in found], "_entry": [t for _, t in found]})


def chained(exits: DataFrame, fan: int | None = None) -> DataFrame:
    """(_alert, _segment, _chunk, _entry): the tick at which each chunk of a run is entered, the run at its first tick.

    Chunks (numbered from the start of their run) are put together in groups of ``fan``, groups in groups, until a run is one group;
    then the entries go down the same way. So no task gets more than ``fan`` chunks of a run, whose rows are the ticks
    of one grace window each. The number of levels is the logarithm of the longest run.
    """
    fan, by, key = fan or CHUNK_WINDOWS, ["_alert", "_segment"], exits.schema["_alert"].dataType.simpleString()
    key = f"_alert {key}, _segment timestamp_ntz, _chunk long"
    levels, most = [exits], exits.agg(F.max("_chunk")).first()[0] or 0
    grouped = lambda df: df.withColumn("_group", F.floor(F.col("_chunk") / fan).cast("long"))
    while most >= fan:
        levels.append(materialize(grouped(levels[-1]).groupBy(*by, "_group").applyInPandas(_composed, f"{key}, _in long, _out long"),
                                  "alert_exits"))
        most //= fan
    entries = levels[-1].groupBy(*by).agg(F.lit(0).cast("long").alias("_group"), F.min("_in").alias("_entry"))
    for level in reversed(levels):
        entries = (grouped(level).join(entries, [*by, "_group"]).groupBy(*by, "_group").applyInPandas(_walked, f"{key}, _entry long")
                   .withColumnRenamed("_chunk", "_group"))
    return entries.withColumnRenamed("_group", "_chunk")


def _marks(grace_us: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ep = np.unique(pdf["_us"].to_numpy())
        jump, hit, i = _jumps(ep, grace_us), np.zeros(len(ep), dtype=bool), int(np.searchsorted(ep, pdf["_entry"].iloc[0]))
        while i < len(ep):
            hit[i] = True
            i = jump[i]
        return pd.DataFrame({"_alert": pdf["_alert"].iloc[0], "_us": ep[hit], "_success": True})
    return run


def successes(true_ticks: DataFrame, grace_us: int) -> DataFrame:
    """(_alert, _us, _success) of the ticks that succeed: the first of each run, then each first tick a grace
    window after the last success.

    A run is cut into chunks, which are worked on apart: first, for each tick at which a chunk can be entered, where it
    is left; then the chunks are chained in groups of groups (``chained``); then each chunk is marked from its entry. So an
    alert that is always true spreads over many tasks.
    """
    chunk_us = CHUNK_WINDOWS * max(1, grace_us)
    seg = assign_islands(true_ticks, ["_alert"], "_tick", out="_segment", max_gap_micros=grace_us,
                         materialize_input=False)  # a filter over the written tick log
    begin = F.unix_micros(F.col("_segment").cast("timestamp"))
    seg = seg.select("_alert", "_segment", "_us", F.floor((F.col("_us") - begin) / chunk_us).cast("long").alias("_chunk"))
    seg = materialize(seg.withColumn("_start", begin + F.col("_chunk") * chunk_us), "alert_chunks")
    kind = seg.schema["_alert"].dataType.simpleString()
    key = f"_alert {kind}, _segment timestamp_ntz, _chunk long"
    exits = seg.groupBy("_alert", "_segment", "_chunk").applyInPandas(_exits(grace_us), f"{key}, _in long, _out long")
    entries = chained(materialize(exits, "alert_exits"))
    return (seg.join(entries, ["_alert", "_segment", "_chunk"]).groupBy("_alert", "_segment", "_chunk")
            .applyInPandas(_marks(grace_us), f"_alert {kind}, _us long, _success boolean"))


def running_last(df: DataFrame, key: str, ts: str, flag: str, out: str, day_of: str | None = None) -> DataFrame:
    """``out`` = max ``ts`` with ``flag`` at or before each row (per key), bucketed by day + carry.

    ``day_of`` is the timestamp column that defines the day bucket (default ``ts``).
    """
    b = df.withColumn("_day", F.to_date(day_of or ts))
    w = Window.partitionBy(key, "_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.withColumn("_loc", F.max(F.when(F.col(flag), F.col(ts))).over(w))
    per_day = b.groupBy(key, "_day").agg(F.max(F.when(F.col(flag), F.col(ts))).alias("_dl"))
    carry = per_day.select(key, "_day", F.max("_dl").over(
        Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    return (local.join(carry, on=[key, "_day"], how="left")
            .withColumn(out, F.coalesce("_loc", "_carry")).drop("_day", "_loc", "_carry"))


def alert_states(ticks: DataFrame, grace_seconds: float, op: str = ">", threshold: float = 0.0,
                 alert: str = "alert", tick: str = "tick", value: str = "value",
                 active: DataFrame | None = None) -> DataFrame:
    """Execution log ``(alert, tick, value, state)``; inactive alerts produce no rows."""
    t = ticks.select(F.col(alert).alias("_alert"), F.col(tick).cast("timestamp_ntz").alias("_tick"),
                     F.col(value).alias("_value"))
    if active is not None:
        t = t.join(active.filter(F.col("active")).select(F.col(alert).alias("_alert")), on="_alert", how="left_semi")
    grace_us = int(round(grace_seconds * 1_000_000))
    # the tick log feeds several branches (segments, success marks, running last): written once
    t = materialize(t.withColumn("_us", F.unix_micros(F.col("_tick").cast("timestamp"))), "alert_ticks")
    true_ticks = t.filter(condition(F.col("_value"), op, threshold)).select("_alert", "_tick", "_us")
    succ = successes(true_ticks, grace_us)
    marked = t.join(succ, on=["_alert", "_us"], how="left").withColumn(
        "_success", F.coalesce("_success", F.lit(False)))
    last = running_last(marked, "_alert", "_us", "_success", "_last_us", day_of="_tick")
    in_grace = F.col("_last_us").isNotNull() & (F.col("_us") - F.col("_last_us") < grace_us) & ~F.col("_success")
    state = F.when(F.col("_success"), F.lit(SUCCESS)).when(in_grace, F.lit(ON_GRACE)).otherwise(F.lit(NOT_TRIGGERED))
    return last.select(F.col("_alert").alias(alert), F.col("_tick").alias(tick), F.col("_value").alias(value),
                       state.alias("state"))


def repeat_elapsed(log: DataFrame, alert: str = "alert", tick: str = "tick", grace_seconds: float | None = None
                   ) -> DataFrame:
    """Seconds between successive Success rows of each alert (and whether >= grace)."""
    s = log.filter(F.col("state") == SUCCESS).select(alert, tick)
    prev = F.lag(tick).over(Window.partitionBy(alert).orderBy(tick))
    out = s.withColumn("previous_success", prev).filter(F.col("previous_success").isNotNull())
    out = out.withColumn("elapsed_seconds", (F.unix_micros(F.col(tick).cast("timestamp"))
                                             - F.unix_micros(F.col("previous_success").cast("timestamp"))) / 1e6)
    if grace_seconds is not None:
        out = out.withColumn("respects_grace", F.col("elapsed_seconds") >= grace_seconds)
    return out


def latest_n(log: DataFrame, n: int = 30, key: str = "alert", order: str = "tick") -> DataFrame:
    """Newest ``n`` rows per key, returned ascending (row_number filter -> per-key group limit)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (log.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
            .orderBy(key, order))


def prune_retention(log: DataFrame, days: int, now, order: str = "tick") -> DataFrame:
    """Keep rows with ``tick >= now - days``."""
    return log.filter(F.col(order) >= ntz_lit(now) - F.expr(f"INTERVAL {days} DAYS"))


def incremental(log: DataFrame, prior: DataFrame, id_col: str = "log_id") -> DataFrame:
    """Rows with an id above the high-water mark of the previous poll's log (all rows if that is empty)."""
    mark = prior.select(F.max(id_col)).scalar()
    return log.filter(mark.isNull() | (F.col(id_col) > mark))
