"""Streaming alert evaluation (X2 stream form).

Ticks arrive as a stream; state per alert is one value, the time of the last
Success (microseconds), held in Spark's state store (``applyInPandasWithState``,
checkpointed, so an executor loss replays from the checkpoint).  Each micro-batch
hands an alert's new ticks to the function, which evaluates them in time order
with vectorised jumps: the next Success is the first condition-true tick at or
after ``last + grace``; every tick then takes the state of the latest Success at
or before it.  Ticks must arrive in time order per alert (a tick older than the
alert's stored state is evaluated against that state, as the scheduler would).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from hourwise.operators.alerts import NOT_TRIGGERED, ON_GRACE, SUCCESS

_CMP = {">": np.greater, ">=": np.greater_equal, "<": np.less, "<=": np.less_equal, "==": np.equal,
        "!=": np.not_equal}

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

OUTPUT = StructType([StructField("alert", StringType()), StructField("tick", TimestampNTZType()),
                     StructField("value", DoubleType()), StructField("state", StringType())])
STATE = StructType([StructField("last_success_us", LongType())])


def evaluate_ticks(us: np.ndarray, values: np.ndarray, last: int | None, grace_us: int, op: str,
                   threshold: float) -> tuple[np.ndarray, int | None]:
    """States for sorted ticks ``us`` given the stored last Success; returns (states, new last)."""
    cond = _CMP[op](values, threshold)  # NULL arrives as NaN and compares false
    cand = us[cond]
    succ = []
    pos = 0 if last is None else int(np.searchsorted(cand, last + grace_us, side="left"))
    while pos < len(cand):
        s = int(cand[pos])
        succ.append(s)
        pos = int(np.searchsorted(cand, s + grace_us, side="left"))
    succ_arr = np.array(([last] if last is not None else []) + succ, dtype=np.int64)
    if not len(succ_arr):
        return np.full(len(us), NOT_TRIGGERED), None
    idx = np.searchsorted(succ_arr, us, side="right") - 1
    prev = np.where(idx >= 0, succ_arr[np.clip(idx, 0, None)], np.iinfo(np.int64).min)
    is_succ = np.isin(us, np.array(succ, dtype=np.int64))
    in_grace = (idx >= 0) & (us - prev < grace_us) & ~is_succ
    states = np.where(is_succ, SUCCESS, np.where(in_grace, ON_GRACE, NOT_TRIGGERED))
    new_last = int(succ_arr[-1]) if len(succ_arr) else None
    return states, new_last


def _stateful(grace_us: int, op: str, threshold: float):
    def run(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("tick", kind="stable")
        last = state.get[0] if state.exists else None
        us = pdf["tick"].to_numpy(dtype="datetime64[us]").astype(np.int64)
        states, new_last = evaluate_ticks(us, pdf["value"].to_numpy(dtype=float), last, grace_us, op, threshold)
        if new_last is not None:
            state.update((new_last,))
        yield pd.DataFrame({"alert": pdf["alert"].to_numpy(), "tick": pdf["tick"].to_numpy(),
                            "value": pdf["value"].to_numpy(), "state": states})
    return run


def alert_state_stream(ticks: DataFrame, grace_seconds: float, op: str = ">", threshold: float = 0.0,
                       active: DataFrame | None = None) -> DataFrame:
    """Streaming ``(alert, tick, value, state)``; inactive alerts are dropped by a stream-static semi join."""
    if active is not None:
        ticks = ticks.join(active.filter("active").select("alert"), on="alert", how="left_semi")
    grace_us = int(round(grace_seconds * 1_000_000))
    return (ticks.select("alert", "tick", "value").groupBy("alert")
            .applyInPandasWithState(_stateful(grace_us, op, threshold), OUTPUT, STATE, "append",
                                    GroupStateTimeout.NoTimeout))
