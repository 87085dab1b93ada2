"""Alert evaluation on a stream with event-time timers (X2 stream form).

``transformWithStateInPandas``: for each alert the state store holds the time of the last Success (a value) and the
ticks that wait, in slots of ``slot_seconds`` (a map). A tick is put into its slot, and a timer is set for the slot's
end. When the watermark passes it, the slot's ticks are evaluated in time order, given out and forgotten. So

* out-of-order ticks within the watermark's delay come to their place before they are evaluated;
* a tick that the watermark has passed on arrival is given out at once with the state ``Late`` (Spark itself drops and counts those
  that it filters before the state), and never changes the state of others;
* an alert's ticks are taken in batch by batch and evaluated slot by slot, so that the memory of a task is bounded by a slot and an
  Arrow batch, also for an alert that holds a third of all ticks.

It needs the RocksDB state store (``ROCKSDB``), which keeps the state on the executors' disks and its changes in the checkpoint.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hourwise.streaming.alerts import OUTPUT, evaluate_ticks

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
LATE = "Late"


def _ship_by_value() -> None:
    """As in ``streaming.alerts``: the processor travels with the task."""
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()


class AlertTimers(StatefulProcessor):
    def __init__(self, grace_us: int, op: str, threshold: float, slot_us: int):
        self.grace_us, self.op, self.threshold, self.slot_us = grace_us, op, threshold, slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_success", "us long")
        self.waiting = handle.getMapState("waiting", "slot long", "us array<long>, value array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in rows:
            us = pdf["tick"].to_numpy(dtype="datetime64[us]").astype(np.int64)
            value = pdf["value"].to_numpy(dtype=float)
            slot = us // self.slot_us
            late = (slot + 1) * self.slot_us <= passed
            if late.any():
                yield self._rows(key, us[late], value[late], np.full(int(late.sum()), LATE))
            for s in np.unique(slot[~late]).tolist():
                own = slot == s
                old = self.waiting.getValue((s,)) if self.waiting.containsKey((s,)) else ([], [])
                self.waiting.updateValue((s,), ([*old[0], *us[own].tolist()], [*old[1], *value[own].tolist()]))
                self.handle.registerTimer((s + 1) * self.slot_us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # slots are due in order of time, whatever the order in which timers fire
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for s in sorted(k[0] for k in self.waiting.keys() if (k[0] + 1) * self.slot_us <= end):
            us, value = (np.asarray(x) for x in self.waiting.getValue((s,)))
            self.waiting.removeKey((s,))
            order = np.argsort(us, kind="stable")
            us, value = us[order].astype(np.int64), value[order].astype(float)
            last = self.last.get()[0] if self.last.exists() else None
            states, new = evaluate_ticks(us, value, last, self.grace_us, self.op, self.threshold)
            if new is not None:
                self.last.update((new,))
            yield self._rows(key, us, value, states)

    def _rows(self, key, us, value, states) -> pd.DataFrame:
        return pd.DataFrame({"alert": [key[0]] * len(us), "tick": us.astype("datetime64[us]"), "value": value, "state": states})

    def close(self) -> None:
        pass


def alert_states_with_timers(ticks: DataFrame, grace_seconds: float, op: str = ">", threshold: float = 0.0,
                             watermark: str = "1 hour", slot_seconds: int = 3600, active: DataFrame | None = None) -> DataFrame:
    """Streaming ``(alert, tick, value, state)`` of the ticks whose slot the watermark has passed, and of late ones."""
    if active is not None:
        ticks = ticks.join(active.filter("active").select("alert"), on="alert", how="left_semi")
    t = ticks.selectExpr("alert", "tick", "value", "CAST(tick AS TIMESTAMP) AS at").withWatermark("at", watermark)
    processor = AlertTimers(int(round(grace_seconds * 1_000_000)), op, threshold, slot_seconds * 1_000_000)
    return t.groupBy("alert").transformWithStateInPandas(processor, OUTPUT, "Append", "EventTime")
