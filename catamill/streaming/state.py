"""Streams whose state lives in a state store by key, with timers: stopping of dry searches, and holes that come due again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """State of single keys needs a store that reads and writes them one by one."""
    spark.conf.set(PROVIDER, ROCKS)


def _in_order(rows: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    """The rows that one batch brings for a key, in order."""
    return pd.concat(list(rows)).sort_values(by, kind="stable")


class YieldStop(StatefulProcessor):
    """Per group: the first search at which `floor` are done and the last `window` brought no key that is new.

    Each key that was seen is an entry of its own, so that a batch reads and writes its own keys alone, and all go once
    the group has stopped."""

    def __init__(self, floor: int, window: int):
        self.floor, self.window = max(1, floor), window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "first long")
        self.run = handle.getValueState("run", "searches long, dry long, stopped boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        searches, dry, stopped = self.run.get() if self.run.exists() else (0, 0, False)
        if stopped:
            for _ in rows:
                pass
            return
        for seq, own in _in_order(rows, "seq").groupby("seq", sort=True):
            fresh = False
            for k in own["key"].dropna().unique():
                if not self.seen.containsKey((k,)):
                    self.seen.updateValue((k,), (int(seq),))
                    fresh = True
            searches, dry = searches + 1, 0 if fresh else dry + 1
            if searches >= self.floor and dry >= self.window:
                self.seen.clear()
                self.run.update((searches, dry, True))
                yield pd.DataFrame({"group": [key[0]], "stop_at": [int(seq)]})
                return
        self.run.update((searches, dry, False))


def saturation_states(events: DataFrame, floor: int, window: int) -> DataFrame:
    """events: group, seq, key (text); a search may have several rows, or one with a null key, and all of a search in one
    batch. Emits group, stop_at once where a group runs dry; operators.monitor.saturation is its batch form."""
    return events.groupBy("group").transformWithStateInPandas(statefulProcessor=YieldStop(floor, window), outputStructType="group string, stop_at long", outputMode="Append", timeMode="None")


class HoleStates(StatefulProcessor):
    """Per hole: its attempts so far, its status, and when it was searched last. A timer makes it `due` again when its time
    to live is over; attempts stay, as an exhausted hole does not begin anew."""

    def __init__(self, exhausted_at: int, days: int, exhausted_days: int):
        self.exhausted_at, self.days, self.exhausted_days = exhausted_at, days, exhausted_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "attempts long, status string, searched_at timestamp")

    def _row(self, key, attempts, status, at) -> pd.DataFrame:
        return pd.DataFrame({"hole_id": [key[0]], "searched_at": [at], "attempts": [attempts], "status": [status]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        attempts, status, last = self.state.get() if self.state.exists() else (0, "new", None)
        for ts, variants, found in _in_order(rows, "ts")[["ts", "variants", "found"]].itertuples(index=False):
            attempts += int(variants)
            if last is None or ts >= last:
                status, last = ("filled" if found else "exhausted" if attempts >= self.exhausted_at else "searched"), ts.to_pydatetime()
        self.state.update((attempts, status, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        rests = self.exhausted_days if status == "exhausted" else self.days
        due = int(last.timestamp() * 1000) + rests * 86_400_000
        self.handle.registerTimer(max(due, timerValues.getCurrentWatermarkInMs() + 1))
        yield self._row(key, attempts, status, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempts, _, last = self.state.get()
        yield self._row(key, attempts, "due", last)


def hole_due_states(attempts: DataFrame, late: str = "1 hour", exhausted_at: int = 6, days: int = 7, exhausted_days: int = 60) -> DataFrame:
    """attempts: hole_id, ts, variants, found. Emits each hole's state when it changes, and `due` when it may be searched
    again; the batch forms are operators.monitor.hole_states and searchable."""
    schema = "hole_id long, searched_at timestamp, attempts long, status string"
    return attempts.withWatermark("ts", late).groupBy("hole_id").transformWithStateInPandas(
        statefulProcessor=HoleStates(exhausted_at, days, exhausted_days), outputStructType=schema, outputMode="Update", timeMode="EventTime"
    )
