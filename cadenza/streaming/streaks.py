"""Chart streaks as streaming state: how many editions in a row a key has been on the chart.

Each key holds its last edition and its streak. A timer one step after that edition clears
the state of a key that the next edition lacks, so what is stored is the chart of one
edition, whatever the number of keys that ever charted.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The state store that keyed timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Streaks(StatefulProcessor):
    """Rows of one key, one for each edition that it is on."""

    def __init__(self, key: str, step_ms: int):
        self.key, self.step = key, step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "ms long, streak int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, streak = self.held.get() if self.held.exists() else (None, 0)
        before = last
        for ms in sorted({r["ms"] for r in rows}):
            if last is not None and ms <= last:
                continue  # late, or read twice
            streak = streak + 1 if last is not None and ms - last == self.step else 1
            last = ms
            yield Row(**{self.key: key[0], "ms": ms, "streak": streak})
        if last is not None and last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.step)
            self.held.update((last, streak))
            self.handle.registerTimer(last + self.step)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The next edition is known and the key was not on it."""
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def streak_stream(entries: DataFrame, key: str, step: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """(key, edition, streak) from a stream of chart entries (key, ``edition`` timestamp).

    A streak goes on where the edition one ``step`` earlier held the key, else it starts at 1,
    as ``charts.next_streaks`` has it from table to table. Editions that arrive together are
    taken in order; one that is not newer than the last one of its key is left out.
    """
    kind = dict(entries.dtypes)[key]
    watched = entries.select(key, "edition", F.unix_millis("edition").alias("ms")).withWatermark("edition", "0 seconds")
    out = watched.groupBy(key).transformWithState(
        statefulProcessor=Streaks(key, int(step.total_seconds() * 1000)),
        outputStructType=f"{key} {kind}, ms long, streak int",
        outputMode="Append",
        timeMode="EventTime",
    )
    return out.select(key, F.timestamp_millis("ms").alias("edition"), "streak")


def use_keyed_timers(spark: SparkSession) -> None:
    """Set the state store that ``streak_stream`` needs, for queries started from now on."""
    spark.conf.set(*STORE)
