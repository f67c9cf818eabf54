"""The rate limiter on a stream: state per account is the passed events of the last window, until it can matter no more."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txguard.operators.velocity import MICROS, decide, micros

OUTPUT = "key string, at long, n long, allowed long"
STATE = "at array<long>, passed array<long>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Limiter(StatefulProcessor):
    """Decides the instants of an account; a timer at the end of its last window clears what is left of it."""

    def __init__(self, limit: int, window: int):
        self.limit, self.window = limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recent = deque(zip(*self.recent.get())) if self.recent.exists() else deque()
        arrived = pd.concat([batch["at"].value_counts() for batch in rows]).groupby(level=0).sum().sort_index()
        at, n = arrived.index.to_numpy("int64"), arrived.to_numpy("int64")
        allowed, _ = decide(recent, at, n, self.limit, self.window)
        if recent:
            self.recent.update(([moment for moment, _ in recent], [passed for _, passed in recent]))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # An event right at the end of the window does not see its start any more.
            self.handle.registerTimer(-(-(recent[-1][0] + self.window) // 1000))
        yield pd.DataFrame({"key": key[0], "at": at, "n": n, "allowed": allowed})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def limit_stream(stream: DataFrame, key: str, ts: str, limit: int = 100, window_seconds: int = 60,
                 lateness: str = "1 hour") -> DataFrame:
    """Rows ``(key, at, n, allowed)`` for the instants of each micro-batch, decided in time order.

    An account keeps at most ``limit`` instants, in the RocksDB store, and is forgotten as soon as the watermark, ``lateness``
    behind the newest event, passes the end of its last window: the state grows with the accounts active lately, not with all
    that ever were. An event older than the watermark is dropped, since what it was to be judged by may be gone; one older
    than the newest already decided for its account is judged against the state as it then is. Rows without a time get no
    verdict; those without an account count as one account. Events of one instant must arrive in one micro-batch.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = stream.select(F.col(key).cast("string").alias("key"), micros(ts).alias("at")).where("at IS NOT NULL")
    # The watermark counts as the instants do, whatever the session's time zone.
    timed = timed.withColumn("event_time", F.timestamp_micros("at")).withWatermark("event_time", lateness)
    return timed.groupBy("key").transformWithStateInPandas(
        Limiter(limit, window_seconds * MICROS), OUTPUT, "append", "eventTime")
