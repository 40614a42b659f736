"""Streams with a memory by key: as-of fill and gap alarms, by event-time timers.

Both hold what a key still needs and no more: the fill its labels since the last one
before the watermark and the times that wait; the alarm its last time.  State is kept
in RocksDB (``configure``) and comes back after a restart from the checkpoint.  Rows
later than the watermark never reach the state; ``late_rows`` counts them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MS = 1000


def configure(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class AsofFill(StatefulProcessor):
    """Each waiting time is told once the watermark has passed it, with the value of the greatest label at or before it."""

    def __init__(self, key: str, value: str) -> None:
        self.key, self.value = key, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.labels = handle.getMapState("labels", "at long", "value double")
        self.waiting = handle.getMapState("waiting", "at long", "rows long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for at, value, fine in zip(frame["at_ms"].tolist(), frame[self.value], frame["wanted"], strict=True):
                if fine:
                    held = self.waiting.getValue((at,)) if self.waiting.containsKey((at,)) else (0,)
                    self.waiting.updateValue((at,), (held[0] + 1,))
                    self.handle.registerTimer(at)
                else:
                    self.labels.updateValue((at,), (None if pd.isna(value) else float(value),))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if not self.waiting.containsKey((at,)):
            return
        many = self.waiting.getValue((at,))[0]
        self.waiting.removeKey((at,))
        told = [(k[0], v[0]) for k, v in self.labels.iterator() if k[0] <= at]
        label, value = max(told, key=lambda x: x[0]) if told else (None, None)
        # timers may come in any order, so a label goes only when the first waiting time is past the next one
        first = min((k[0] for k in self.waiting.keys()), default=at)
        for old, _ in told:
            if old < label and first >= label:
                self.labels.removeKey((old,))
        yield pd.DataFrame({self.key: [key[0]] * many, "at_ms": [at] * many, self.value: pd.array([value] * many, dtype="Float64")})

    def close(self) -> None:
        pass


class GapAlarm(StatefulProcessor):
    """An alarm when the watermark passes a key's last time by more than a limit; rows after it start anew."""

    def __init__(self, key: str, limit_seconds: int) -> None:
        self.key, self.limit = key, limit_seconds * MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        newest = max((int(t) for frame in rows for t in frame["at_ms"]), default=None)
        before = self.last.get()[0] if self.last.exists() else None
        if newest is not None and (before is None or newest > before):
            if before is not None:
                self.handle.deleteTimer(before + self.limit)
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.limit)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        yield pd.DataFrame({self.key: [key[0]], "last_ms": [last], "limit_seconds": [self.limit // MS]})

    def close(self) -> None:
        pass


def _kind(df: DataFrame, key: str) -> str:
    return dict(df.dtypes)[key]


def asof_fill(fine: DataFrame, coarse: DataFrame, key: str, value: str, time: str = "time", late: str = "2 days") -> DataFrame:
    """key, time and value of the rows of a stream of times, filled from a stream of labels; the batch operator is ``operators.time.asof``.

    A row comes out when the watermark has passed it, so labels may arrive after the
    times that they fill, up to ``late``.
    """
    at = F.col(time).cast("timestamp")
    a = fine.select(key, at.alias(time), F.unix_millis(at).alias("at_ms"), F.lit(None).cast("double").alias(value), F.lit(True).alias("wanted"))
    b = coarse.select(key, at.alias(time), F.unix_millis(at).alias("at_ms"), F.col(value).cast("double").alias(value), F.lit(False).alias("wanted"))
    both = a.unionByName(b).withWatermark(time, late)
    told = both.groupBy(key).transformWithStateInPandas(AsofFill(key, value), StructType.fromDDL(f"`{key}` {_kind(fine, key)}, at_ms long, `{value}` double"), "append", "EventTime")
    return told.select(key, F.timestamp_millis("at_ms").alias(time), value)


def gap_alarms(stream: DataFrame, key: str, limit_seconds: int, time: str = "time", late: str = "2 days") -> DataFrame:
    """key, last, limit_seconds: keys of which nothing came for longer than the limit, by the clock of the stream's own times."""
    at = F.col(time).cast("timestamp")
    stamped = stream.select(key, at.alias(time), F.unix_millis(at).alias("at_ms")).withWatermark(time, late)
    told = stamped.groupBy(key).transformWithStateInPandas(GapAlarm(key, limit_seconds), StructType.fromDDL(f"`{key}` {_kind(stream, key)}, last_ms long, limit_seconds long"), "append", "EventTime")
    return told.select(key, F.timestamp_millis("last_ms").alias("last"), "limit_seconds")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has kept out of the state, over the progress that the query remembers."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
