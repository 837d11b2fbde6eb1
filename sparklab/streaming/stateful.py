"""Sessions by a custom stateful operator with event-time timers.

``sessions`` debounces arrivals like ``debounce_stream``, and counts a repeated event once: the state of a key is the list
of its open sessions and the ids of the events in them.  A row joins, extends or bridges open sessions, also when it is
late or out of order within the watermark; a timer at the earliest end of a session (last event plus gap) emits those
that the watermark has passed and forgets their ids.  So a key's state holds what lies between the watermark and now, and
a key without open sessions has none.  A late row that comes after its session has been emitted begins a session of its
own if it is within the watermark, and is dropped otherwise, as by Spark's session windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "session_start timestamp, session_end timestamp, arrivals long, duplicates long"


def merged(opened: list[tuple[int, int, list[str], int]], at: int, event: str, gap: int) -> list[tuple[int, int, list[str], int]]:
    """Open sessions (first, last, event ids, repeats) with one more event: it joins all sessions nearer than ``gap``."""
    near = [s for s in opened if s[0] - gap < at < s[1] + gap]
    rest = [s for s in opened if s not in near]
    ids = [e for s in near for e in s[2]]
    again = sum(s[3] for s in near)
    if event in ids:  # a repeat neither counts nor moves the session
        return sorted(rest + ([(min(s[0] for s in near), max(s[1] for s in near), ids, again + 1)] if len(near) == 1 else [(s[0], s[1], s[2], s[3] + (event in s[2])) for s in near]))
    return sorted(rest + [(min([at, *(s[0] for s in near)]), max([at, *(s[1] for s in near)]), [*ids, event], again)])


class Sessions(StatefulProcessor):
    """Open sessions of a key; times and gap in microseconds, timers (the engine's) in milliseconds."""

    def __init__(self, gap: int, key_name: str):
        self.gap, self.key_name = gap, key_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first array<long>, last array<long>, ids array<array<string>>, again array<long>")

    def _get(self) -> list[tuple[int, int, list[str], int]]:
        state = self.open.get() if self.open.exists() else None
        return [] if state is None else [(int(a), int(b), list(i), int(r)) for a, b, i, r in zip(*state)]

    def _put(self, opened: list[tuple[int, int, list[str], int]]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if opened:
            self.open.update(tuple(list(x) for x in zip(*opened)))
            self.handle.registerTimer(-(-(min(s[1] for s in opened) + self.gap) // 1000))
        else:
            self.open.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        opened = self._get()
        for pdf in rows:
            for at, event in sorted(zip(pdf["at"].tolist(), pdf["event"].astype(str).tolist())):
                opened = merged(opened, int(at), event, self.gap)
        self._put(opened)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        opened = self._get()
        done = [s for s in opened if s[1] + self.gap <= now]
        self._put([s for s in opened if s[1] + self.gap > now])
        if done:
            yield pd.DataFrame({self.key_name: [key[0]] * len(done), "session_start": [pd.Timestamp(s[0], unit="us") for s in done],
                                "session_end": [pd.Timestamp(s[1] + self.gap, unit="us") for s in done], "arrivals": [len(s[2]) for s in done], "duplicates": [s[3] for s in done]})

    def close(self) -> None:
        pass


def sessions(stream: DataFrame, key: str, ts: str, event: str, gap_seconds: int = 1800, watermark: str = "1 hour") -> DataFrame:
    """Streaming sessions of each key (not NULL): ``key``, session_start, session_end (last event plus the gap), arrivals
    (different ``event`` ids) and duplicates.  Needs the RocksDB state store (``use_rocksdb``)."""
    s = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, F.col(ts).cast("timestamp").alias("_ts"), F.col(event).cast("string").alias("event"))
    s = s.withWatermark("_ts", watermark).withColumn("at", F.unix_micros("_ts"))
    kind = f"`{key}` {stream.schema[key].dataType.simpleString()}, {OUT}"
    return s.groupBy(key).transformWithStateInPandas(Sessions(gap_seconds * 1_000_000, key), kind, "Append", "EventTime")


def use_rocksdb(spark) -> None:
    """The state store that custom stateful operators need, for the session's next queries."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
