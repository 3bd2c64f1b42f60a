"""State that no aggregate expresses: rows in the order of their event time, timers, and the last few values of a key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.counts import start

#: The state store that keeps several variables for a key.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: What a key of the visits holds: its waiting rows, its open visit, the time of its timer.
HELD = "times array<bigint>, ids array<bigint>, kinds array<string>, started bigint, ended bigint, n bigint, last_kind string, timer bigint"
VISIT = "key bigint, started timestamp, ended timestamp, n bigint, last_kind string, reason string"


def _micros(times: pd.Series) -> list[int]:
    return times.astype("datetime64[us]").astype("int64").tolist()


class Visits(StatefulProcessor):
    """Cuts each key's rows, in the order of (time, id), into visits.

    A visit ends with a row of the kind ``last_kind``, or when the next row is more than ``gap`` seconds away. Rows wait until the watermark has passed
    them, as an earlier one may still come; a timer wakes the key when its next row is due or its open visit has gone quiet. State is
    the waiting rows, at most those of one watermark delay, and one row for the open visit. Every call on the state is a round trip, so all of it
    is one value: a key costs one read and one write when rows come, and again when its timer goes off.
    """

    def __init__(self, gap: int, last_kind: str) -> None:
        self.gap, self.last_kind = gap * 1_000_000, last_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def _read(self) -> tuple[list[tuple], tuple | None, int | None]:
        """The waiting rows, the open visit and the time of the timer."""
        found = self.held.get()
        if found is None:
            return [], None, None
        times, ids, kinds, *visit, timer = found
        return list(zip(times, ids, kinds)), None if visit[2] is None else tuple(visit), timer

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, visit, timer = self._read()
        for part in rows:
            waiting += zip(_micros(part["time"]), part["id"].tolist(), part["kind"].tolist())
        self._keep(waiting, visit, timer, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting, visit, _ = self._read()
        waiting.sort()
        due = [row for row in waiting if row[0] <= watermark * 1000]
        done = []
        for time, _, kind in due:
            if visit and time - visit[1] > self.gap:
                done.append((*visit, "gap"))
                visit = None
            visit = (visit[0] if visit else time, time, visit[2] + 1 if visit else 1, kind)
            if kind == self.last_kind:
                done.append((*visit, "last"))
                visit = None
        if visit and watermark * 1000 - visit[1] > self.gap:
            done.append((*visit, "gap"))
            visit = None
        # the timer that has gone off is no longer there to be removed
        self._keep(waiting[len(due) :], visit, None, watermark)
        if done:
            started, ended, *rest = zip(*done)
            times = {name: np.array(of, "datetime64[us]") for name, of in (("started", started), ("ended", ended))}
            yield pd.DataFrame({"key": key[0], **times, **dict(zip(("n", "last_kind", "reason"), rest))})

    def _keep(self, waiting: list[tuple], visit: tuple | None, old: int | None, watermark: int) -> None:
        """Write the state, with one timer: for the earliest waiting row, or for the time when the open visit is over."""
        at = min(row[0] for row in waiting) if waiting else visit[1] + self.gap if visit else None
        new = None if at is None else max(at // 1000 + 1, watermark + 1)
        if new != old and old is not None:
            self.handle.deleteTimer(old)
        if new is None:
            self.held.clear()
            return
        if new != old:
            self.handle.registerTimer(new)
        times, ids, kinds = ([row[i] for row in waiting] for i in range(3))
        self.held.update((times, ids, kinds, *(visit or (None,) * 4), new))


class LastValues(StatefulProcessor):
    """The last ``n`` values of each key by (time, id), whatever order they come in; written anew for the keys of a batch."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "time bigint, id bigint, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = [tuple(r) for r in self.held.get()]
        for part in rows:
            found += zip(_micros(part["time"]), part["id"].tolist(), part["value"].tolist())
            found = sorted(found, key=lambda r: r[:2])[-self.n :]
        self.held.put(found)
        yield pd.DataFrame({"key": [key[0]], "last": [[value for _, _, value in found]]})


def _started(stream: DataFrame, make: Callable[[], DataFrame], out: str, checkpoint: str, mode: str, interval: str | None) -> StreamingQuery:
    """Start what ``make`` gives with the state store it needs; other streams of the session keep theirs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, STORE)
    try:
        # a query works with a copy of the settings it was started under
        return start(make(), checkpoint, write, mode, interval)
    finally:
        conf.set(PROVIDER, before) if before else conf.unset(PROVIDER)


def visits(stream: DataFrame, delay: str, gap: int, last_kind: str, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Finished visits of a stream (key, time, id, kind); a row that the watermark has passed is left out."""

    def make() -> DataFrame:
        grouped = stream.withWatermark("time", delay).groupBy("key")
        return grouped.transformWithStateInPandas(Visits(gap, last_kind), VISIT, "Append", "EventTime")

    return _started(stream, make, out, checkpoint, "append", interval)


def last_values(stream: DataFrame, n: int, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """The last ``n`` values per key of a stream (key, time, id, value); each batch writes the keys it changed."""

    def make() -> DataFrame:
        return stream.groupBy("key").transformWithStateInPandas(LastValues(n), "key bigint, last array<double>", "Update", "None")

    return _started(stream, make, out, checkpoint, "update", interval)
