"""Cleaning of a stream of measurements: repeated times averaged, gaps filled, with bounded state for each series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridtide.functions.calendar import micros

# State with maps, lists and timers is kept in this store (fixed value).
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Cleaner(StatefulProcessor):
    """Of one series: times that may still get readings, the last known value, and times that wait for the next one."""

    def __init__(self, keys: list[str], wait_ms: int):
        self.keys, self.wait_ms = keys, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        long = lambda name: T.StructField(name, T.LongType())
        self.open = handle.getMapState("open", T.StructType([long("u")]), T.StructType([T.StructField("total", T.DoubleType()), long("known")]))
        self.last = handle.getValueState("last", T.StructType([long("u"), T.StructField("v", T.DoubleType())]))
        self.waiting = handle.getListState("waiting", T.StructType([long("u")]))
        self.done = handle.getValueState("done", T.StructType([long("u")]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = self.done.get()[0] if self.done.exists() else None
        first = None
        for batch in rows:
            # By place: the worker may not know the columns' names.
            for u, part in batch.iloc[:, -1].groupby(batch.iloc[:, -2]):
                u = int(u)
                if done is not None and u <= done:
                    continue  # later than the lateness allows
                total, known = self.open.getValue((u,)) if self.open.containsKey((u,)) else (0.0, 0)
                self.open.updateValue((u,), (float(total) + float(part.sum()), int(known) + int(part.count())))
                first = u if first is None else min(first, u)
        if first is not None:
            self._wake(first // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        out: list[tuple[int, float | None, bool]] = []
        times = sorted(int(k[0]) for k in self.open.keys())
        due = [u for u in times if u // 1000 < now]
        waiting = [int(r[0]) for r in self.waiting.get()]
        last = self.last.get() if self.last.exists() else None
        for u in due:
            total, known = self.open.getValue((u,))
            self.open.removeKey((u,))
            if not known:
                waiting.append(u)
                continue
            v = float(total) / int(known)
            for w in waiting:
                out.append((w, v if last is None else float(last[1]) + (v - float(last[1])) * (w - int(last[0])) / (u - int(last[0])), True))
            waiting, last = [], (u, v)
            out.append((u, v, False))
        # Nothing came for too long: the last known value is kept, or the gap stays where there is none.
        given_up = [w for w in waiting if w // 1000 + self.wait_ms < now]
        out += [(w, float(last[1]) if last else None, True) for w in given_up]
        waiting = [w for w in waiting if w // 1000 + self.wait_ms >= now]
        if due:
            self.done.update((due[-1],))
        if last:
            self.last.update(last)
        self.waiting.clear()
        if waiting:
            self.waiting.put([(w,) for w in waiting])
        rest = [u for u in times if u // 1000 >= now]
        wakes = [u // 1000 + 1 for u in rest[:1]] + [w // 1000 + self.wait_ms + 1 for w in waiting[:1]]
        if wakes:
            self._wake(min(wakes), now)
        if out:
            table = pd.DataFrame({k: [v] * len(out) for k, v in zip(self.keys, key)})
            table["_u"], table["load"], table["filled"] = [u for u, _, _ in out], pd.array([v for _, v, _ in out], dtype="Float64"), [f for _, _, f in out]
            yield table

    def _wake(self, at: int, now: int = -1) -> None:
        """One timer at a time, the earliest; those up to `now` have gone off already."""
        timers = [int(t[0] if isinstance(t, (tuple, list)) else t) for t in self.handle.listTimers()]
        timers = [t for t in timers if t > now]
        if timers and min(timers) <= at:
            return
        for t in timers:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def clean_stream(stream: DataFrame, keys: Sequence[str] = (), lateness: str = "1 hour", wait_hours: float = 24.0, value: str = "load") -> DataFrame:
    """`keys…, timestamp, load, filled` in append mode: what cleaning a table gives, as soon as it is final.

    Readings of one time are averaged once the watermark (the latest time less `lateness`) has passed it. A time whose readings are all unknown waits
    for the next known value and is then filled linearly in time (before the first known value: by that value). If none comes within `wait_hours` of the
    watermark, it keeps the last known value. State per series: the times within the lateness, those that wait, and one value. Rows without a time are left out;
    readings later than the lateness are dropped. Watermarks need zoned timestamps, so wall-clock times are read in the
    session time zone, which must be UTC. The state store of the session is set to the one that keeps maps and timers.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    names = list(keys)
    timed = stream.select(*names, F.col("timestamp").cast("timestamp").alias("_t"), micros("timestamp").alias("_u"), F.col(value).cast("double").alias("_v")).filter("_t IS NOT NULL")
    if not names:
        timed, names = timed.select(F.lit(1).alias("_all"), "*"), ["_all"]
    schema = T.StructType([timed.schema[k] for k in names] + [T.StructField("_u", T.LongType()), T.StructField("load", T.DoubleType()), T.StructField("filled", T.BooleanType())])
    cleaner = Cleaner(names, int(wait_hours * 3_600_000))
    rows = timed.withWatermark("_t", lateness).groupBy(*names).transformWithStateInPandas(cleaner, schema, "Append", "EventTime")
    return rows.select(*keys, F.timestamp_micros("_u").cast("timestamp_ntz").alias("timestamp"), "load", "filled")
