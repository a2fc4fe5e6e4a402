"""Rate limits: the same rules as a batch pass and as a stream with keyed state.

Fixed window: a key's window starts at its first request and ends after the window's length; the next
request opens another.  Sliding log: a request counts those allowed in the last window; rejected ones are
not recorded.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key long, event_id long, allowed boolean, remaining int"


class Fixed:
    """State: start of the window and requests in it."""

    def __init__(self, limit: int, window_us: int, start: int | None = None, count: int = 0):
        self.limit, self.window_us, self.start, self.count = limit, window_us, start, count

    def __call__(self, at: int) -> tuple[bool, int]:
        if self.start is None or at - self.start >= self.window_us:
            self.start, self.count = at, 1
        else:
            self.count += 1
        return self.count <= self.limit, max(0, self.limit - self.count)


class Sliding:
    """State: times of the requests allowed in the last window, ``limit`` at most."""

    def __init__(self, limit: int, window_us: int, log: tuple[int, ...] = ()):
        self.limit, self.window_us, self.log = limit, window_us, deque(log)

    def __call__(self, at: int) -> tuple[bool, int]:
        while self.log and self.log[0] < at - self.window_us:
            self.log.popleft()
        if len(self.log) >= self.limit:
            return False, 0
        self.log.append(at)
        return True, self.limit - len(self.log)


def limited(events: DataFrame, key: str, event: str, ts: str, rule: Callable[[], Fixed | Sliding]) -> DataFrame:
    """Every request with whether it is allowed, in the order of time and event id.

    Rows of a key are sorted inside their partition and streamed; a task holds one key's small state.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, rule()
        for pdf in batches:
            allowed, remaining = [], []
            for k, at in zip(pdf["key"], pdf["at"], strict=True):
                if k != key:
                    key, state = k, rule()
                ok, left = state(int(at))
                allowed.append(ok)
                remaining.append(left)
            yield pd.DataFrame({"key": pdf["key"], "event_id": pdf["event_id"], "allowed": allowed, "remaining": remaining})

    rows = events.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(event).cast("long").alias("event_id"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    return rows.repartition("key").sortWithinPartitions("key", "at", "event_id").mapInPandas(run, OUT)


def limited_stream(events: DataFrame, key: str, event: str, ts: str, kind: type, limit: int, window_us: int, late: str = "1 hour") -> DataFrame:
    """The same over a stream, with state that outlives micro-batches.

    Requests later than ``late`` are dropped.  A key idle for a window's length, by event time, would begin anew
    anyway, so its state goes then.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get[0]) if state.exists else []
        if kind is Fixed:
            rule = Fixed(limit, window_us, *[int(v) for v in held])
        else:
            rule = Sliding(limit, window_us, tuple(int(v) for v in held))
        rows = pd.concat(list(batches)).sort_values(["at", "event_id"])  # one key's rows of one micro-batch
        results = [rule(int(at)) for at in rows["at"]]
        state.update(([rule.start, rule.count] if kind is Fixed else list(rule.log),))
        state.setTimeoutTimestamp((int(rows["at"].max()) + window_us) // 1000 + 1)
        yield pd.DataFrame({"key": rows["key"].tolist(), "event_id": rows["event_id"].tolist(), "allowed": [r[0] for r in results], "remaining": [r[1] for r in results]})

    rows = events.where(F.col(key).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(event).cast("long").alias("event_id"), F.unix_micros("_ts").alias("at"), "_ts")
    return rows.groupBy("key").applyInPandasWithState(step, OUT, "held array<long>", "append", GroupStateTimeout.EventTimeTimeout)
