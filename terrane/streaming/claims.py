"""A queue as a stream with state: ids are handed out to workers once, and come back if they are not done in time.

Events: `add` puts an id in, `ask` takes the newest waiting id for a worker, `done` ends a claim. They come in any number of queues
(`queue`), each of which is state of its own; a busy queue is split by giving its parts names of their own. Within a
micro-batch, the events of a queue count in the order of their time, then add, done, ask, then worker and id. A claim that is
older than `stale` at an `ask`, or when the watermark passes its end, waits again. An id that is known is not added again, done ones
included, and a `done` of an id that is not claimed by that worker has no effect. Asks that find nothing get a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Minutes after which a claim is stale.
STALE = 30
EVENTS = "queue string, at timestamp, kind string, id long, worker string"
CLAIMS = T.StructType([T.StructField("queue", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("worker", T.StringType()), T.StructField("id", T.LongType())])
#: Which of several events of one time goes first.
ORDER = {"add": 0, "done": 1, "ask": 2}
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Queue(StatefulProcessor):
    """Of each queue the ids with the worker and the time of their claim: no worker while they wait, no time once done."""

    def __init__(self, stale: int):
        self.stale = stale * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ids = T.StructType([T.StructField("id", T.LongType())])
        self.waiting = handle.getMapState("waiting", ids, T.StructType([T.StructField("yes", T.BooleanType())]))
        self.claimed = handle.getMapState("claimed", ids, T.StructType([T.StructField("worker", T.StringType()), T.StructField("until", T.LongType())]))
        self.done = handle.getMapState("done", ids, T.StructType([T.StructField("yes", T.BooleanType())]))

    def _released(self, now: int) -> None:
        for (i,), (_, until) in list(self.claimed.iterator()):
            if until <= now:
                self.claimed.removeKey((i,))
                self.waiting.updateValue((i,), (True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows))
        events = events.assign(turn=events["kind"].map(ORDER)).sort_values(["at", "turn", "worker", "id"], kind="stable", na_position="last")
        # The newest waiting id is wanted at every ask, so they are read and sorted once a batch.
        waiting = sorted(i for (i,) in self.waiting.keys())
        out: list[tuple] = []
        for at, kind, i, worker in zip(events["at"], events["kind"], events["id"], events["worker"]):
            now = int(at.timestamp() * 1000)
            if kind == "add" and not pd.isna(i):
                i = int(i)
                if not any(s.containsKey((i,)) for s in (self.waiting, self.claimed, self.done)):
                    self.waiting.updateValue((i,), (True,))
                    waiting = sorted([*waiting, i])
            elif kind == "done" and not pd.isna(i) and self.claimed.containsKey((int(i),)) and self.claimed.getValue((int(i),))[0] == worker:
                self.claimed.removeKey((int(i),))
                self.done.updateValue((int(i),), (True,))
            elif kind == "ask":
                before = len(list(self.claimed.keys()))
                self._released(now)
                if len(list(self.claimed.keys())) != before:
                    waiting = sorted(i for (i,) in self.waiting.keys())
                given = waiting.pop() if waiting else None
                if given is not None:
                    self.waiting.removeKey((given,))
                    self.claimed.updateValue((given,), (worker, now + self.stale))
                    self.handle.registerTimer(now + self.stale)
                out.append((key[0], at, worker, given))
        yield pd.DataFrame({"queue": [x[0] for x in out], "at": [x[1] for x in out], "worker": [x[2] for x in out], "id": pd.array([x[3] for x in out], dtype="Int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._released(expiredTimerInfo.getExpiryTimeInMs())
        return iter(())

    def close(self) -> None:
        pass


def claims(events: DataFrame, stale: int = STALE, late: str = "10 minutes") -> DataFrame:
    """(queue, at, worker, id) of every ask in a stream of events. Events later than `late` may be dropped by Spark. The session's
    state store must be RocksDB (`PROVIDER`)."""
    stream = events.withWatermark("at", late).where(F.col("kind").isin(*ORDER))
    return stream.groupBy("queue").transformWithStateInPandas(Queue(stale), CLAIMS, "Append", "EventTime")
