"""Gridding of trips whose points arrive in pieces, over many files and batches.

Time gaps and trimming need a whole trip. So points wait in keyed state until their trip is closed: when the watermark has
passed its last point by `idle`, an event-time timer fires, the points go on together and the trip's state shrinks to
a mark. Each batch of closed trips is then gridded like a table. What comes for a closed trip is ignored, as for
stored trips elsewhere. State, timers and the batches already written survive a restart by the checkpoint; a batch that is repeated replaces
its own folder.

Defined results: points older than the watermark are dropped by Spark; a point without a time waits with its trip, and doesn't
move the timer; a trip of such points alone never closes; what is open at the end stays in the state.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from halyard.operators.tracks import grid_tracks
from halyard.schemas import POINTS, struct

#: State store that keeps timers and lists; set it before the session's first stream.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_KEPT = struct("Time bigint, Lat double, Lng double, Speed double, Range double, Heading double, seq bigint")
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def _micros(time: datetime | None) -> int | None:
    if time is None:
        return None
    return ((time if time.tzinfo else time.replace(tzinfo=UTC)) - _EPOCH) // timedelta(microseconds=1)


class Hold(StatefulProcessor):
    """Keeps a trip's points until it's closed."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getListState("points", _KEPT)
        self.mark = handle.getValueState("mark", struct("timer bigint, closed bigint"))

    def handleInputRows(self, key, rows, timerValues):
        before = self.mark.get() if self.mark.exists() else (None, 0)
        fresh = [(_micros(r[1]), *r[2:8]) for r in rows]
        if before[1] or not fresh:
            return iter(())
        self.points.appendList(fresh)
        last = max((f[0] for f in fresh if f[0] is not None), default=None)
        due = None if last is None else last // 1000 + self.idle_ms
        if due is not None and (before[0] is None or due > before[0]):
            if before[0] is not None:
                self.handle.deleteTimer(before[0])
            self.handle.registerTimer(due)
            self.mark.update((due, 0))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rows = list(self.points.get())
        self.points.clear()
        self.mark.update((None, 1))
        names = [f.name for f in POINTS.fields]
        for r in rows:
            time = None if r[0] is None else _EPOCH + timedelta(microseconds=r[0])
            yield Row(**dict(zip(names, (key[0], time, *r[1:]), strict=True)))

    def close(self) -> None:
        pass


def closed_trips(points: DataFrame, idle: timedelta, late: timedelta = timedelta(0)) -> DataFrame:
    """A stream of the points of trips once they are closed, each trip's in one batch."""
    stream = points.select(*[f"`{f.name}`" for f in POINTS.fields]).withWatermark("Time", f"{late // timedelta(milliseconds=1)} milliseconds")
    return stream.groupBy("Trip").transformWithState(Hold(idle // timedelta(milliseconds=1)), POINTS, "append", "eventTime")


def grid_pieces(spark: SparkSession, source: str, target: str, checkpoint: str, idle: timedelta, late: timedelta = timedelta(0), grid_size: int = 500, files_at_once: int = 1000) -> StreamingQuery:
    """Grids the trips that what is new in source closes, appends them to target and stops."""
    if spark.conf.get(STORE[0], None) != STORE[1]:
        spark.conf.set(*STORE)
    points = spark.readStream.schema(POINTS).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", True).parquet(source)

    def each(batch: DataFrame, number: int) -> None:
        grid_tracks(batch, grid_size).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return closed_trips(points, idle, late).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
