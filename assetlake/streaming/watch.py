"""Watching upstream sources: what changed per material, and which sources have fallen silent."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

WATCH_OUT = "source string, id string, snapshot bigint, digest string, change string"
STATUS_OUT = "source string, status string, at timestamp"
DAY_MS = 24 * 3600 * 1000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers and expiry needs this store; queries that run already keep theirs.

    Spark also runs a processor in a worker on the driver that has no shipped files, so processors of
    this module travel by value.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class MaterialWatch(StatefulProcessor):
    """Newest snapshot and digest of one material, and a timer that drops them."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "digest string, seen long, at long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        digest, seen, at = (self.last.get() if self.last.exists() else None) or (None, None, None)
        if at is not None:
            self.handle.deleteTimer(at + self.keep_ms)
        for row in sorted(rows, key=lambda r: r.snapshot):
            if seen is not None and row.snapshot <= seen:
                change = "late"
            elif seen is None or row.ms - at > self.keep_ms:
                change = "new"
            else:
                change = "unchanged" if digest == row.digest else "changed"
            if change != "late":
                digest, seen, at = row.digest, row.snapshot, row.ms
            yield Row(source=row.source, id=row.id, snapshot=row.snapshot, digest=row.digest, change=change)
        self.last.update((digest, seen, at))
        self.handle.registerTimer(at + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter([])


def watch_stream(listing: DataFrame, keep_ms: int = 400 * DAY_MS, ts: str = "ts") -> DataFrame:
    """new / changed / unchanged / late per sighting of (source, id, snapshot, digest, ts).

    The state holds the newest snapshot and its digest per material; a snapshot that is not newer
    comes late and changes nothing. A material that was not met for ``keep_ms``, by the times of the rows, is
    new again, and a timer drops its state once no row can come that would still need it.
    Materials are independent of each other, so a source that is down only stops sending. Removal
    is found by ``removed_materials``, silence by ``source_status``.
    """
    use_rocksdb(listing.sparkSession)
    rows = listing.select("source", "id", "snapshot", "digest", F.col(ts).cast("timestamp").alias("ts"))
    rows = rows.withWatermark("ts", f"{keep_ms} milliseconds").withColumn("ms", F.unix_millis("ts"))
    return rows.groupBy("source", "id").transformWithState(MaterialWatch(keep_ms), WATCH_OUT, "Append", "EventTime")


class SourceWatch(StatefulProcessor):
    """Last sign of one source, and a timer that reports it as down."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, down boolean")

    def _row(self, source: str, status: str, at_ms: int) -> Row:
        return Row(source=source, status=status, at=pd.Timestamp(at_ms, unit="ms").to_pydatetime())

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        at, down = self.last.get() if self.last.exists() else (None, True)
        if not down:
            self.handle.deleteTimer(at + self.silence_ms)
        for now in sorted({r.ms for r in rows}):
            if at is not None and now <= at:
                continue
            if not down and now - at > self.silence_ms:  # it was silent in between
                yield self._row(key[0], "down", at + self.silence_ms)
                down = True
            if down:
                yield self._row(key[0], "up", now)
            at, down = now, False
        self.last.update((at, down))
        if not down:
            self.handle.registerTimer(at + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        at, _ = self.last.get()
        self.last.update((at, True))
        yield self._row(key[0], "down", at + self.silence_ms)


def source_status(listing: DataFrame, silence_ms: int = DAY_MS, ts: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """up / down per source of a stream of (source, ts, …): down when it sent nothing for ``silence_ms``.

    A source that is down takes nothing out of any listing. Time is that of the rows: the timer of a
    silent source runs out when the others have moved on. Tasks pass on each time of a source once, so
    a source with most of the rows is no more work than the others.
    """
    use_rocksdb(listing.sparkSession)

    def signs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.drop_duplicates()

    rows = listing.select("source", F.col(ts).cast("timestamp").alias("ts"))
    once = rows.mapInPandas(signs, "source string, ts timestamp").withWatermark("ts", delay)
    once = once.withColumn("ms", F.unix_millis("ts"))
    return once.groupBy("source").transformWithState(SourceWatch(silence_ms), STATUS_OUT, "Append", "EventTime")


def removed_materials(sightings: DataFrame, complete: DataFrame) -> DataFrame:
    """Materials missing from the newest complete snapshot of their source.

    ``complete``: (source, snapshot) markers. A source without one removes nothing.
    """
    newest = complete.groupBy("source").agg(F.max("snapshot").alias("newest"))
    seen = sightings.groupBy("source", "id").agg(F.max("snapshot").alias("last_seen"))
    return (
        seen.join(newest, "source")
        .filter("last_seen < newest")
        .select("source", "id", "last_seen")
    )
