"""Structured Streaming forms: time windows, session windows, START/END sessions, deduplication, incremental tables.

State is bounded by the watermark: windows and sessions that it has passed leave the store. Tables that a stream keeps up are changed by
foreachBatch through a VersionedTable: a micro-batch rewrites only the partitions that it touches, and one that comes again after
a restart changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from edutide.sources.versioned import VersionedTable

EPOCH, MICROSECOND = datetime(1970, 1, 1, tzinfo=timezone.utc), timedelta(microseconds=1)

#: Values in state with timers need this store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def by_time(events: DataFrame, duration: str, slide: str | None = None, late: str = "10 minutes", keys: list[str] | None = None) -> DataFrame:
    """Counts and sums by tumbling or sliding window; rows later than the watermark are left out."""
    w = F.window("ts", duration, slide) if slide else F.window("ts", duration)
    return events.withWatermark("ts", late).groupBy(w, *(keys or [])).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), *(keys or []), "n", "value")


def by_session(events: DataFrame, gap: str, late: str = "10 minutes", key: str = "user_id") -> DataFrame:
    """Sessions of a key that end after a gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


class StartEnd(StatefulProcessor):
    """Sessions of a key from a START row to an END row. A START closes what is open before it, an END closes after it, and so does a
    pause longer than timeout_ms: at the next row, or by a timer once the watermark is past it. Keys are dealt into buckets, so that
    state is read and written once for many keys and not in several calls for each. In a bucket's state: rows, first and last time of
    each open session, and the timer of the earliest one. A micro-batch's rows are put in order of time; across micro-batches they must
    come in order."""

    def __init__(self, key: str, kind: str, tie: str, start: str, end: str, timeout_ms: int):
        self.names, self.kinds, self.timeout = (key, kind, tie), (start, end), timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "keys array<long>, n array<long>, first_ms array<long>, last_ms array<long>, timer_ms long")
        self.session = Row(self.names[0], "n", "first_ms", "last_ms", "closed_by")

    def _open(self) -> tuple[dict, int]:
        """Key -> rows, first and last time of the bucket's open sessions; and its timer, or 0."""
        found = self.open.get()
        return ({}, 0) if not found else ({k: s for k, *s in zip(*found[:4])}, found[4])

    def _keep(self, open_: dict, timer: int, fired: bool = False) -> None:
        # One more millisecond: a row just `timeout` later still belongs to its session.
        due = min(last for _, _, last in open_.values()) + self.timeout + 1 if open_ else 0
        if timer and timer != due and not fired:
            self.handle.deleteTimer(timer)
        if due and timer != due:
            self.handle.registerTimer(due)
        if open_:
            self.open.update((list(open_), *(list(c) for c in zip(*open_.values())), due))
        elif timer:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        open_, timer = self._open()
        name, kind, tie = self.names
        start, end = self.kinds
        batch = [((r["ts"] - EPOCH) // MICROSECOND, r[tie] is None, r[tie], r[name], r[kind]) for r in rows]
        batch.sort(key=lambda r: r[:3])
        closed = []
        for us, _, _, who, what in batch:
            ms = us // 1000
            n, first, last = open_.get(who, (0, 0, 0))
            if n and ms - last > self.timeout:
                closed.append((who, n, first, last, "pause"))
                n = 0
            if n and what == start:
                closed.append((who, n, first, last, "start"))
                n = 0
            open_[who] = (n + 1, first if n else ms, ms)
            if what == end:
                closed.append((who, *open_.pop(who), "end"))
        self._keep(open_, timer)
        return iter([self.session(*s) for s in closed])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        open_, timer = self._open()
        passed = timerValues.getCurrentWatermarkInMs() - self.timeout
        closed = [(who, *s) for who, s in open_.items() if s[2] < passed]
        self._keep({who: s for who, s in open_.items() if s[2] >= passed}, timer, fired=True)
        for s in closed:
            yield self.session(*s, "pause")

    def close(self) -> None:
        pass


def start_end_sessions(events: DataFrame, key: str = "user_id", kind: str = "event_type", tie: str = "event_id", start: str = "signup", end: str = "purchase", timeout_ms: int = 1_800_000, late: str = "10 minutes", buckets: int = 256) -> DataFrame:
    """Key (a long), n, first_ms, last_ms, closed_by (start, end or pause) of each session; append mode. The session needs the
    state store ROCKSDB. A task holds a bucket's rows of a micro-batch and its open sessions, so buckets should grow with keys; a
    stream keeps the number that it began with."""
    rows = events.withWatermark("ts", late).select(F.pmod(F.hash(key), F.lit(buckets)).alias("_bucket"), key, "ts", tie, kind)
    schema = f"{key} long, n long, first_ms long, last_ms long, closed_by string"
    return rows.groupBy("_bucket").transformWithState(StartEnd(key, kind, tie, start, end, timeout_ms), schema, "Append", "EventTime")


def deduplicated(events: DataFrame, key: str, late: str = "10 minutes") -> DataFrame:
    """The first row of each key inside the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def replaced(new: DataFrame, old: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of new, and those of old with other keys."""
    if old is None:
        return new
    rows = old.select(*new.columns).withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in new.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_new").alias("_r")) if rest else rows.select(*keys).distinct()
    return out.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*new.columns)


def upsert(table: VersionedTable, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch in update mode: rows of a micro-batch replace those of the table by keys, in the partitions that they touch."""

    def run(batch: DataFrame, epoch: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                table.apply(f"epoch-{epoch}", kept, lambda new, old: replaced(new, old, keys))
        finally:
            kept.unpersist()

    return run


def incremental(add: Callable[[str, DataFrame], object]) -> Callable[[DataFrame, int], None]:
    """T5, for foreachBatch: add(batch name, rows), by which a batch that is in already changes nothing."""

    def run(batch: DataFrame, epoch: int) -> None:
        add(f"epoch-{epoch}", batch)

    return run


def heartbeat(like: DataFrame, values: dict[str, object]) -> DataFrame:
    """One row of nulls but for these values, which moves a watermark on without being anyone's row."""
    return like.sparkSession.createDataFrame([Row(**{c: values.get(c) for c in like.columns})], like.schema)
