"""Streams over all events. The events arrive in parts in order of time; a stream runs after each part, from its checkpoint, and takes
it as one micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.operators import facts
from edutide.sources.shared import shared_folder
from edutide.sources.telemetry import TELEMETRY_SQL, read, telemetry
from edutide.sources.versioned import VersionedTable
from edutide.streaming import windows

from .basics import registry
from .usage import DAY

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = registry(QUERIES, SQL)

ARRIVALS = 4


def _folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/edutide/{what}-{uuid.uuid4().hex}"


def arrivals(events: DataFrame, path: str, of: int = ARRIVALS) -> Iterator[int]:
    """Writes parts of the events, cut by time, one after another, each by all tasks that read events, and yields its number once it
    is there."""
    ms = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.select(ms.alias("at")).approxQuantile("at", [i / of for i in range(1, of)], 0.001)
    for i in range(of):
        low = F.lit(True) if i == 0 else ms > F.lit(cuts[i - 1])
        high = F.lit(True) if i == of - 1 else ms <= F.lit(cuts[i])
        events.where(low & high).write.mode("append").parquet(path)
        yield i


def beat(events: DataFrame, path: str) -> None:
    """A last file that brings the watermark past all events, so that what is open is closed and leaves the state."""
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    if last is not None:
        from datetime import timedelta

        windows.heartbeat(events, {"ts": last + timedelta(days=2), "event_id": -1, "user_id": -1, "event_type": "beat"}).write.mode("append").parquet(path)


def source(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """All files that have arrived since the last run, as one micro-batch: files of one part may not fall into two, where the first would
    move the watermark past rows of the second."""
    rows = spark.readStream.schema(events.schema).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run(result: DataFrame, checkpoint: str, mode: str, into: str | Callable[[DataFrame, int], None]):
    """Until all that has arrived is processed; into: a folder, or a function of foreachBatch. Returns the query, which has stopped."""
    sink = result.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    out = sink.format("parquet").option("path", into).start() if isinstance(into, str) else sink.foreachBatch(into).start()
    out.awaitTermination()
    return out


def streamed(spark: SparkSession, events: DataFrame, form: Callable[[DataFrame], DataFrame], mode: str, into: str | Callable[[DataFrame, int], None], closed: bool = False, of: int = ARRIVALS) -> DataFrame:
    """Runs form of the stream after each part of the events; closed: with a beat beside the last part. Returns the streaming frame."""
    path, checkpoint = _folder(spark, "arrivals"), _folder(spark, "checkpoint")
    for i in arrivals(events, path, of):
        if closed and i == of - 1:
            beat(events, path)
        result = form(source(spark, events, path))
        run(result, checkpoint, mode, into)
    return result


@contextmanager
def state_store(spark: SparkSession, provider: str):
    """The session's state store while streams are started in it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@query("t1_time_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2")
def t1(spark: SparkSession, d: str) -> DataFrame:
    """T1 in update mode: each micro-batch brings the windows that changed, and they replace their old rows in the days they are of."""
    table = VersionedTable(spark, _folder(spark, "windows"), ["day"])
    form = lambda rows: windows.by_time(rows, "1 hour", late="1 hour", keys=["event_type"]).withColumn("day", F.date_format("start", "yyyyMMdd"))
    streamed(spark, read(spark, d, "events"), form, "update", windows.upsert(table, ["day", "start", "event_type"]))
    return table.read().select(F.col("start").cast("timestamp_ntz"), "event_type", "n", F.round("value", 2).alias("value"))


@query("t2_session_windows", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS i FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, i""")
def t2(spark: SparkSession, d: str) -> DataFrame:
    """T2 in append mode: sessions are written, and leave the state, when the watermark passes them."""
    out = _folder(spark, "sessions")
    result = streamed(spark, read(spark, d, "events"), lambda rows: windows.by_session(rows, "30 minutes"), "append", out, closed=True)
    found = spark.read.schema(result.schema).parquet(out).where("user_id >= 0")
    return found.select("user_id", F.col("start").cast("timestamp_ntz"), F.col("end").cast("timestamp_ntz"), "n")


@query("t2_start_end_sessions", """WITH g AS (SELECT user_id, event_id, ts, event_type, epoch_us(ts) // 1000 AS ms, lag(event_type) OVER w AS prev, epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) OVER w AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 1800000 OR event_type = 'signup' OR prev = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM g),
s AS (SELECT user_id, i, count(*) AS n, min(ms) AS first_ms, max(ms) AS last_ms, arg_max(event_type, [epoch_us(ts), event_id]) AS last_type FROM c GROUP BY 1, 2)
SELECT user_id, n, first_ms, last_ms, CASE WHEN last_type = 'purchase' THEN 'end'
  WHEN lead(first_ms) OVER w - last_ms > 1800000 OR lead(first_ms) OVER w IS NULL THEN 'pause' ELSE 'start' END AS closed_by FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i)""")
def t2_start_end(spark: SparkSession, d: str) -> DataFrame:
    """Sessions from START to END. The stream stops after each part, and goes on from its checkpoint with the next."""
    events, out = read(spark, d, "events"), _folder(spark, "sessions")
    buckets = max(256, events.count() // 30_000)
    with state_store(spark, windows.ROCKSDB):
        result = streamed(spark, events, lambda rows: windows.start_end_sessions(rows, buckets=buckets), "append", out, closed=True)
    return spark.read.schema(result.schema).parquet(out).where("user_id is null or user_id >= 0")


@query("t3_deduplicated", "SELECT event_id FROM events")
def t3(spark: SparkSession, d: str) -> DataFrame:
    """Every event comes twice."""
    out = _folder(spark, "once")
    twice = lambda rows: rows.select("event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    result = streamed(spark, read(spark, d, "events"), lambda rows: windows.deduplicated(twice(rows), "event_id").select("event_id"), "append", out, of=2)
    return spark.read.schema(result.schema).parquet(out)


@query("t5_incremental_merge", f"""WITH {TELEMETRY_SQL}, r AS (SELECT app, ets, unnest([{{'kind': 'DAY', 'period': {DAY}}}, {{'kind': 'CUMULATIVE', 'period': 0}}]) AS p FROM t)
SELECT p.kind AS kind, p.period AS period, app, count(*) AS events, max(ets) AS last_ms FROM r GROUP BY 1, 2, 3""")
def t5(spark: SparkSession, d: str) -> DataFrame:
    """T5: facts kept up by a stream, in real micro-batches, each of which is sent twice."""
    table = facts.fact_table(spark, _folder(spark, "facts"))
    kind = facts.Facts(["app"], {"events": "sum", "last_ms": "max"}, kinds=("DAY", "CUMULATIVE"))
    add = windows.incremental(lambda name, rows: kind.add(table, name, telemetry(rows).select("ets", "app", F.lit(1).cast("long").alias("events"), F.col("ets").alias("last_ms"))))

    def both(batch: DataFrame, epoch: int) -> None:
        add(batch, epoch)
        add(batch, epoch)

    streamed(spark, read(spark, d, "events"), lambda rows: rows, "append", both)
    return table.read()
