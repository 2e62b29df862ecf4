"""Telemetry rows: the schema that operators expect, and its mapping from the `events` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.functions.time import millis

#: How event types stand for telemetry event ids, and which of the tags are registered.
EVENT_IDS = {"view": "IMPRESSION", "click": "INTERACT", "signup": "START", "purchase": "END", "error": "INTERRUPT"}
REGISTERED_TAGS = ["t0", "t1", "t2"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(events: DataFrame) -> DataFrame:
    """mid, ets (epoch ms), eid, uid, did, content, page, sid, channel, app, tags, score, ver of each event."""
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.lit(None).cast("string")
    for kind, name in EVENT_IDS.items():
        eid = F.when(F.col("event_type") == kind, name).otherwise(eid)
    return events.select(
        F.col("event_id").alias("mid"),
        millis("ts").alias("ets"),
        eid.alias("eid"),
        F.concat(F.lit("u"), F.col("user_id")).alias("uid"),
        F.concat(F.lit("d"), F.col("user_id") % 40).alias("did"),
        F.concat(F.lit("c"), k % 20).alias("content"),
        F.concat(F.lit("p"), k % 7).alias("page"),
        F.concat_ws("-", F.concat(F.lit("u"), F.col("user_id")), F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyyMMdd")).alias("sid"),
        F.concat(F.lit("ch"), F.col("user_id") % 3).alias("channel"),
        F.concat(F.lit("app"), F.col("user_id") % 2).alias("app"),
        F.array(F.concat(F.lit("t"), k % 5)).alias("tags"),
        F.col("value").alias("value"),
        (k % 3).cast("long").alias("score"),
        k.cast("long").alias("k"),
    )


#: The same mapping in SQL, as a common table expression named t.
TELEMETRY_SQL = """t0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
t AS (SELECT event_id AS mid, epoch_us(ts) // 1000 AS ets,
  CASE event_type WHEN 'view' THEN 'IMPRESSION' WHEN 'click' THEN 'INTERACT' WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' WHEN 'error' THEN 'INTERRUPT' END AS eid,
  'u' || user_id AS uid, 'd' || (user_id % 40) AS did, 'c' || (k % 20) AS content, 'p' || (k % 7) AS page,
  'u' || user_id || '-' || strftime(ts, '%Y%m%d') AS sid, 'ch' || (user_id % 3) AS channel, 'app' || (user_id % 2) AS app,
  ['t' || (k % 5)] AS tags, value, CAST(k % 3 AS BIGINT) AS score, CAST(k AS BIGINT) AS k FROM t0)"""
