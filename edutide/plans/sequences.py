"""Window, session and workflow queries over telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.operators import sessions, workflow
from edutide.sources.telemetry import TELEMETRY_SQL, read

from .basics import events, registry

QUERIES: dict = {}
SQL: dict[str, str] = {}


query = registry(QUERIES, SQL)


def gaps_sql(keys: str, idle_s: int = 600, of: str = "t") -> str:
    return f"""g AS (SELECT *, CASE WHEN own_gap IS NULL OR own_gap > {idle_s * 1000} THEN 0 ELSE own_gap END AS gap_ms FROM
  (SELECT *, ets - lag(ets) OVER (PARTITION BY {keys} ORDER BY ets, mid) AS own_gap FROM {of}))"""


R2 = "floor((CAST({} AS BIGINT) + 5) / 10) / 100"
KEYS = "sid, uid, did, channel, app"

#: Sessions by start, end and change of content, as a common table expression c over t.
BY_OBJECT = f"""c0 AS (SELECT *, lag(eid) OVER w AS prev, last_value(CASE WHEN eid <> 'END' THEN content END IGNORE NULLS) OVER (PARTITION BY {KEYS} ORDER BY ets, mid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM t WINDOW w AS (PARTITION BY {KEYS} ORDER BY ets, mid)),
c AS (SELECT *, sum(CASE WHEN eid = 'START' OR prev IS NULL OR prev = 'END' OR (eid NOT IN ('START', 'END') AND coalesce(seen <> content, false)) THEN 1 ELSE 0 END) OVER (PARTITION BY {KEYS} ORDER BY ets, mid) AS session FROM c0)"""

#: The measured sessions, as a common table expression s.
PLAYS_SQL = f"""{TELEMETRY_SQL}, {BY_OBJECT}, {gaps_sql(KEYS + ', session', of='c')},
s AS (SELECT {KEYS}, session, min(ets) AS start_ms, max(ets) AS end_ms, CAST(sum(gap_ms) AS BIGINT) AS raw_ms, count(*) AS n_events, count(*) FILTER (eid = 'INTERACT') AS interactions,
  arg_min(content, ets * 1000000 + mid) AS content, arg_min(tags, ets * 1000000 + mid) AS tags, CAST(sum(score) AS BIGINT) AS score,
  CAST(floor((CAST(sum(gap_ms) AS BIGINT) + 5) / 10) * 10 AS BIGINT) AS ms,
  CAST(strftime(epoch_ms(min(ets) + 19800000), '%Y%m%d') AS INTEGER) AS period FROM g GROUP BY {KEYS}, session)"""


@query("w1_latest_attempt", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1")
def w1(spark: SparkSession, d: str) -> DataFrame:
    from edutide.operators.reports import latest_attempt

    return latest_attempt(read(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], "l_shipdate", ["l_linenumber", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query("w2_window_sum", "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(sum(l_quantity) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total_quantity FROM lineitem")
def w2(spark: SparkSession, d: str) -> DataFrame:
    from edutide.operators.reports import with_totals

    out = with_totals(read(spark, d, "lineitem"), ["l_orderkey"], {"total_quantity": "l_quantity"})
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("total_quantity").cast("long").alias("total_quantity"))


@query("w3_idle_capped_time", f"WITH {TELEMETRY_SQL}, {gaps_sql('uid')} SELECT uid, {R2.format('sum(gap_ms)')} AS time_spent, count(*) AS n_events FROM g GROUP BY uid")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return sessions.time_spent(events(spark, d), ["uid"])


@query("w4_page_time", f"""WITH {TELEMETRY_SQL}, {gaps_sql('sid')},
q AS (SELECT *, count(CASE WHEN eid = 'IMPRESSION' THEN 1 END) OVER (PARTITION BY sid ORDER BY ets, mid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg FROM g),
o AS (SELECT sid, page, row_number() OVER (PARTITION BY sid ORDER BY ets, mid) AS seg FROM t WHERE eid = 'IMPRESSION'),
m AS (SELECT sid, seg, sum(gap_ms) AS ms FROM q GROUP BY 1, 2)
SELECT sid, page, {R2.format('sum(coalesce(ms, 0))')} AS time_spent, count(*) AS visits FROM o LEFT JOIN m USING (sid, seg) GROUP BY 1, 2""")
def w4(spark: SparkSession, d: str) -> DataFrame:
    return sessions.pages(events(spark, d), ["sid"])


@query("w5_environments", f"""WITH {TELEMETRY_SQL}, {gaps_sql('sid')},
q AS (SELECT *, count(CASE WHEN eid = 'IMPRESSION' THEN 1 END) OVER (PARTITION BY sid ORDER BY ets, mid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg FROM g),
o AS (SELECT sid, page, row_number() OVER (PARTITION BY sid ORDER BY ets, mid) AS seg FROM t WHERE eid = 'IMPRESSION'),
m AS (SELECT sid, seg, sum(gap_ms) AS ms FROM q GROUP BY 1, 2),
p AS (SELECT sid, page, {R2.format('sum(coalesce(ms, 0))')} AS time_spent, count(*) AS visits FROM o LEFT JOIN m USING (sid, seg) GROUP BY 1, 2)
SELECT sid, CASE WHEN page IN ('p0', 'p1', 'p2') THEN 'home' ELSE 'course' END AS env, round(sum(time_spent), 2) AS time_spent, max(visits) AS count FROM p GROUP BY 1, 2""")
def w5(spark: SparkSession, d: str) -> DataFrame:
    return sessions.environments(sessions.pages(events(spark, d), ["sid"]), ["sid"], F.when(F.col("page").isin("p0", "p1", "p2"), "home").otherwise("course"))


@query("w6_stages", f"""WITH {TELEMETRY_SQL}, {gaps_sql('sid')},
q AS (SELECT *, lag(page) OVER (PARTITION BY sid ORDER BY ets, mid) AS before FROM g)
SELECT sid, coalesce(before, 'splash') AS stage, {R2.format('sum(gap_ms)')} AS time_spent, CAST(sum(CASE WHEN before IS NULL OR before <> page THEN 1 ELSE 0 END) AS BIGINT) AS changes FROM q GROUP BY 1, 2""")
def w6(spark: SparkSession, d: str) -> DataFrame:
    return sessions.stages(events(spark, d), ["sid"])


@query("w7_navigation", f"""WITH {TELEMETRY_SQL}, t1 AS (SELECT *, count(CASE WHEN eid = 'IMPRESSION' THEN 1 END) OVER (PARTITION BY uid ORDER BY ets, mid) AS seg FROM t), {gaps_sql('uid', 1800, 't1')},
stops AS (SELECT uid, seg, sum(gap_ms) AS stop_ms FROM g WHERE eid = 'INTERRUPT' GROUP BY 1, 2),
navs AS (SELECT *, coalesce(lead(ets) OVER (PARTITION BY uid ORDER BY ets, mid) - ets, 0) AS next_ms FROM t1 WHERE eid = 'IMPRESSION')
SELECT uid, page, {R2.format('sum(greatest(next_ms - coalesce(stop_ms, 0), 0))')} AS time_spent, count(*) AS visits FROM navs LEFT JOIN stops USING (uid, seg) GROUP BY 1, 2""")
def w7(spark: SparkSession, d: str) -> DataFrame:
    return sessions.navigation(events(spark, d), ["uid"])


@query("w8_interrupt_time", f"""WITH {TELEMETRY_SQL}, m AS (SELECT *, lag(eid) OVER w AS pe, lag(ets) OVER w AS pt FROM t WHERE eid IN ('INTERRUPT', 'START') WINDOW w AS (PARTITION BY uid ORDER BY ets, mid)),
n AS (SELECT uid, CASE WHEN eid = 'START' AND pe = 'INTERRUPT' THEN ets - pt END AS ms FROM m)
SELECT uid, {R2.format('coalesce(sum(ms), 0)')} AS interrupt_time, count(ms) AS pairs FROM n GROUP BY 1""")
def w8(spark: SparkSession, d: str) -> DataFrame:
    return sessions.interrupts(events(spark, d), ["uid"])


STAGES = {"START": "onboarded", "IMPRESSION": "browsed", "INTERRUPT": "skipped", "END": "finished"}


@query("w9_funnel", f"WITH {TELEMETRY_SQL} SELECT sid, " + ", ".join(f"count(*) FILTER (eid = '{e}') AS {s}_count, CAST(count(*) FILTER (eid = '{e}') {'=' if s == 'skipped' else '>'} 0 AS INTEGER) AS {s}_reached" for e, s in STAGES.items()) + " FROM t GROUP BY sid")
def w9(spark: SparkSession, d: str) -> DataFrame:
    return sessions.funnel(events(spark, d), ["sid"], STAGES)


@query("w10_recommendation_funnel", f"""WITH {TELEMETRY_SQL}, m AS (SELECT *, count(CASE WHEN eid = 'START' THEN 1 END) OVER (PARTITION BY uid ORDER BY ets, mid) AS call FROM t)
SELECT uid, call, count(*) FILTER (eid = 'IMPRESSION') AS shown, count(*) FILTER (eid = 'INTERACT') AS clicked, count(*) FILTER (eid = 'INTERRUPT') AS downloads, count(*) FILTER (eid = 'END') AS plays, CAST(count(*) FILTER (eid = 'END') > 0 AS INTEGER) AS consumed FROM m WHERE call > 0 GROUP BY 1, 2""")
def w10(spark: SparkSession, d: str) -> DataFrame:
    return sessions.recommendation_funnel(events(spark, d), ["uid"])


@query("w11_nth_in_session", f"""WITH {TELEMETRY_SQL}, f AS (SELECT *, min(ets) OVER (PARTITION BY sid) AS first FROM t),
m AS (SELECT sid, row_number() OVER w AS i, ets - coalesce(lag(ets) OVER w, first) AS ms FROM f WHERE eid = 'INTERACT' WINDOW w AS (PARTITION BY sid ORDER BY ets, mid))
SELECT sid, {', '.join(R2.format(f'max(ms) FILTER (i = {i})') + f' AS page{i}' for i in (1, 2, 3))} FROM m WHERE i <= 3 GROUP BY sid""")
def w11(spark: SparkSession, d: str) -> DataFrame:
    return sessions.nth_in_session(events(spark, d), ["sid"], "INTERACT", 3)


@query("z1_content_sessions", f"WITH {TELEMETRY_SQL}, {BY_OBJECT} SELECT mid, sid, CAST(session AS BIGINT) AS session FROM c")
def z1(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_object(events(spark, d), KEYS.split(", ")).select("mid", "sid", "session")


def by_gap_sql(keys: str, idle_ms: int, starts: bool, start: str = "START", end: str = "END") -> str:
    own = f"eid = '{start}' OR" if starts else ""
    other = "" if starts else f"eid <> '{start}' AND"
    return f"""z0 AS (SELECT *, lag(eid) OVER (PARTITION BY {keys} ORDER BY ets, mid) AS prev, ets - lag(ets) OVER (PARTITION BY {keys} ORDER BY ets, mid) AS gap FROM t),
z AS (SELECT *, sum(CASE WHEN {own} prev IS NULL OR prev = '{end}' OR ({other} CASE WHEN eid = '{end}' THEN gap > {idle_ms} ELSE gap >= {idle_ms} END) THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY ets, mid) AS session FROM z0)"""


@query("z2_content_sessions_v1", f"""WITH {TELEMETRY_SQL}, c0 AS (SELECT *, lag(eid) OVER w AS prev, last_value(CASE WHEN eid <> 'INTERRUPT' THEN page END IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ets, mid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM t WINDOW w AS (PARTITION BY uid ORDER BY ets, mid))
SELECT mid, uid, CAST(sum(CASE WHEN eid = 'IMPRESSION' OR prev IS NULL OR prev = 'INTERRUPT' OR (eid NOT IN ('IMPRESSION', 'INTERRUPT') AND coalesce(seen <> page, false)) THEN 1 ELSE 0 END) OVER (PARTITION BY uid ORDER BY ets, mid) AS BIGINT) AS session FROM c0""")
def z2(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_object(events(spark, d), ["uid"], "page", ("IMPRESSION",), ("INTERRUPT",)).select("mid", "uid", "session")


@query("z3_app_sessions", f"WITH {TELEMETRY_SQL}, {by_gap_sql('did, channel', 1800000, True)} SELECT mid, did, CAST(session AS BIGINT) AS session FROM z")
def z3(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_gap(events(spark, d), ["did", "channel"]).select("mid", "did", "session")


@query("z4_app_sessions_v1", f"WITH {TELEMETRY_SQL}, {by_gap_sql('did', 1200000, True, 'IMPRESSION', 'INTERRUPT')} SELECT mid, did, CAST(session AS BIGINT) AS session FROM z")
def z4(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_gap(events(spark, d), ["did"], 20, ("IMPRESSION",), ("INTERRUPT",)).select("mid", "did", "session")


@query("z5_usage_sessions", f"WITH {TELEMETRY_SQL}, {by_gap_sql('sid', 1800000, False)} SELECT mid, sid, CAST(session AS BIGINT) AS session FROM z")
def z5(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_gap(events(spark, d), ["sid"], starts_split=False).select("mid", "sid", "session")


@query("z6_editor_sessions", f"""WITH {TELEMETRY_SQL}, c0 AS (SELECT *, lag(eid) OVER w AS prev FROM t WINDOW w AS (PARTITION BY channel, sid, content ORDER BY ets, mid))
SELECT mid, sid, content, CAST(sum(CASE WHEN eid = 'START' OR prev IS NULL OR prev = 'END' THEN 1 ELSE 0 END) OVER (PARTITION BY channel, sid, content ORDER BY ets, mid) AS BIGINT) AS session FROM c0""")
def z6(spark: SparkSession, d: str) -> DataFrame:
    return sessions.by_object(events(spark, d), ["channel", "sid", "content"]).select("mid", "sid", "content", "session")


SUMMARY = f"""min(ets) AS start_ms, max(ets) AS end_ms, count(*) AS n_events, count(*) FILTER (eid = 'INTERACT') AS interactions, {R2.format('sum(gap_ms)')} AS time_spent, {R2.format('max(ets) - min(ets)')} AS time_diff"""
RATE = "CASE WHEN interactions = 0 OR time_spent = 0 THEN 0 ELSE {}round(interactions / (time_spent / 60), 2) END AS interactions_per_min"


@query("z7_textbook_sessions", f"""WITH {TELEMETRY_SQL}, {gaps_sql('sid, content')}
SELECT sid, content, {R2.format('sum(gap_ms)')} AS time_spent, CAST(sum(CASE WHEN eid = 'START' THEN 1 ELSE 0 END) AS BIGINT) AS units_added, CAST(sum(CASE WHEN eid = 'INTERRUPT' THEN 1 ELSE 0 END) AS BIGINT) AS units_deleted, CAST(sum(CASE WHEN eid = 'INTERACT' THEN score ELSE 0 END) AS BIGINT) AS lessons_modified
FROM g GROUP BY 1, 2 HAVING sum(gap_ms) > 0""")
def z7(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.time import round2_ms

    out = sessions.gaps(events(spark, d), ["sid", "content"]).groupBy("sid", "content")
    n = lambda e: F.count(F.when(F.col("eid") == e, 1))
    out = out.agg(F.sum("gap_ms").alias("ms"), n("START").alias("units_added"), n("INTERRUPT").alias("units_deleted"), F.sum(F.when(F.col("eid") == "INTERACT", F.col("score")).otherwise(0)).alias("lessons_modified")).where("ms > 0")
    return out.select("sid", "content", round2_ms(F.col("ms")).alias("time_spent"), "units_added", "units_deleted", "lessons_modified")


@query("z8_workflow_tree")
def z8(spark: SparkSession, d: str) -> DataFrame:
    return workflow.workflow(events(spark, d))


@query("z9_session_summary", f"""WITH {TELEMETRY_SQL}, {BY_OBJECT}, {gaps_sql(KEYS + ', session', of='c')},
m AS (SELECT {KEYS}, CAST(session AS BIGINT) AS session, {SUMMARY} FROM g GROUP BY ALL),
a AS (SELECT {KEYS}, session, max(n) AS attempts FROM (SELECT {KEYS}, session, k, count(*) AS n FROM c GROUP BY ALL) GROUP BY ALL)
SELECT *, {RATE.format('')} FROM m JOIN a USING ({KEYS}, session) WHERE time_spent >= 1""".replace("(SELECT *, ", "(SELECT *, "))
def z9(spark: SparkSession, d: str) -> DataFrame:
    keys = [*KEYS.split(", "), "session"]
    cut = sessions.by_object(events(spark, d), keys[:-1])
    return sessions.summary(cut, keys, least_s=1.0).join(sessions.attempts(cut, keys), keys)


@query("z10_portal_sessions", f"WITH {TELEMETRY_SQL}, {gaps_sql('channel, sid')}, m AS (SELECT channel, sid, {SUMMARY} FROM g GROUP BY 1, 2) SELECT *, {RATE.format('CASE WHEN time_spent < 60 THEN CAST(interactions AS DOUBLE) ELSE ').replace('END AS', 'END END AS')} FROM m")
def z10(spark: SparkSession, d: str) -> DataFrame:
    return sessions.summary(events(spark, d), ["channel", "sid"], short_raw=True)


@query("z11_editor_summary", f"""WITH {TELEMETRY_SQL}, {gaps_sql('sid, content')}
SELECT sid, content, {R2.format('sum(gap_ms)')} AS time_spent, count(DISTINCT page) AS plugins, count(*) FILTER (eid = 'END') AS saves, count(*) FILTER (eid = 'INTERACT' AND score = 0) AS menus, count(*) FILTER (eid = 'INTERACT' AND score > 0) AS sidebars, max(value) AS load_time FROM g GROUP BY 1, 2""")
def z11(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.time import round2_ms

    n = lambda c: F.count(F.when(c, 1))
    e, score = F.col("eid"), F.col("score")
    return sessions.gaps(events(spark, d), ["sid", "content"]).groupBy("sid", "content").agg(round2_ms(F.sum("gap_ms")).alias("time_spent"), F.count_distinct("page").alias("plugins"), n(e == "END").alias("saves"), n((e == "INTERACT") & (score == 0)).alias("menus"), n((e == "INTERACT") & (score > 0)).alias("sidebars"), F.max("value").alias("load_time"))


@query("z12_launch_summary", f"""WITH {TELEMETRY_SQL}, {by_gap_sql('did, channel', 1800000, True)}, {gaps_sql('did, channel, session', of='z')},
m AS (SELECT did, channel, CAST(session AS BIGINT) AS session, {SUMMARY}, array_to_string(list_sort(list(DISTINCT content)), ',') AS contents FROM g GROUP BY 1, 2, 3) SELECT *, {RATE.format('')} FROM m""")
def z12(spark: SparkSession, d: str) -> DataFrame:
    cut = sessions.by_gap(events(spark, d), ["did", "channel"])
    return sessions.summary(cut, ["did", "channel", "session"], extra={"contents": F.array_join(F.array_sort(F.collect_set("content")), ",")})
