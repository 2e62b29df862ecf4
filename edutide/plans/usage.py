"""Usage summaries, fact roll-ups and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.functions.time import last_days, period
from edutide.operators import metrics, rollup, sessions, summaries
from edutide.operators.cube import all_cube
from edutide.sources.shared import parts_of
from edutide.sources.telemetry import REGISTERED_TAGS, TELEMETRY_SQL, read

from .basics import events, registry
from .sequences import PLAYS_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


query = registry(QUERIES, SQL)


def plays(spark: SparkSession, d: str) -> DataFrame:
    return summaries.play_sessions(events(spark, d))


FIXED = "period, app, channel"
KNOWN = "('t0', 't1', 't2')"
MEASURES = "CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions, CAST(sum(interactions) AS BIGINT) AS total_interactions, min(start_ms) AS first_ms, max(end_ms) AS last_ms"
AVERAGES = """CASE WHEN total_sessions = 0 THEN 0 ELSE round(total_ms / 1000 / total_sessions, 2) END AS avg_ts_session,
CASE WHEN total_interactions = 0 OR total_ms = 0 THEN 0 ELSE round(total_interactions / (total_ms / 1000 / 60), 2) END AS avg_interactions_min"""


def cube_sql(source: str, dims: list[str], measures: str, fixed: str = FIXED, combos: list[list[str]] | None = None, tag_combos: list[list[str]] | None = None, tags: bool = True) -> str:
    """SQL of all_cube: one SELECT per combination, so that it shares nothing with grouping sets."""
    from edutide.operators.cube import subsets

    combos = subsets(dims) if combos is None else combos
    tag_combos = combos if tag_combos is None else tag_combos
    parts = []
    for tag, sets in (("'all'", combos), ("tag", tag_combos if tags else [])):
        rows = source if tag == "'all'" else f"(SELECT *, unnest(list_filter(tags, lambda x: x IN {KNOWN})) AS tag FROM {source})"
        for c in sets:
            shown = ", ".join(f"{x} AS {x}" if x in c else f"'all' AS {x}" for x in dims)
            keys = ", ".join([k for k in (fixed, *c, *(["tag"] if tag == "tag" else [])) if k])
            parts.append(f"SELECT {', '.join(x for x in (fixed, shown, tag + ' AS tag', measures) if x)} FROM {rows}" + (f" GROUP BY {keys}" if keys else ""))
    return " UNION ALL ".join(f"({p})" for p in parts)


@query("a6_all_cube", f"WITH {PLAYS_SQL}, " + "x AS (" + cube_sql("s", ["uid", "content"], MEASURES) + ") SELECT * FROM x")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return all_cube(plays(spark, d), summaries.FIXED, ["uid", "content"], summaries.usage_measures(), registered=REGISTERED_TAGS)


def _g1_sql() -> str:
    from edutide.operators.cube import subsets

    dims, col = ["content", "user", "device"], {"user": "uid", "content": "content", "device": "did"}
    parts = []
    for tag in (False, True):
        rows = f"(SELECT *, unnest(list_filter(tags, lambda x: x IN {KNOWN})) AS tag FROM s)" if tag else "s"
        for c in subsets(dims):
            shown = ", ".join(f"{col[x]} AS \"{x}\"" if x in c else f"'all' AS \"{x}\"" for x in dims)
            uniq = ", ".join(f"{'0' if x in c else f'count(DISTINCT {col[x]})'} AS unique_{x}s" for x in dims)
            keys = ", ".join([FIXED, *[col[x] for x in c], *(["tag"] if tag else [])])
            parts.append(f"(SELECT {FIXED}, {shown}, {'tag' if tag else chr(39) + 'all' + chr(39)} AS tag, {MEASURES}, {uniq} FROM {rows} GROUP BY {keys})")
    return f"WITH {PLAYS_SQL}, x AS ({' UNION ALL '.join(parts)}) SELECT *, {AVERAGES} FROM x"


@query("g1_workflow_usage", _g1_sql())
def g1(spark: SparkSession, d: str) -> DataFrame:
    return summaries.workflow_usage(plays(spark, d), REGISTERED_TAGS)


@query("g2_user_content_usage", f"WITH {PLAYS_SQL}, x AS ({cube_sql('s', ['uid', 'content'], MEASURES, tag_combos=[['uid'], ['content'], []])}) SELECT *, {AVERAGES} FROM x")
def g2(spark: SparkSession, d: str) -> DataFrame:
    return summaries.user_content_usage(plays(spark, d), REGISTERED_TAGS)


@query("g3_content_usage", f"WITH {PLAYS_SQL}, x AS ({cube_sql('s', ['content'], MEASURES + ', count(DISTINCT did) AS unique_did')}) SELECT *, {AVERAGES} FROM x")
def g3(spark: SparkSession, d: str) -> DataFrame:
    return summaries.content_usage(plays(spark, d), REGISTERED_TAGS)




def anonymous():
    return F.substring("uid", -1, 1) == "7"


G4 = "CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions, CAST(sum(anonymous) AS BIGINT) AS anonymous_sessions, count(DISTINCT uid) AS unique_users, CAST(sum(new_user) AS BIGINT) AS new_user_sessions"


@query("g4_app_usage", f"""WITH {PLAYS_SQL}, r AS (SELECT *, CAST(right(uid, 1) = '7' AS INTEGER) AS anonymous, CAST(min(period) OVER (PARTITION BY uid) = period AS INTEGER) AS new_user FROM s),
x AS (SELECT {FIXED}, uid AS author, {G4} FROM r WHERE anonymous = 0 GROUP BY {FIXED}, uid UNION ALL SELECT {FIXED}, 'all', {G4} FROM r GROUP BY {FIXED})
SELECT *, round(new_user_sessions * 100 / total_sessions, 2) AS percent_new FROM x""")
def g4(spark: SparkSession, d: str) -> DataFrame:
    return summaries.app_usage(plays(spark, d), anonymous())


@query("g5_author_usage", f"""WITH {PLAYS_SQL}, r AS (SELECT *, uid AS author, CAST(score > 2 AS INTEGER) AS editor FROM s WHERE right(uid, 1) <> '7'),
x AS ({cube_sql('r', ['author'], 'CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions, CAST(sum(editor) AS BIGINT) AS editor_visits', tags=False)})
SELECT *, round(editor_visits * 100 / total_sessions, 2) AS percent_editor FROM x WHERE editor_visits > 0""")
def g5(spark: SparkSession, d: str) -> DataFrame:
    return summaries.author_usage(plays(spark, d), anonymous(), F.col("score") > 2)


@query("g6_launch_usage", f"WITH {PLAYS_SQL}, x AS ({cube_sql('s', [], MEASURES + ', count(DISTINCT did) AS unique_did')}) SELECT *, {AVERAGES} FROM x")
def g6(spark: SparkSession, d: str) -> DataFrame:
    return summaries.launch_usage(plays(spark, d), REGISTERED_TAGS)


@query("g7_items", f"WITH {TELEMETRY_SQL} SELECT sid, uid, content, 'q' || k AS item, score, score > 0 AS pass, page AS resp FROM t WHERE eid IN ('INTERACT', 'END')")
def g7(spark: SparkSession, d: str) -> DataFrame:
    return summaries.items(events(spark, d)).select("sid", "uid", "content", "item", "score", "pass", F.col("resvalues")[0]["ans"].alias("resp"))


@query("g8_item_usage", f"""WITH {TELEMETRY_SQL}, i AS (SELECT *, 'q' || k AS item, CAST(strftime(epoch_ms(ets + 19800000), '%Y%m%d') AS INTEGER) AS period, unnest(list_concat(['all'], list_filter(tags, lambda x: x IN {KNOWN}))) AS tag FROM t WHERE eid IN ('INTERACT', 'END')),
a AS (SELECT {FIXED}, content, item, tag, count(*) AS total_count, count(*) FILTER (score > 0) AS correct, CAST(sum(score) AS BIGINT) AS total_score FROM i GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY {FIXED}, content, item, tag ORDER BY n DESC, page) AS r FROM (SELECT {FIXED}, content, item, tag, page, count(*) AS n FROM i WHERE score = 0 GROUP BY ALL)),
b AS (SELECT {FIXED}, content, item, tag, string_agg(page || ':' || n, ',' ORDER BY r) AS incorrect FROM w WHERE r <= 5 GROUP BY ALL)
SELECT a.*, coalesce(incorrect, '') AS incorrect FROM a LEFT JOIN b USING ({FIXED}, content, item, tag)""")
def g8(spark: SparkSession, d: str) -> DataFrame:
    return summaries.item_usage(summaries.items(events(spark, d)), REGISTERED_TAGS)


@query("g9_stage_rows", f"""WITH {TELEMETRY_SQL}, q AS (SELECT *, lag(page) OVER (PARTITION BY did, sid ORDER BY ets, mid) AS before FROM t)
SELECT coalesce(before, 'splash') AS stage, count(DISTINCT did) AS devices, count(*) AS rows FROM q GROUP BY 1""")
def g9(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    before = F.coalesce(F.lag("page").over(Window.partitionBy("did", "sid").orderBy("ets", "mid")), F.lit("splash"))
    return events(spark, d).withColumn("stage", before).groupBy("stage").agg(F.count_distinct("did").alias("devices"), F.count("*").alias("rows"))


@query("g10_popularity", f"""WITH {TELEMETRY_SQL}, r AS (SELECT app, channel, content, tags, CAST(strftime(epoch_ms(ets + 19800000), '%Y%m%d') AS INTEGER) AS period, CASE WHEN eid = 'INTERACT' THEN k % 5 + 1 END AS rating, CAST(eid = 'INTERRUPT' AND score = 0 AS INTEGER) AS dl, CAST(eid = 'INTERRUPT' AND score >= 1 AS INTEGER) AS sl FROM t WHERE eid IN ('INTERACT', 'INTERRUPT')),
x AS ({cube_sql('r', ['content'], 'count(rating) AS ratings, CAST(coalesce(sum(rating), 0) AS BIGINT) AS rating_sum, CAST(sum(dl) AS BIGINT) AS downloads, CAST(sum(sl) AS BIGINT) AS side_loads')})
SELECT *, CASE WHEN ratings = 0 THEN 0 ELSE round(rating_sum / ratings, 2) END AS avg_rating FROM x""")
def g10(spark: SparkSession, d: str) -> DataFrame:
    return summaries.popularity(events(spark, d), REGISTERED_TAGS)


@query("g11_sideloading", f"""WITH {TELEMETRY_SQL}, r AS (SELECT content, did AS origin, score AS depth FROM t WHERE eid = 'INTERRUPT'), o AS (SELECT content, origin, max(depth) AS depth, count(*) FILTER (depth = 0) AS n FROM r GROUP BY 1, 2)
SELECT content, CAST(sum(n) AS BIGINT) AS downloads, count(*) AS origins, CAST(sum(depth) AS BIGINT) AS depth_sum, round(sum(depth) / count(*), 2) AS avg_depth FROM o GROUP BY 1""")
def g11(spark: SparkSession, d: str) -> DataFrame:
    shares = events(spark, d).where("eid = 'INTERRUPT'").select("content", F.col("did").alias("origin"), F.col("score").alias("depth"), "mid")
    state = summaries.sideloading(shares.where("mid % 2 = 0"))
    return summaries.sideloading_report(summaries.sideloading(shares.where("mid % 2 = 1"), state))


@query("g12_editor_usage", f"""WITH {PLAYS_SQL}, x AS ({cube_sql('s', ['content'], MEASURES, tags=False)}) SELECT *, {AVERAGES} FROM x""")
def g12(spark: SparkSession, d: str) -> DataFrame:
    return summaries.with_ratios(all_cube(plays(spark, d), summaries.FIXED, ["content"], summaries.usage_measures()))


@query("g13_textbook_usage", f"WITH {PLAYS_SQL} SELECT period, app, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS sessions, count(DISTINCT content) AS textbooks, CAST(sum(interactions) AS BIGINT) AS changes FROM s GROUP BY 1, 2")
def g13(spark: SparkSession, d: str) -> DataFrame:
    return plays(spark, d).groupBy("period", "app").agg(F.sum("ms").alias("total_ms"), F.count("*").alias("sessions"), F.count_distinct("content").alias("textbooks"), F.sum("interactions").alias("changes"))


DAY = "CAST(strftime(epoch_ms(ets + 19800000), '%Y%m%d') AS INTEGER)"


@query("g14_pipeline_counts", f"WITH {TELEMETRY_SQL} SELECT {DAY} AS period, channel, page AS type, eid AS state, count(*) AS count FROM t GROUP BY ALL")
def g14(spark: SparkSession, d: str) -> DataFrame:
    return summaries.pipeline_counts(events(spark, d), "page", "eid")


@query("g15_scans", f"WITH {TELEMETRY_SQL}, x AS (SELECT *, unnest(CASE WHEN k % 4 = 0 THEN ['', NULL] WHEN k % 4 = 1 THEN [content] ELSE [content, page] END) AS code FROM t) SELECT code, channel, count(*) AS total_scans, min(ets) AS first_ms, max(ets) AS last_ms FROM x WHERE code <> '' GROUP BY 1, 2")
def g15(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k") % 4
    codes = F.when(k == 0, F.array(F.lit(""), F.lit(None))).when(k == 1, F.array("content")).otherwise(F.array("content", "page"))
    return summaries.scans(events(spark, d), codes)


@query("g16_device_summary", f"""WITH {PLAYS_SQL}, p AS (SELECT did, count(DISTINCT sid) AS launches, count(*) AS plays, count(DISTINCT content) AS contents, CAST(sum(ms) AS BIGINT) AS total_ms FROM s GROUP BY 1),
r AS (SELECT did, count(*) FILTER (eid = 'INTERRUPT') AS downloads, count(*) FILTER (eid = 'INTERACT' AND score > 0) AS scans_ok, count(*) FILTER (eid = 'INTERACT' AND score = 0) AS scans_failed, min(ets) AS first_access FROM t GROUP BY 1)
SELECT * FROM p FULL JOIN r USING (did)""")
def g16(spark: SparkSession, d: str) -> DataFrame:
    return summaries.device_summary(plays(spark, d), events(spark, d))


@query("g17_device_usage", f"""WITH {PLAYS_SQL}, x AS (SELECT did, count(*) AS launches, CAST(sum(ms) AS BIGINT) AS total_ms, min(start_ms) AS first_ms, max(end_ms) AS last_ms FROM s GROUP BY 1),
y AS (SELECT *, CAST(greatest((last_ms - greatest(first_ms, 1425168000000)) // 86400000, 1) AS BIGINT) AS days FROM x)
SELECT *, round(total_ms / 1000 / days, 2) AS avg_time, round(launches / days, 2) AS avg_launches FROM y""")
def g17(spark: SparkSession, d: str) -> DataFrame:
    s = plays(spark, d)
    old = summaries.device_usage(s.where("period < 20240115"))
    return summaries.device_usage(s.where("period >= 20240115"), old)


@query("g18_device_content_usage", f"WITH {PLAYS_SQL} SELECT did, content, count(*) AS plays, CAST(sum(ms) AS BIGINT) AS total_ms, CAST(sum(interactions) AS BIGINT) AS interactions, min(start_ms) AS start_ms, count(*) OVER (PARTITION BY did) AS device_contents FROM s GROUP BY 1, 2")
def g18(spark: SparkSession, d: str) -> DataFrame:
    return summaries.device_content_usage(plays(spark, d))


@query("g19_learner_activity", f"""WITH {PLAYS_SQL}, b AS (SELECT uid, count(*) AS sessions, CAST(sum(ms) AS BIGINT) AS total_ms FROM s GROUP BY 1),
rc AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY e DESC, content) AS r FROM (SELECT uid, content, max(end_ms) AS e FROM s GROUP BY 1, 2)),
l AS (SELECT uid, string_agg(content, ',' ORDER BY r) AS last_contents FROM rc WHERE r <= 5 GROUP BY 1),
h AS (SELECT uid, unnest(range(a, e + 1)) % 24 AS hour FROM (SELECT uid, start_ms // 3600000 % 24 AS a, end_ms // 3600000 % 24 + CASE WHEN end_ms // 3600000 % 24 < start_ms // 3600000 % 24 THEN 24 ELSE 0 END AS e FROM s)),
m AS (SELECT uid, CAST(hour AS INTEGER) AS active_hour FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY n DESC, hour) AS r FROM (SELECT uid, hour, count(*) AS n FROM h GROUP BY 1, 2)) WHERE r = 1)
SELECT b.*, last_contents, active_hour, round(total_ms / 1000 / sessions, 2) AS mean_time FROM b JOIN l USING (uid) JOIN m USING (uid)""")
def g19(spark: SparkSession, d: str) -> DataFrame:
    return summaries.learner_activity(plays(spark, d))


@query("g20_proficiency", f"""WITH {TELEMETRY_SQL}, a AS (SELECT uid, page AS concept, sum(score) AS s, sum(2 - score) AS m FROM t WHERE eid = 'INTERACT' GROUP BY 1, 2)
SELECT uid, concept, 0.5 + CAST(s AS DOUBLE) AS alpha, 1 + CAST(m AS DOUBLE) AS beta, round((0.5 + CAST(s AS DOUBLE)) / (1.5 + CAST(s + m AS DOUBLE)), 2) AS pi FROM a""")
def g20(spark: SparkSession, d: str) -> DataFrame:
    answers = events(spark, d).where("eid = 'INTERACT'").select("uid", F.col("page").alias("concept"), "score", F.lit(2).alias("max_score"), "mid")
    return summaries.proficiency(answers.where("mid % 2 = 1"), summaries.proficiency(answers.where("mid % 2 = 0")))


STAGE = {"START": "onboarded", "IMPRESSION": "browsed", "END": "finished"}


@query("g21_daily_funnel", f"WITH {TELEMETRY_SQL}, f AS (SELECT sid, {DAY} AS period, " + ", ".join(f"CAST(count(*) FILTER (eid = '{e}') > 0 AS INTEGER) AS {s}_reached" for e, s in STAGE.items()) + " FROM t GROUP BY 1, 2) SELECT period, count(*) AS sessions, " + ", ".join(f"CAST(sum({s}_reached) AS BIGINT) AS {s}, round(sum({s}_reached) * 100 / count(*), 2) AS {s}_percent" for s in STAGE.values()) + " FROM f GROUP BY 1")
def g21(spark: SparkSession, d: str) -> DataFrame:
    f = sessions.funnel(events(spark, d).withColumn("period", period(F.col("ets"), "DAY")), ["sid", "period"], STAGE)
    return summaries.daily_funnel(f, list(STAGE.values()))


@query("g24_job_monitor", f"WITH {TELEMETRY_SQL} SELECT {DAY} AS period, count(*) FILTER (eid = 'START') AS started, count(*) FILTER (eid = 'END') AS completed, count(*) FILTER (eid = 'INTERRUPT') AS failed, count(*) AS rows FROM t GROUP BY 1")
def g24(spark: SparkSession, d: str) -> DataFrame:
    return summaries.monitor(events(spark, d).select(period(F.col("ets"), "DAY").alias("period"), F.col("eid").alias("status")))


@query("g26_content_snapshot", """WITH e AS (SELECT l_partkey AS content, 's' || l_suppkey AS author, 'n' || s_nationkey AS partner, CASE WHEN p_size > 10 THEN 'Live' ELSE 'Draft' END AS status, CAST(p_size AS BIGINT) AS created_ms FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
u AS (SELECT l_partkey AS content, count(*) AS plays FROM lineitem GROUP BY 1), j AS (SELECT * FROM e LEFT JOIN u USING (content)),
x AS (""" + cube_sql("j", ["author", "partner"], "count(DISTINCT content) AS contents, count(DISTINCT CASE WHEN status = 'Live' THEN content END) AS live, CAST(sum(created_ms) AS BIGINT) AS creation_ms, CAST(sum(coalesce(plays, 0)) AS BIGINT) AS plays", fixed="", tags=False) + ") SELECT * EXCLUDE (tag) FROM x")
def g26(spark: SparkSession, d: str) -> DataFrame:
    li, p, s = (read(spark, d, t) for t in ("lineitem", "part", "supplier"))
    parts = parts_of(li.count(), spark)
    li = li.select("l_partkey", "l_suppkey").repartition(parts, "l_partkey")
    edges = li.distinct().join(p, F.col("p_partkey") == F.col("l_partkey")).join(s, F.col("s_suppkey") == F.col("l_suppkey"))
    edges = edges.select(F.col("l_partkey").alias("content"), F.concat(F.lit("s"), "l_suppkey").alias("author"), F.concat(F.lit("n"), "s_nationkey").alias("partner"), F.when(F.col("p_size") > 10, "Live").otherwise("Draft").alias("status"), F.col("p_size").cast("long").alias("created_ms"))
    return summaries.snapshot(edges, li.groupBy(F.col("l_partkey").alias("content")).agg(F.count("*").alias("plays")), parts)


ROLLED = f"""r AS (SELECT *, unnest([{{'kind': 'DAY', 'period': {DAY}}}, {{'kind': 'WEEK', 'period': CAST(isoyear(epoch_ms(ets)) * 1000 + 700 + week(epoch_ms(ets)) AS INTEGER)}},
  {{'kind': 'MONTH', 'period': CAST(strftime(epoch_ms(ets + 19800000), '%Y%m') AS INTEGER)}}, {{'kind': 'CUMULATIVE', 'period': 0}}]) AS p FROM f)"""

@query("u1_rollup_merge", f"""WITH f AS (SELECT o_custkey, epoch_us(o_orderdate) // 1000 AS ets, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders), {ROLLED}
SELECT p.kind AS kind, p.period AS period, o_custkey, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS orders, min(ets) AS first_ms, max(ets) AS last_ms FROM r GROUP BY 1, 2, 3""")
def u1(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.time import millis

    rows = read(spark, d, "orders").select("o_custkey", millis("o_orderdate").alias("ets"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.lit(1).cast("long").alias("orders"))
    rows = rows.withColumn("first_ms", F.col("ets")).withColumn("last_ms", F.col("ets"))
    how = {"cents": "sum", "orders": "sum", "first_ms": "min", "last_ms": "max"}
    old, new = (rollup.rollup(rows.where(w), ["o_custkey"], how) for w in ("ets < 883612800000", "ets >= 883612800000"))
    return rollup.merge(new, old, ["kind", "period", "o_custkey"], how)


@query("u14_code_fact", f"""WITH {TELEMETRY_SQL}, x AS (SELECT content AS code, count(*) AS scans, min(ets) AS first_ms, max(ets) AS last_ms FROM t WHERE eid = 'INTERACT' GROUP BY 1)
SELECT *, CASE WHEN (last_ms - first_ms) // 86400000 = 0 THEN scans ELSE scans // ((last_ms - first_ms) // 86400000) END AS per_day FROM x""")
def u14(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).where("eid = 'INTERACT'").select(F.col("content").alias("code"), F.lit(1).cast("long").alias("scans"), F.col("ets").alias("first_ms"), F.col("ets").alias("last_ms"), "mid")
    how = {"scans": "sum", "first_ms": "min", "last_ms": "max"}
    old = rollup.merge(rows.where("mid % 2 = 0").drop("mid"), None, ["code"], how)
    out = rollup.merge(rows.where("mid % 2 = 1").drop("mid"), old, ["code"], how)
    days = F.floor((F.col("last_ms") - F.col("first_ms")) / 86400000)
    return out.withColumn("per_day", F.when(days == 0, F.col("scans")).otherwise(F.floor(F.col("scans") / days)))


@query("u15_pipeline_fact", f"WITH {TELEMETRY_SQL}, f AS (SELECT channel, eid, page, ets FROM t), {ROLLED} SELECT p.kind AS kind, p.period AS period, channel, eid, page, count(*) AS n FROM r GROUP BY ALL")
def u15(spark: SparkSession, d: str) -> DataFrame:
    return rollup.rollup(events(spark, d).select("channel", "eid", "page", "ets", F.lit(1).cast("long").alias("n")), ["channel", "eid", "page"], {"n": "sum"})


@query("u16_start_of_period", """WITH c AS (SELECT p_brand AS brand, count(*) AS parts FROM part GROUP BY 1), k AS (SELECT * FROM (VALUES ('DAY', 20240131), ('WEEK', 2024705), ('MONTH', 202401)) v(kind, period))
SELECT kind, period, brand, parts, CASE WHEN kind = 'DAY' THEN parts ELSE parts - 1 END AS parts_start FROM c, k""")
def u16(spark: SparkSession, d: str) -> DataFrame:
    current = read(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("parts"))
    before = rollup.start_of_period(current.withColumn("parts", F.col("parts") - 1), None, ["brand"], ["parts"], 1_706_616_000_000)
    return rollup.start_of_period(current, before, ["brand"], ["parts"], 1_706_702_400_000)


@query("u17_device_profile", f"WITH {PLAYS_SQL} SELECT did, min(start_ms) AS first_ms, max(end_ms) AS last_ms, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS launches, round(sum(ms) / 1000 / count(*), 2) AS avg_time FROM s GROUP BY 1")
def u17(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.scalars import ratio

    s = plays(spark, d).select("did", F.col("start_ms").alias("first_ms"), F.col("end_ms").alias("last_ms"), F.col("ms").alias("total_ms"), F.lit(1).cast("long").alias("launches"), "period")
    how = {"first_ms": "min", "last_ms": "max", "total_ms": "sum", "launches": "sum"}
    old = rollup.merge(s.where("period < 20240110").drop("period"), None, ["did"], how)
    out = rollup.merge(s.where("period >= 20240110").drop("period"), old, ["did"], how)
    return out.withColumn("avg_time", ratio(F.col("total_ms") / 1000, F.col("launches")))


@query("u18_device_specification", f"WITH {TELEMETRY_SQL} SELECT did, arg_max(page, ets * 1000000 + mid) AS os, arg_max(content, ets * 1000000 + mid) AS make FROM t GROUP BY 1")
def u18(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).withColumn("dspec", F.create_map(F.lit("os"), F.col("page"), F.lit("make"), F.col("content")))
    return rollup.latest(rows.select("did", "ets", "mid", F.col("dspec")["os"].alias("os"), F.col("dspec")["make"].alias("make")), "did", "ets", "mid").select("did", "os", "make")


@query("u19_learner_profile", f"WITH {TELEMETRY_SQL} SELECT uid, arg_max(channel, ets * 1000000 + mid) AS channel, arg_max(page, ets * 1000000 + mid) AS page, max(ets) AS updated_ms FROM t WHERE eid = 'START' GROUP BY 1")
def u19(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).where("eid = 'START'").select("uid", "channel", "page", "ets", "mid")
    return rollup.latest(rows, "uid", "ets", "mid").select("uid", "channel", "page", F.col("ets").alias("updated_ms"))


@query("u20_learner_content", f"WITH {PLAYS_SQL} SELECT uid, content, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS sessions, round(sum(ms) / 1000 / count(*), 2) AS avg_time FROM s GROUP BY 1, 2")
def u20(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.scalars import ratio

    return plays(spark, d).groupBy("uid", "content").agg(F.sum("ms").alias("total_ms"), F.count("*").alias("sessions")).withColumn("avg_time", ratio(F.col("total_ms") / 1000, F.col("sessions")))


@query("u25_content_rating", f"WITH {TELEMETRY_SQL} SELECT content, round(sum(k % 5 + 1) / count(*), 2) AS rating, count(*) AS n FROM t WHERE eid = 'INTERACT' AND content IN (SELECT content FROM t WHERE eid = 'INTERACT' AND ets >= 1706400000000) GROUP BY 1")
def u25(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.scalars import ratio

    rated = events(spark, d).where("eid = 'INTERACT'").withColumn("rating", F.col("k") % 5 + 1)
    recent = rated.where("ets >= 1706400000000").select("content").distinct()
    out = rated.join(recent, "content", "left_semi").groupBy("content").agg(F.sum("rating").alias("s"), F.count("*").alias("n"))
    return out.select("content", ratio(F.col("s"), F.col("n")).alias("rating"), "n")


@query("u26_daily_totals", f"WITH {PLAYS_SQL} SELECT period, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions FROM s GROUP BY 1")
def u26(spark: SparkSession, d: str) -> DataFrame:
    rows = all_cube(plays(spark, d), summaries.FIXED, [], summaries.usage_measures(), combos=[[]])
    return rows.groupBy("period").agg(F.sum("total_ms").alias("total_ms"), F.sum("total_sessions").alias("total_sessions"))


@query("u27_portal_totals", f"WITH {PLAYS_SQL} SELECT channel, count(DISTINCT did) AS devices, count(*) AS plays, round(sum(ms) / 3600000, 2) AS hours, count(DISTINCT content) AS contents FROM s GROUP BY 1")
def u27(spark: SparkSession, d: str) -> DataFrame:
    return plays(spark, d).groupBy("channel").agg(F.count_distinct("did").alias("devices"), F.count("*").alias("plays"), F.round(F.sum("ms") / 3600000, 2).alias("hours"), F.count_distinct("content").alias("contents"))


@query("u28_consumption", f"""WITH {PLAYS_SQL}, a AS (SELECT period, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS visits FROM s GROUP BY 1), b AS (SELECT period, count(DISTINCT sid) AS launches, count(DISTINCT did) AS devices FROM s GROUP BY 1)
SELECT period, round(total_ms / 1000 / visits, 2) AS usage_per_visit, round(visits / launches, 2) AS visits_per_launch, round(launches / devices, 2) AS launches_per_device, round(total_ms / 1000 / devices, 2) AS usage_per_device FROM a FULL JOIN b USING (period)""")
def u28(spark: SparkSession, d: str) -> DataFrame:
    s = plays(spark, d)
    facts = s.groupBy("period").agg(F.sum("ms").alias("total_ms"), F.count("*").alias("visits"))
    return metrics.consumption(facts, s.groupBy("period").agg(F.count_distinct("sid").alias("launches"), F.count_distinct("did").alias("devices")))


def facts(spark: SparkSession, d: str) -> DataFrame:
    return plays(spark, d).groupBy("period", "content", "did").agg(F.sum("ms").alias("total_ms"), F.count("*").alias("total_sessions"), F.sum("interactions").alias("total_interactions"), F.max("end_ms").alias("updated_ms"))


FACTS_SQL = f"{PLAYS_SQL}, fa AS (SELECT period, content, did, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions, CAST(sum(interactions) AS BIGINT) AS total_interactions, max(end_ms) AS updated_ms FROM s GROUP BY 1, 2, 3)"
WEEK = "(SELECT CAST(strftime(DATE '2024-02-03' - CAST(i AS INTEGER), '%Y%m%d') AS INTEGER) AS period FROM range(1, 8) r(i))"


def week(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(last_days("2024-02-03", 7)).alias("period"))


@query("v1_metric_events", f"WITH {FACTS_SQL} SELECT period, 'usage' AS product, content, did FROM fa WHERE updated_ms >= 1705276800000 AND updated_ms < 1705881600000")
def v1(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("updated_ms")
    out = metrics.metric_events(facts(spark, d), (at >= 1705276800000) & (at < 1705881600000), "usage")
    return out.select("period", "product", F.get_json_object("event", "$.content").alias("content"), F.get_json_object("event", "$.did").alias("did"))


@query("v2_view", f"WITH {FACTS_SQL} SELECT content, CAST(sum(total_ms) AS BIGINT) AS total_ms, count(*) AS n FROM fa WHERE period IN {WEEK} GROUP BY 1")
def v2(spark: SparkSession, d: str) -> DataFrame:
    return metrics.view(facts(spark, d), week(spark), ["content"], {"total_ms": F.sum("total_ms"), "n": F.count("*")})


@query("v3_zero_filled", f"""WITH {FACTS_SQL}, w AS {WEEK}, x AS (SELECT * FROM fa WHERE period IN (SELECT period FROM w))
SELECT w.period, CAST(coalesce(sum(total_ms), 0) AS BIGINT) AS total_ms, CAST(coalesce(sum(total_sessions), 0) AS BIGINT) AS total_sessions FROM w LEFT JOIN x USING (period) GROUP BY 1
UNION ALL SELECT -1, CAST(sum(total_ms) AS BIGINT), CAST(sum(total_sessions) AS BIGINT) FROM x""")
def v3(spark: SparkSession, d: str) -> DataFrame:
    return metrics.query(facts(spark, d), week(spark), {"total_ms": F.sum("total_ms"), "total_sessions": F.sum("total_sessions")})


V4 = {
    "usage": "CAST(sum(total_ms) AS BIGINT) AS total_ms, CAST(sum(total_sessions) AS BIGINT) AS total_sessions, round(sum(total_ms) / sum(total_sessions) / 1000, 2) AS avg_ts_session",
    "content": "CAST(sum(total_ms) AS BIGINT) AS total_ms, CAST(sum(total_sessions) AS BIGINT) AS total_sessions, count(DISTINCT content) AS contents",
    "device": "count(DISTINCT did) AS devices",
    "launch": "CAST(sum(total_sessions) AS BIGINT) AS launches, CAST(sum(total_interactions) AS BIGINT) AS interactions",
    "interactions": "CAST(sum(total_interactions) AS BIGINT) AS interactions, round(sum(total_interactions) / sum(total_sessions), 2) AS per_session",
    "list": "array_to_string(list_sort(list(DISTINCT content)), ',') AS contents",
}


def _v4(metric: str):
    return lambda spark, d: facts(spark, d).groupBy("period").agg(*[c.alias(n) for n, c in metrics.reducers(metric).items()])


for _name, _sql in V4.items():
    query(f"v4_{_name}_metrics", f"WITH {FACTS_SQL} SELECT period, {_sql} FROM fa GROUP BY 1")(_v4(_name))
