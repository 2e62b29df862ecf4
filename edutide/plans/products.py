"""Reports, audits, recommendations, graph, text and streaming queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edutide.functions import scalars
from edutide.functions.time import millis
from edutide.operators import quality, recommend, reports, rollup, vectors
from edutide.operators.joins import similar_pairs
from edutide.sources import io
from edutide.sources.shared import parts_of, stored
from edutide.sources.telemetry import TELEMETRY_SQL, read

from .basics import events, registry

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = registry(QUERIES, SQL)


def _enrolments(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    o, c, n, r = (read(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    progress = scalars.clamp_percent(F.col("o_totalprice") / 4000)
    enrolments = o.select(F.col("o_orderkey").alias("enrolment"), F.col("o_custkey").alias("userid"), progress.alias("progress"), F.col("o_orderpriority").alias("batch"))
    users = c.select(F.col("c_custkey").alias("userid"), F.col("c_name").alias("username"), F.col("c_nationkey").alias("orgid"), (F.col("c_custkey") % 25).cast("int").alias("rootorg"), (F.col("c_nationkey") % 5).cast("int").alias("place"))
    return enrolments, users, n.select(F.col("n_nationkey").alias("org"), F.col("n_name").alias("orgname")), r.select(F.col("r_regionkey").alias("place"), F.col("r_name").alias("district"))


PERCENT = "CASE WHEN o_totalprice / 4000 > 100 THEN 100 ELSE CAST(trunc(o_totalprice / 4000) AS INTEGER) END"


@query("r1_progress_report", f"""SELECT o_orderkey AS enrolment, c_name AS username, {PERCENT} AS progress, CASE WHEN c_nationkey <> c_custkey % 25 AND s.n_name IS NOT NULL THEN s.n_name ELSE t.n_name END AS organisation, r_name AS district
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation s ON s.n_nationkey = c_nationkey LEFT JOIN nation t ON t.n_nationkey = c_custkey % 25 LEFT JOIN region ON r_regionkey = c_nationkey % 5""")
def r1(spark: SparkSession, d: str) -> DataFrame:
    return reports.progress(*_enrolments(spark, d)).select("enrolment", "username", "progress", "organisation", "district")


@query("r2_batch_stats", f"SELECT o_orderpriority AS batch, count(DISTINCT o_custkey) AS participants, count(DISTINCT CASE WHEN {PERCENT} = 100 THEN o_custkey END) AS completed, count(*) AS enrolments FROM orders GROUP BY 1")
def r2(spark: SparkSession, d: str) -> DataFrame:
    return reports.batch_stats(_enrolments(spark, d)[0], "batch")


@query("r3_assessment_report", """WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1),
b AS (SELECT l_orderkey, 'P' || l_partkey % 3 AS test, CAST(max(l_quantity) AS BIGINT) AS best FROM l GROUP BY 1, 2)
SELECT l_orderkey, CAST((SELECT sum(l_quantity) FROM l x WHERE x.l_orderkey = b.l_orderkey) AS BIGINT) AS total, coalesce(max(best) FILTER (test = 'P0'), 0) AS "P0", coalesce(max(best) FILTER (test = 'P1'), 0) AS "P1", coalesce(max(best) FILTER (test = 'P2'), 0) AS "P2" FROM b GROUP BY 1""")
def r3(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    li = li.repartition(parts_of(li.count(), spark), "l_orderkey")  # all that follows stays in an order
    last = reports.latest_attempt(li, ["l_orderkey", "l_partkey"], "l_shipdate", ["l_linenumber", "l_suppkey", "l_extendedprice"])
    last = reports.with_totals(last, ["l_orderkey"], {"total": "l_quantity"})
    best = last.groupBy("l_orderkey", F.col("total").cast("long").alias("total"), F.concat(F.lit("P"), F.col("l_partkey") % 3).alias("test")).agg(F.max("l_quantity").cast("long").alias("best"))
    return reports.pivoted(best, ["l_orderkey", "total"], "test", "best", ["P0", "P1", "P2"]).na.fill(0)


@query("r4_declarative_report", """WITH a AS (SELECT strftime(l_shipdate, '%Y-%m') || '-01' AS date, l_returnflag AS flag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT *, quantity / n AS per_line FROM a WHERE n > 2""")
def r4(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    q = {"time": "l_shipdate", "granularity": "month", "dimensions": {"l_returnflag": "flag"}, "filters": [{"type": "equals", "dimension": "l_linestatus", "value": "F"}], "aggregations": [("count", None, "n"), ("longSum", "q", "quantity")], "post": [("per_line", "/", "quantity", "n")], "having": [("greaterThan", "n", 2)]}
    return reports.group_report(rows, q)


NODES = """n AS (SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders)"""


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c))
    r, n, c, o = (read(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    out = r.select(name("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
    for df, i, p in ((n, name("n", "n_nationkey"), name("r", "n_regionkey")), (c, name("c", "c_custkey"), name("n", "c_nationkey")), (o, name("o", "o_orderkey"), name("c", "o_custkey"))):
        out = out.unionByName(df.select(i.alias("id"), p.alias("parent")))
    return out


@query("r7_hierarchy", f"WITH RECURSIVE {NODES}, h AS (SELECT id, parent, id AS root, 0 AS level FROM n WHERE parent IS NULL UNION ALL SELECT n.id, n.parent, h.root, h.level + 1 FROM n JOIN h ON n.parent = h.id WHERE h.level < 3) SELECT * FROM h")
def r7(spark: SparkSession, d: str) -> DataFrame:
    return reports.descend(_nodes(spark, d), 3)


@query("g29_link_coverage", f"""WITH RECURSIVE {NODES}, h AS (SELECT id, parent, 0 AS level FROM n WHERE parent IS NULL UNION ALL SELECT n.id, n.parent, h.level + 1 FROM n JOIN h ON n.parent = h.id WHERE h.level < 2)
SELECT parent, level, count(CASE WHEN length(id) > 2 THEN right(id, 2) END) AS codes, count(DISTINCT CASE WHEN length(id) > 2 THEN right(id, 2) END) AS distinct_codes, count(CASE WHEN right(id, 1) = '1' THEN 1 END) AS linked FROM h WHERE parent IS NOT NULL GROUP BY 1, 2""")
def g29(spark: SparkSession, d: str) -> DataFrame:
    from edutide.operators.summaries import coverage

    h = reports.descend(_nodes(spark, d), 2).where("parent is not null")
    return coverage(h.withColumn("code", F.when(F.length("id") > 2, F.expr("right(id, 2)"))).withColumn("linked", F.expr("right(id, 1) = '1'")))


@query("r8_replay", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY 1")
def r8(spark: SparkSession, d: str) -> DataFrame:
    daily = lambda df: df.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return reports.replay(read(spark, d, "events"), F.col("ts").cast("date"), "2024-01-05", "2024-01-12", daily)


@query("r9_course_status", f"""WITH {TELEMETRY_SQL}, lv AS (SELECT DISTINCT content, channel AS course FROM t WHERE k < 60), sz AS (SELECT course, count(DISTINCT content) AS size FROM lv GROUP BY 1), e AS (SELECT DISTINCT uid AS userid, channel AS course FROM t),
dn AS (SELECT userid, course, count(DISTINCT content) AS done FROM (SELECT DISTINCT uid AS userid, content FROM t WHERE eid = 'END') JOIN lv USING (content) GROUP BY 1, 2)
SELECT userid, course, size AS "of", coalesce(done, 0) AS done, CAST(coalesce(done, 0) * 100 // size AS BIGINT) AS progress, CASE WHEN coalesce(done, 0) >= size THEN 2 WHEN coalesce(done, 0) > 0 THEN 1 ELSE 0 END AS status FROM e JOIN sz USING (course) LEFT JOIN dn USING (userid, course)""")
def r9(spark: SparkSession, d: str) -> DataFrame:
    t = events(spark, d)
    leaves = t.where("k < 60").select("content", F.col("channel").alias("course")).distinct()
    return reports.corrected_status(t.where("eid = 'END'").select(F.col("uid").alias("userid"), "content"), leaves, t.select(F.col("uid").alias("userid"), F.col("channel").alias("course")).distinct())


@query("r10_asset_use", """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)\\b(?:id|href|src)\\s*=\\s*"([^"]+)"', 1)) AS thing FROM pages)
SELECT thing, count(DISTINCT page_id) AS owners, count(*) AS uses FROM a GROUP BY 1""".replace("a AS (SELECT page_id, unnest(", "a AS (SELECT page_id, unnest(list_distinct(").replace(", 1)) AS thing", ", 1))) AS thing"))
def r10(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages").select("page_id", "html")
    names = pages.select(F.lit("none").alias("thing"), F.lit("none").alias("name")).distinct()
    return reports.usage_of(pages, "page_id", io.markup_ids(F.col("html")), names).drop("name")


@query("r11_load_analysis", f"WITH {TELEMETRY_SQL} SELECT app, count(DISTINCT uid) AS users, count(DISTINCT did) AS devices, count(*) FILTER (eid = 'INTERRUPT') AS downloads, count(*) FILTER (eid = 'INTERACT') AS scans, count(*) FILTER (eid = 'INTERACT' AND score > 0) AS scans_ok FROM t GROUP BY 1")
def r11(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.count(F.when(c, 1))
    e = F.col("eid")
    return events(spark, d).groupBy("app").agg(F.count_distinct("uid").alias("users"), F.count_distinct("did").alias("devices"), n(e == "INTERRUPT").alias("downloads"), n(e == "INTERACT").alias("scans"), n((e == "INTERACT") & (F.col("score") > 0)).alias("scans_ok"))


@query("r12_score_features", f"WITH {TELEMETRY_SQL} SELECT uid, count(DISTINCT sid) AS sessions, CAST(sum(score) AS BIGINT) AS reward, max(score) AS best FROM t WHERE eid IN ('INTERACT', 'END') GROUP BY 1 HAVING count(*) > 3")
def r12(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where("eid in ('INTERACT', 'END')").groupBy("uid").agg(F.count_distinct("sid").alias("sessions"), F.sum("score").alias("reward"), F.max("score").alias("best"), F.count("*").alias("n")).where("n > 3").drop("n")


PAIRS = [("START", "IMPRESSION"), ("IMPRESSION", "INTERACT"), ("INTERACT", "END"), ("END", "INTERRUPT")]


@query("d1_stage_audit", f"WITH {TELEMETRY_SQL}, c AS (SELECT eid, count(*) AS n FROM t GROUP BY 1), p AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{a}{chr(39)}, {chr(39)}{b}{chr(39)})' for a, b in PAIRS)}) v(from_stage, to_stage)), x AS (SELECT p.*, a.n AS input, b.n AS output, round(abs(a.n - b.n) * 100 / a.n, 2) AS percent FROM p JOIN c a ON a.eid = from_stage JOIN c b ON b.eid = to_stage), y AS (SELECT *, CASE WHEN percent <= 1 THEN 'GREEN' WHEN percent <= 1.5 THEN 'AMBER' ELSE 'RED' END AS status FROM x) SELECT *, (SELECT CASE WHEN bool_or(status = 'RED') THEN 'RED' WHEN bool_or(status = 'AMBER') THEN 'AMBER' ELSE 'GREEN' END FROM y) AS overall FROM y")
def d1(spark: SparkSession, d: str) -> DataFrame:
    return quality.stage_audit(events(spark, d).groupBy(F.col("eid").alias("stage")).agg(F.count("*").alias("n")), PAIRS)


@query("d2_failed_by_producer", f"WITH {TELEMETRY_SQL}, f AS (SELECT app, channel, count(*) AS failed FROM t WHERE eid = 'INTERRUPT' AND score = 0 GROUP BY 1, 2), x AS (SELECT *, (SELECT count(*) FROM t) AS total FROM f), y AS (SELECT *, round(failed * 100 / total, 2) AS percent FROM x) SELECT *, CASE WHEN percent <= 1 THEN 'GREEN' WHEN percent <= 1.5 THEN 'AMBER' ELSE 'RED' END AS status FROM y")
def d2(spark: SparkSession, d: str) -> DataFrame:
    return quality.failed_by_producer(events(spark, d), (F.col("eid") == "INTERRUPT") & (F.col("score") == 0), ["app", "channel"])


@query("d3_store_audit", "WITH a AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS a FROM events GROUP BY 1), b AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS b FROM events WHERE event_id % 97 <> 0 GROUP BY 1), x AS (SELECT day, coalesce(a, 0) AS a, coalesce(b, 0) AS b, round(abs(coalesce(a, 0) - coalesce(b, 0)) * 100 / a, 2) AS percent FROM a FULL JOIN b USING (day)) SELECT *, CASE WHEN percent <= 1 THEN 'GREEN' WHEN percent <= 1.5 THEN 'AMBER' ELSE 'RED' END AS status FROM x")
def d3(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    return quality.store_audit(e, e.where("event_id % 97 <> 0"), "day")


LATE = "(SELECT CAST(ts AS DATE) AS day, CAST(ts AS DATE) + CAST(event_id % 7 - 2 AS INTEGER) AS synced, event_id % 50 = 0 AS unsynced FROM events)"
LATE_SQL = f"""WITH r AS (SELECT day, NOT unsynced AND synced BETWEEN day - 1 AND day + 2 AS inside FROM {LATE}), x AS (SELECT CAST(day AS VARCHAR) AS day, count(*) AS events, count(*) FILTER (inside) AS in_time FROM r GROUP BY 1),
y AS (SELECT *, round((events - in_time) * 100 / events, 2) AS percent FROM x) SELECT *, CASE WHEN percent <= 25 THEN 'GREEN' WHEN percent <= 25.5 THEN 'AMBER' ELSE 'RED' END AS status FROM y"""


def _late(spark: SparkSession, d: str) -> dict:
    """Events with a sync day of two days before to four days after their own; one of 50 has none."""
    day = F.col("ts").cast("date")
    synced = F.when(F.col("event_id") % 50 != 0, F.date_add(day, (F.col("event_id") % 7 - 2).cast("int")))
    return {"events": read(spark, d, "events"), "day": day, "sync": synced, "minus": 1, "plus": 2}


@query("t4_late_events", LATE_SQL)
def t4(spark: SparkSession, d: str) -> DataFrame:
    return quality.late_audit(**_late(spark, d), threshold=25.0).withColumn("day", F.col("day").cast("string"))


def _x4_sql() -> str:
    parts = {"stages": SQL["d1_stage_audit"], "producers": SQL["d2_failed_by_producer"], "stores": SQL["d3_store_audit"], "late": SQL["t4_late_events"]}
    one = "SELECT '{}' AS name, count(*) AS checked, count(*) FILTER (status = 'RED') AS red, CASE WHEN count(*) FILTER (status = 'RED') > 0 THEN 'RED' WHEN count(*) FILTER (status = 'AMBER') > 0 THEN 'AMBER' ELSE 'GREEN' END AS status FROM ({})"
    return " UNION ALL ".join(one.format(name, sql) for name, sql in parts.items())


@query("x4_audits", _x4_sql())
def x4(spark: SparkSession, d: str) -> DataFrame:
    """Four audits by name from one list of configs."""
    e, t = read(spark, d, "events").withColumn("day", F.col("ts").cast("date").cast("string")), events(spark, d)
    counts = t.groupBy(F.col("eid").alias("stage")).agg(F.count("*").alias("n"))
    return quality.run_audits([
        {"name": "stages", "audit": "stages", "priority": 1, "params": {"counts": counts, "pairs": PAIRS}},
        {"name": "producers", "audit": "producers", "priority": 2, "params": {"events": t, "failed": (F.col("eid") == "INTERRUPT") & (F.col("score") == 0), "producer": ["app", "channel"]}},
        {"name": "stores", "audit": "stores", "priority": 3, "params": {"a": e, "b": e.where("event_id % 97 <> 0"), "day": "day"}},
        {"name": "late", "audit": "late", "priority": 4, "params": _late(spark, d), "threshold": 25.0},
    ])


@query("d4_duplicates", f"WITH {TELEMETRY_SQL}, k AS (SELECT eid, did || '-' || k AS mid2, count(*) AS n FROM t WHERE eid NOT IN ('START') GROUP BY 1, 2) SELECT eid, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys, round((sum(n) - count(*)) * 100 / sum(n), 2) AS percent FROM k GROUP BY 1")
def d4(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(events(spark, d).withColumn("mid2", F.concat_ws("-", "did", "k")), "mid2", "eid", ["START"])


@query("d5_repair", "SELECT event_id, try_cast(CASE WHEN event_id % 2 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS duration, true AS repaired FROM events WHERE event_type = 'error'")
def d5(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", F.col("event_type").alias("failed_stage"), F.when(F.col("event_id") % 2 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("duration"), F.col("props").alias("metadata"))
    return quality.repair(rows, "error").select("event_id", "duration", "repaired")


@query("d6_sync_time", f"WITH {TELEMETRY_SQL} SELECT mid, CASE WHEN mid % 3 = 0 THEN ets ELSE ets + 5000 END AS sync FROM t")
def d6(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).withColumn("sync", F.when(F.col("mid") % 3 != 0, F.col("ets") + 5000))
    return quality.with_sync_time(rows, "sync", "ets").select("mid", "sync")


@query("d7_sync_day", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def d7(spark: SparkSession, d: str) -> DataFrame:
    i, ms = F.col("event_id") % 3, millis("ts")
    raw = F.when(i == 0, ms.cast("string")).when(i == 1, ms.cast("double").cast("string")).otherwise(F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return read(spark, d, "events").select("event_id", quality.sync_day(raw).cast("string").alias("day"))


@query("d8_validated", "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'missing url' WHEN page_id % 7 = 0 THEN 'missing html' END AS reject FROM pages")
def d8(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("url"), F.when(F.col("page_id") % 7 != 0, F.col("html")).otherwise("  ").alias("html"))
    return quality.validated(rows, ["url", "html"]).select("page_id", "reject")


@query("l5_lexicographic", "SELECT p_partkey, p_brand, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_retailprice DESC, p_partkey) AS INTEGER) AS rank FROM part) WHERE rank <= 5")
def l5(spark: SparkSession, d: str) -> DataFrame:
    return recommend.ranked(read(spark, d, "part"), "p_brand", [F.desc("p_size"), F.desc("p_retailprice"), F.col("p_partkey")], 5).select("p_partkey", "p_brand", "rank")


@query("l4_surprise", "SELECT p_partkey, p_brand, rank, rank > 3 AS surprise FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS INTEGER) AS rank FROM part) WHERE rank <= 3 OR (rank > 10 AND rank <= 12)")
def l4(spark: SparkSession, d: str) -> DataFrame:
    return recommend.with_surprise(read(spark, d, "part"), "p_brand", [F.desc("p_size"), F.col("p_partkey")], 5, 2, 10).select("p_partkey", "p_brand", "rank", "surprise")


@query("m11_filtered", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def m11(spark: SparkSession, d: str) -> DataFrame:
    black = read(spark, d, "labels").where("toxic = 1").select("doc_id")
    return recommend.filtered(read(spark, d, "documents").select("doc_id", "lang"), ["en", "fr"], black, "doc_id")


@query("m3_similar_contents", """WITH p AS (SELECT q.vec_id AS query, v.vec_id AS id, 0.7 * list_inner_product(CAST(q.embedding[1:32] AS DOUBLE[]), CAST(v.embedding[1:32] AS DOUBLE[])) + (1 - 0.7) * list_inner_product(CAST(q.embedding[33:64] AS DOUBLE[]), CAST(v.embedding[33:64] AS DOUBLE[])) AS score FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 40 = 0)
SELECT query, id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM p) WHERE rank <= 3""")
def m3(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.slice("embedding", 1, 32).alias("text_vec"), F.slice("embedding", 33, 32).alias("tag_vec"))
    return similar_pairs(v, v.where("id % 40 = 0"), 0.7, 3).select("query", "id", "rank")


@query("m4_end_of_content")
def m4(spark: SparkSession, d: str) -> DataFrame:
    """Per played part: others of its brand with a size in common, by quantile bins of price and size."""
    p = recommend.binned(read(spark, d, "part"), {"p_retailprice": 10, "p_size": 5})
    played = p.where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("played"), "p_brand", "p_size_bin")
    out = recommend.ranked_others(p, played, "played", "p_partkey", ["p_brand", "p_size_bin"], [F.desc("p_retailprice_bin"), F.desc("p_size"), F.col("p_partkey")], 5)
    return out.select("played", "p_partkey", "rank")


@query("m1_quantile_bins")
def m1(spark: SparkSession, d: str) -> DataFrame:
    return recommend.binned(read(spark, d, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size")), {"p_retailprice": 10, "p_size": 5})


@query("m2_one_hot_words")
def m2(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return recommend.one_hot_words(read(spark, d, "part").select("p_partkey", "p_name"), "p_name").select("p_partkey", vector_to_array("p_name_vec").alias("words"))


def _frame(spark: SparkSession, d: str) -> DataFrame:
    li, p = read(spark, d, "lineitem"), read(spark, d, "part")
    li = li.select("l_suppkey", "l_partkey", "l_quantity", "l_discount").repartition(parts_of(li.count(), spark), "l_partkey")  # models hold a partition's rows in a task
    rows = li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("disc"), F.count("*").alias("n"))
    return rows.join(p, F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "l_partkey", "q", "disc", F.col("n").cast("double").alias("n"), F.col("p_size").cast("double").alias("p_size"), "p_brand")


@query("m5_training_frame")
def m5(spark: SparkSession, d: str) -> DataFrame:
    out = recommend.training_frame(_frame(spark, d), ["disc", "n", "p_size"], ["p_brand"], F.col("q"))
    train, _ = recommend.split(out, "l_partkey")
    return train.select("l_suppkey", "l_partkey", F.round("label", 6).alias("label"))


FEATURES = ["disc", "n", "p_size"]


def _scaled(spark: SparkSession, d: str) -> DataFrame:
    """Device-content rows with centred and scaled features, and log1p of the quantity as the label; stored once, as they are read
    for the scales, for the model and for its scores."""
    rows = stored(_frame(spark, d).select("l_suppkey", "l_partkey", "q", *FEATURES), "frame")
    return recommend.scaled(rows, FEATURES).select("l_suppkey", "l_partkey", *FEATURES, F.log1p("q").alias("label"))


def _score(model: recommend.Factorization) -> Column:
    return recommend.fm_score([F.col(c) for c in FEATURES], model.intercept, model.linear, model.factors)


@query("m6_factorization_training")
def m6(spark: SparkSession, d: str) -> DataFrame:
    """M6: trains a factorisation machine on four parts of five of the contents; its error on the rest beside that of the mean."""
    train, test = recommend.split(_scaled(spark, d), "l_partkey")
    model = recommend.factorization(train, FEATURES)
    error = lambda c: F.round(F.sqrt(F.avg((F.col("label") - c) ** 2)), 6)
    return test.agg(F.count("*").alias("rows"), error(_score(model)).alias("rmse"), error(F.lit(model.mean)).alias("rmse_of_mean"))


@query("m7_factorization_scores")
def m7(spark: SparkSession, d: str) -> DataFrame:
    """M6 and M7: a factorisation machine trained on device-content rows scores all of them by column arithmetic."""
    rows = _scaled(spark, d)
    score = _score(recommend.factorization(recommend.split(rows, "l_partkey")[0], FEATURES))
    return recommend.ranked(rows.withColumn("score", F.round(score, 6)), "l_suppkey", [F.desc("score"), F.col("l_partkey")], 10).select("l_suppkey", "l_partkey", "score", "rank")


@query("m8_mean_rows", "SELECT l_suppkey, round(avg(l_quantity), 4) AS q, round(avg(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1")
def m8(spark: SparkSession, d: str) -> DataFrame:
    out = recommend.mean_rows(read(spark, d, "lineitem"), "l_suppkey", ["l_quantity", "l_extendedprice"])
    return out.select("l_suppkey", F.round("l_quantity", 4).alias("q"), F.round("l_extendedprice", 2).alias("price"))


@query("m9_regressions")
def m9(spark: SparkSession, d: str) -> DataFrame:
    rows = recommend.assembled(_frame(spark, d), ["disc", "n", "p_size"]).withColumn("label", F.log1p("q"))
    return recommend.regressions(*recommend.split(rows, "l_partkey"))


CONCEPTS = [f"p{i}" for i in range(7)]
_N = len(CONCEPTS)


def _m10_sql(rounds: int) -> str:
    total = 0.33 * 3 + 1.0
    steps = ", ".join(f"""r{k} AS (SELECT r.learner, m.j AS c, sum(r.r * m.m) + max(v.v) AS r FROM r{k - 1} r JOIN m ON m.learner = r.learner AND m.i = r.c JOIN v ON v.learner = r.learner AND v.c = m.j GROUP BY 1, 2)""" for k in range(1, rounds + 1))
    return f"""WITH {TELEMETRY_SQL}, c AS (SELECT 'p' || i AS c FROM range(0, {_N}) r(i)), u AS (SELECT DISTINCT uid AS learner FROM t WHERE page IS NOT NULL), uc AS (SELECT learner, c FROM u, c),
s0 AS (SELECT page AS i, 'p' || ((k + 3) % 7) AS j, CAST(sum(score + 1) AS DOUBLE) AS w FROM t GROUP BY 1, 2), s1 AS (SELECT a.c AS i, b.c AS j, coalesce(w, 0.001) AS w FROM c a CROSS JOIN c b LEFT JOIN s0 ON s0.i = a.c AND s0.j = b.c),
s AS (SELECT i, j, {0.33 / total} * w / sum(w) OVER (PARTITION BY i) AS w FROM s1),
x AS (SELECT uid AS learner, page AS c, CASE WHEN count(*) FILTER (eid = 'INTERACT') > 0 THEN CAST(sum(score) FILTER (eid = 'INTERACT') AS DOUBLE) / count(*) FILTER (eid = 'INTERACT') END AS p, CASE WHEN count(*) FILTER (eid <> 'INTERACT') > 0 THEN CAST(sum(k) FILTER (eid <> 'INTERACT') AS DOUBLE) END AS ts FROM t GROUP BY 1, 2),
y AS (SELECT learner, c, coalesce(p, 0) AS p, CASE WHEN p > 0 THEN 1.0 ELSE 0.01 END AS b, coalesce(ts, 1.0 / {_N}) AS ts FROM uc LEFT JOIN x USING (learner, c)),
v AS (SELECT learner, c, {0.33 / total} * ts / sum(ts) OVER (PARTITION BY learner) + {1.0 / total} * b / sum(b) OVER (PARTITION BY learner) AS v FROM y),
q AS (SELECT a.learner, a.c AS i, b.c AS j, CASE WHEN a.p > b.p THEN a.p - b.p ELSE 0.0001 END AS q FROM y a JOIN y b USING (learner)),
m AS (SELECT learner, i, j, {0.33 / total} * q / sum(q) OVER (PARTITION BY learner, i) + w AS m FROM q JOIN s USING (i, j)),
r0 AS (SELECT learner, c, 1.0 / {_N} AS r FROM uc), {steps} SELECT learner, c AS concept, round(r, 6) AS relevance FROM r{rounds}"""


@query("m10_relevance_walk", _m10_sql(5))
def m10(spark: SparkSession, d: str) -> DataFrame:
    t = events(spark, d)
    similar = t.groupBy(F.col("page").alias("i"), F.concat(F.lit("p"), (F.col("k") + 3) % 7).alias("j")).agg(F.sum(F.col("score") + 1).cast("double").alias("w"))
    asked, spent = F.col("eid") == "INTERACT", F.col("eid") != "INTERACT"
    proficiency = F.sum(F.when(asked, F.col("score"))).cast("double") / F.nullif(F.count(F.when(asked, 1)), F.lit(0))
    learners = t.groupBy(F.col("uid").alias("learner"), F.col("page").alias("concept")).agg(proficiency.alias("proficiency"), F.sum(F.when(spent, F.col("k"))).cast("double").alias("time"))
    return recommend.relevance(CONCEPTS, similar, learners).select("learner", "concept", F.round("relevance", 6).alias("relevance"))


@query("m12_author_affinity", """WITH e AS (SELECT DISTINCT c_nationkey AS author, o_orderpriority || '-' || c_mktsegment || '-' || left(CAST(o_orderdate AS VARCHAR), 7) AS thing FROM orders JOIN customer ON c_custkey = o_custkey),
a AS (SELECT count(DISTINCT author) AS authors FROM e), n AS (SELECT thing, count(*) AS n FROM e GROUP BY 1),
r AS (SELECT x.thing AS x, y.thing AS y, count(*) AS both_ FROM e x JOIN e y ON x.author = y.author AND x.thing <> y.thing GROUP BY 1, 2),
l AS (SELECT x, y, both_ * authors / (nx.n * ny.n) AS lift FROM r JOIN n nx ON nx.thing = x JOIN n ny ON ny.thing = y, a),
s AS (SELECT e.author, y AS thing, round(sum(lift), 6) AS lift FROM e JOIN l ON l.x = e.thing WHERE NOT EXISTS (SELECT 1 FROM e z WHERE z.author = e.author AND z.thing = l.y) GROUP BY 1, 2)
SELECT author, count(*) AS n, round(max(lift), 4) AS best FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY lift DESC, thing) AS rank FROM s) WHERE rank <= 5 GROUP BY 1""")
def m12(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    edges = o.select(F.col("c_nationkey").alias("author"), F.concat_ws("-", "o_orderpriority", "c_mktsegment", F.left(F.col("o_orderdate").cast("string"), F.lit(7))).alias("thing")).distinct()
    return recommend.affinity(edges, 5).groupBy("author").agg(F.count("*").alias("n"), F.round(F.max("lift"), 4).alias("best"))


FACETS = {"priority": "o_orderpriority", "segment": "c_mktsegment", "month": "left(CAST(o_orderdate AS VARCHAR), 7)"}
_LIFTS = ", ".join(f"""{f} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY lift DESC, thing) AS place FROM (SELECT author, thing, round(n * CAST(sum(n) OVER () AS BIGINT) / (CAST(sum(n) OVER (PARTITION BY author) AS BIGINT) * CAST(sum(n) OVER (PARTITION BY thing) AS BIGINT)), 6) AS lift
FROM (SELECT c_nationkey AS author, {sql} AS thing, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2))) WHERE place <= 3)""" for f, sql in FACETS.items())


@query("l6_facet_combinations", f"""WITH {_LIFTS}, x AS (SELECT author, p.thing AS priority, s.thing AS segment, m.thing AS month, round(p.lift + s.lift + m.lift, 6) AS lift FROM priority p JOIN segment s USING (author) JOIN month m USING (author))
SELECT *, CAST(row_number() OVER (PARTITION BY author ORDER BY lift DESC, priority, segment, month) AS INTEGER) AS rank FROM x""")
def l6(spark: SparkSession, d: str) -> DataFrame:
    """The first three priorities, segments and months of each author (nation), combined."""
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    thing = {"priority": F.col("o_orderpriority"), "segment": F.col("c_mktsegment"), "month": F.left(F.col("o_orderdate").cast("string"), F.lit(7))}
    return recommend.combined_facets({f: recommend.facet_lift(o.select(F.col("c_nationkey").alias("author"), c.alias("thing"))) for f, c in thing.items()}, 3)


@query("m13_experiments", f"WITH {TELEMETRY_SQL}, p AS (SELECT DISTINCT did, channel, app FROM t) SELECT did, channel, x.name AS experiment FROM p JOIN (VALUES ('blue', 'ch0'), ('green', 'ch1')) x(name, channel) USING (channel)")
def m13(spark: SparkSession, d: str) -> DataFrame:
    p = events(spark, d).select("did", "channel", "app").distinct()
    definitions = spark.range(2).select(F.when(F.col("id") == 0, "blue").otherwise("green").alias("experiment"), F.concat(F.lit("ch"), "id").alias("wanted"))
    return recommend.assigned(p, definitions, F.col("channel") == F.col("wanted")).select("did", "channel", "experiment")


@query("m14_experiment_modulus")
def m14(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("uid").distinct().where(scalars.in_modulus(F.col("uid"), 4))


@query("m15_concept_similarity", """WITH RECURSIVE e AS (SELECT c_custkey AS u, lead(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS v FROM customer), b AS (SELECT u, v FROM e WHERE v IS NOT NULL UNION SELECT v, u FROM e WHERE v IS NOT NULL),
w(source, node, d) AS (SELECT DISTINCT u, u, 0 FROM b UNION SELECT w.source, b.v, w.d + 1 FROM w JOIN b ON b.u = w.node WHERE w.d < 5), m AS (SELECT source, node, min(d) AS d FROM w GROUP BY 1, 2),
n AS (SELECT count(DISTINCT u) AS n FROM b), x AS (SELECT CASE WHEN (SELECT count(*) FROM m) < n * n THEN 6 ELSE (SELECT max(d) FROM m) END AS most FROM n)
SELECT source, node, CAST(d AS INTEGER) AS d, round(1 - d / most, 4) AS similarity FROM m, x""")
def m15(spark: SparkSession, d: str) -> DataFrame:
    """Customers, each linked with the next one of its nation."""
    nxt = F.lead("c_custkey").over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    e = read(spark, d, "customer").select(F.col("c_custkey").alias("u"), nxt.alias("v")).where("v is not null")
    both = e.union(e.select("v", "u")).distinct()
    return recommend.similar_by_distance(both, both.select("u").distinct()).select("source", "node", "d", F.round("similarity", 4).alias("similarity"))


@query("m16_grade_coverage", """WITH g AS (SELECT p_brand AS concept, p_size % 3 AS grade, count(*) AS n FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#7') GROUP BY 1, 2), p AS (SELECT concept, coalesce(max(n) FILTER (grade = 0), 0) AS g0, coalesce(max(n) FILTER (grade = 1), 0) AS g1, coalesce(max(n) FILTER (grade = 2), 0) AS g2 FROM g GROUP BY 1),
e AS (SELECT DISTINCT p_brand AS concept, 'Brand#1' AS parent FROM part)
SELECT e.concept, coalesce(o.g0, q.g0, 0) AS grade_0, coalesce(o.g1, q.g1, 0) AS grade_1, coalesce(o.g2, q.g2, 0) AS grade_2 FROM e LEFT JOIN p o ON o.concept = e.concept LEFT JOIN p q ON q.concept = e.parent""")
def m16(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    rows = p.where("p_brand not in ('Brand#3', 'Brand#7')").select(F.col("p_brand").alias("concept"), (F.col("p_size") % 3).alias("grade"))
    return recommend.grade_coverage(rows, p.select(F.col("p_brand").alias("concept"), F.lit("Brand#1").alias("parent")).distinct(), [0, 1, 2])


@query("m17_relations", "SELECT s_nationkey AS author, p_brand AS content, count(*) AS edges, count(DISTINCT l_partkey) AS support FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2")
def m17(spark: SparkSession, d: str) -> DataFrame:
    li, s, p = (read(spark, d, t) for t in ("lineitem", "supplier", "part"))
    e = li.join(s, F.col("s_suppkey") == F.col("l_suppkey")).join(p, F.col("p_partkey") == F.col("l_partkey"))
    return e.groupBy(F.col("s_nationkey").alias("author"), F.col("p_brand").alias("content")).agg(F.count("*").alias("edges"), F.count_distinct("l_partkey").alias("support"))


@query("m18_pattern_counts", "SELECT r_name AS partner, count(DISTINCT n_nationkey) AS authors, count(DISTINCT s_suppkey) AS contents, count(DISTINCT l_partkey) AS assets FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1")
def m18(spark: SparkSession, d: str) -> DataFrame:
    r, n, s = (read(spark, d, t) for t in ("region", "nation", "supplier"))
    li = read(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    rows = r.join(n, F.col("n_regionkey") == F.col("r_regionkey")).join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(li, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows.groupBy(F.col("r_name").alias("partner")).agg(F.count_distinct("n_nationkey").alias("authors"), F.count_distinct("s_suppkey").alias("contents"), F.count_distinct("l_partkey").alias("assets"))


@query("m19_corpus_words", """WITH d AS (SELECT doc_id, text, regexp_matches(text, '^[\\x00-\\x7F]*$') AS ascii FROM documents),
w AS (SELECT doc_id, CASE WHEN ascii THEN list_transform(list_filter(regexp_split_to_array(regexp_replace(text, '[^A-Za-z]', ' ', 'g'), '\\s+'), lambda x: length(x) > 1 AND x NOT IN ({stop})), lambda x: lower(x)) ELSE list_filter(string_split(text, ' '), lambda x: x <> '') END AS ws FROM d)
SELECT doc_id, len(ws) AS n, md5(array_to_string(ws, ' ')) AS digest FROM w""".format(stop=", ".join(f"'{w}'" for w in recommend.STOP_WORDS)))
def m19(spark: SparkSession, d: str) -> DataFrame:
    ws = recommend.words(F.col("text"))
    return read(spark, d, "documents").select("doc_id", F.size(ws).cast("long").alias("n"), F.md5(F.array_join(ws, " ")).alias("digest"))


@query("m19_term_vectors")
def m19_vectors(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = recommend.term_vectors(read(spark, d, "documents").select("doc_id", "text"), "text", 512)
    return out.select("doc_id", F.size(F.filter(vector_to_array("vector"), lambda x: x > 0)).alias("terms"))


@query("m20_nearest_query", """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v),
p AS (SELECT a.vec_id AS query, b.vec_id AS id, list_inner_product(a.e, b.e) AS s FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 7)
SELECT query, id FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, id) AS r FROM p) WHERE r = 1""")
def m20(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), recommend.normalised(F.col("embedding")).alias("text_vec")).withColumn("tag_vec", F.array(F.lit(0.0)))
    return similar_pairs(v, v.where("id % 50 = 7"), 1.0, 1).select("query", "id")


def _spaces(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All documents as vectors: by latent semantic analysis, by topics, by the mean of their words."""
    return vectors.spaces(vectors.bags(read(spark, d, "documents"), "doc_id", "text").rows)


@query("m19_document_vectors")
def m19_spaces(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, space in _spaces(spark, d).items():
        part = space.select("id", F.lit(name).alias("space"), "vector")
        out = part if out is None else out.unionByName(part)
    return out


@query("m20_nearest_documents")
def m20_spaces(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other document in each space, for each document whose id is divisible by 50."""
    asked, out = read(spark, d, "documents").where("doc_id % 50 = 0").select(F.col("doc_id").alias("id")), None
    for name, space in _spaces(spark, d).items():
        part = vectors.nearest(space, asked).select("query", F.lit(name).alias("space"), "id")
        out = part if out is None else out.unionByName(part)
    return out


@query("m21_corpus", "SELECT source, lang, md5(string_agg(w, ' ' ORDER BY w)) AS digest, count(*) AS n FROM (SELECT DISTINCT source, lang, unnest(string_split_regex(text, '[^A-Za-z]+')) AS w FROM documents) WHERE w <> '' GROUP BY 1, 2")
def m21(spark: SparkSession, d: str) -> DataFrame:
    words = F.explode(F.split("text", "[^A-Za-z]+")).alias("word")
    rows = read(spark, d, "documents").select("source", "lang", words).where("word <> ''")
    return recommend.corpus(rows, "source", ["word"]).select("source", "lang", F.md5("document").alias("digest"), F.size(F.split("document", " ")).cast("long").alias("n"))


@query("u22_creation_metrics", "SELECT p_type AS template, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1")
def u22(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").groupBy(F.col("p_type").alias("template")).agg(F.count("*").alias("parts"), F.sum("p_size").alias("size"))


@query("u23_object_cache", "SELECT o_custkey AS id, arg_max(o_orderstatus, epoch_us(o_orderdate) * 100000 + o_orderkey) AS state, max(o_orderdate) IS NOT NULL AS dated FROM orders GROUP BY 1".replace("* 100000", "// 86400000000 * 10000000"))
def u23(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("state"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    return rollup.latest(rows, "id", "day", "o_orderkey").select("id", "state", F.col("day").isNotNull().alias("dated"))


@query("u24_content_model", f"""WITH {TELEMETRY_SQL}, a AS (SELECT content, count(*) AS plays FROM t WHERE eid = 'START' GROUP BY 1), b AS (SELECT content, count(*) AS ratings FROM t WHERE eid = 'INTERACT' GROUP BY 1)
SELECT content AS node, '{{"nodeUniqueId":"' || content || '","properties":{{"plays":{{"ov":null,"nv":' || coalesce(plays, 0) || '}},"ratings":{{"ov":null,"nv":' || coalesce(ratings, 0) || '}}}}}}' AS event FROM a FULL JOIN b USING (content)""")
def u24(spark: SparkSession, d: str) -> DataFrame:
    t = events(spark, d)
    n = lambda e, name: t.where(F.col("eid") == e).groupBy("content").agg(F.count("*").alias(name))
    return rollup.change_events(n("START", "plays").join(n("INTERACT", "ratings"), "content", "full").na.fill(0), "content", ["plays", "ratings"])


@query("u29_textbook_snapshot", "SELECT p_brand AS textbook, count(DISTINCT p_type) AS units, count(*) AS contents, CAST(count(*) // count(DISTINCT p_type) AS BIGINT) AS per_unit FROM part GROUP BY 1")
def u29(spark: SparkSession, d: str) -> DataFrame:
    out = read(spark, d, "part").groupBy(F.col("p_brand").alias("textbook")).agg(F.count_distinct("p_type").alias("units"), F.count("*").alias("contents"))
    return out.withColumn("per_unit", scalars.integer_average(F.col("contents"), F.col("units")))


@query("x5_rows_through_function", "SELECT event_id, upper(event_type) || ':' || event_id AS line FROM events")
def x5(spark: SparkSession, d: str) -> DataFrame:
    def run(batches):
        for b in batches:
            yield b.assign(line=b.event_type.str.upper() + ":" + b.event_id.astype(str))[["event_id", "line"]]

    return read(spark, d, "events").select("event_id", "event_type").mapInPandas(run, "event_id long, line string")
