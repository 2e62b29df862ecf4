"""Scans and sinks as round trips through the shared folder, and products that other queries' operators make up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.functions.scalars import ratio
from edutide.operators import recommend, rollup, sessions, summaries
from edutide.operators.cube import all_cube
from edutide.sources import io
from edutide.sources.shared import shared_folder
from edutide.sources.telemetry import TELEMETRY_SQL, read

from .basics import events, registry
from .sequences import PLAYS_SQL, R2
from .usage import plays

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = registry(QUERIES, SQL)


def _folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/edutide/{what}-{uuid.uuid4().hex}"


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


ALL_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


@query("s1_json_scan", ALL_ORDERS)
def s1(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines out, with lines that are no JSON among them, and in again by schema."""
    path = _folder(spark, "json")
    io.write_json_lines(_orders(spark, d), path)
    _orders(spark, d).where("o_orderkey % 100 = 0").select(F.concat(F.lit("{broken "), F.col("o_orderkey").cast("string")).alias("value")).write.mode("append").text(path)
    return io.json_events(spark, [path], ORDERS)


@query("s1_dropped_lines", "SELECT o_orderkey % 100 = 0 AS bad, count(*) AS n FROM orders GROUP BY 1")
def s1_dropped(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "json")
    o = _orders(spark, d)
    io.write_json_lines(o.where("o_orderkey % 100 <> 0"), path)
    o.where("o_orderkey % 100 = 0").select(F.lit("{broken").alias("value")).write.mode("append").text(path)
    return io.malformed(spark, [path], ORDERS).select("bad", F.col("count").alias("n"))


@query("k3_gzip_sink", ALL_ORDERS)
def k3(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "gzip")
    io.write_json_lines(_orders(spark, d), path, "gzip")
    return io.json_events(spark, [path], ORDERS)


@query("s7_csv_scan", ALL_ORDERS)
def s7(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "csv")
    _orders(spark, d).write.option("header", True).csv(path)
    return io.csv(spark, path, ORDERS)


@query("s8_dimensions", "SELECT p_brand, count(*) AS lines FROM lineitem JOIN part ON p_partkey = l_partkey AND p_size > 25 GROUP BY 1")
def s8(spark: SparkSession, d: str) -> DataFrame:
    dims = io.resolver(spark, d)("part").where("p_size > 25").select("p_partkey", "p_brand")
    return read(spark, d, "lineitem").join(dims, F.col("p_partkey") == F.col("l_partkey")).groupBy("p_brand").agg(F.count("*").alias("lines"))


@query("k5_versioned_publish", ALL_ORDERS + " WHERE o_orderstatus = 'F'")
def k5(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark, "index")
    io.publish(_orders(spark, d), folder, "orders", "1")
    io.publish(_orders(spark, d).where("o_orderstatus = 'F'"), folder, "orders", "2")
    return io.published(spark, folder, "orders")


@query("k9_keyed_views", "SELECT o_orderkey, o_orderpriority FROM orders")
def k9(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "views")
    io.write_views(_orders(spark, d).select("o_orderkey", "o_orderpriority"), path, "o_orderpriority")
    return spark.read.schema("o_orderkey long, o_orderpriority string").json(path).select("o_orderkey", "o_orderpriority")


@query("k11_multi_sink", "SELECT sink, count(*) AS n FROM orders, (VALUES ('json'), ('table')) v(sink) GROUP BY 1")
def k11(spark: SparkSession, d: str) -> DataFrame:
    a, b = _folder(spark, "multi"), _folder(spark, "multi")
    io.dispatch(_orders(spark, d), [lambda df: io.write_json_lines(df, a), lambda df: df.write.parquet(b)])
    counted = lambda df, name: df.groupBy(F.lit(name).alias("sink")).agg(F.count("*").alias("n"))
    return counted(io.json_events(spark, [a], ORDERS), "json").unionByName(counted(spark.read.parquet(b), "table"))


@query("a1_keyed_groups", f"WITH {TELEMETRY_SQL} SELECT did, channel, count(*) AS n, min(ets) AS first_ms, max(ets) AS last_ms, CAST(sum(score) AS BIGINT) AS score FROM t GROUP BY 1, 2")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy("did", "channel").agg(F.count("*").alias("n"), F.min("ets").alias("first_ms"), F.max("ets").alias("last_ms"), F.sum("score").alias("score"))


@query("a8_weighted_averages", f"WITH {PLAYS_SQL} SELECT content, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS total_sessions, round(sum(ms) / 1000 / count(*), 2) AS average FROM s GROUP BY 1")
def a8(spark: SparkSession, d: str) -> DataFrame:
    """Averages of days are combined through their totals."""
    days = plays(spark, d).groupBy("period", "content").agg(F.sum("ms").alias("total_ms"), F.count("*").alias("total_sessions"))
    out = rollup.merge(days.drop("period"), None, ["content"], {"total_ms": "sum", "total_sessions": "sum"})
    return out.withColumn("average", ratio(F.col("total_ms") / 1000, F.col("total_sessions")))


@query("a18_active_hour", f"""WITH {PLAYS_SQL}, h AS (SELECT uid, unnest(range(a, e + 1)) % 24 AS hour FROM (SELECT uid, start_ms // 3600000 % 24 AS a, end_ms // 3600000 % 24 + CASE WHEN end_ms // 3600000 % 24 < start_ms // 3600000 % 24 THEN 24 ELSE 0 END AS e FROM s))
SELECT uid, CAST(hour AS INTEGER) AS active_hour FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY n DESC, hour) AS r FROM (SELECT uid, hour, count(*) AS n FROM h GROUP BY 1, 2)) WHERE r = 1""")
def a18(spark: SparkSession, d: str) -> DataFrame:
    return summaries.learner_activity(plays(spark, d)).select("uid", "active_hour")


@query("l2_recent_contents", f"""WITH {PLAYS_SQL}, rc AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY e DESC, content) AS r FROM (SELECT uid, content, max(end_ms) AS e FROM s GROUP BY 1, 2))
SELECT uid, string_agg(content, ',' ORDER BY r) AS last_contents FROM rc WHERE r <= 3 GROUP BY 1""")
def l2(spark: SparkSession, d: str) -> DataFrame:
    return summaries.learner_activity(plays(spark, d), 3).select("uid", "last_contents")


@query("l3_top_incorrect", f"""WITH {TELEMETRY_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY n DESC, page) AS r FROM (SELECT content, page, count(*) AS n FROM t WHERE eid IN ('INTERACT', 'END') AND score = 0 GROUP BY 1, 2))
SELECT content, page, n, CAST(r AS INTEGER) AS rank FROM w WHERE r <= 5""")
def l3(spark: SparkSession, d: str) -> DataFrame:
    wrong = summaries.items(events(spark, d)).where("not pass").groupBy("content", F.col("resvalues")[0]["ans"].alias("page")).agg(F.count("*").alias("n"))
    return recommend.ranked(wrong, "content", [F.desc("n"), F.col("page")], 5)


@query("g22_recommendation_use", f"""WITH {TELEMETRY_SQL}, m AS (SELECT *, count(CASE WHEN eid = 'START' THEN 1 END) OVER (PARTITION BY did, channel ORDER BY ets, mid) AS call FROM t),
c AS (SELECT did, channel, call, count(*) FILTER (eid = 'IMPRESSION') AS shown, count(*) FILTER (eid = 'END') AS plays FROM m WHERE call > 0 GROUP BY 1, 2, 3)
SELECT channel, count(*) AS calls, CAST(sum(shown) AS BIGINT) AS shown, CAST(sum(CAST(plays > 0 AS INTEGER)) AS BIGINT) AS consumed FROM c GROUP BY 1""")
def g22(spark: SparkSession, d: str) -> DataFrame:
    calls = sessions.recommendation_funnel(events(spark, d), ["did", "channel"])
    return calls.groupBy("channel").agg(F.count("*").alias("calls"), F.sum("shown").alias("shown"), F.sum("consumed").alias("consumed"))


@query("g23_screen_timings", f"""WITH {TELEMETRY_SQL}, f AS (SELECT *, min(ets) OVER (PARTITION BY uid) AS first FROM t),
m AS (SELECT uid, row_number() OVER w AS i, ets - coalesce(lag(ets) OVER w, first) AS ms FROM f WHERE eid = 'END' WINDOW w AS (PARTITION BY uid ORDER BY ets, mid))
SELECT uid, {', '.join(R2.format(f'max(ms) FILTER (i = {i})') + f' AS page{i}' for i in (1, 2))} FROM m WHERE i <= 2 GROUP BY uid""")
def g23(spark: SparkSession, d: str) -> DataFrame:
    return sessions.nth_in_session(events(spark, d), ["uid"], "END", 2)


@query("g25_api_usage", "SELECT event_type || '/' || user_id % 10 AS api, count(*) AS count, min(CAST(floor(value * 100) AS BIGINT)) AS min_ms, max(CAST(floor(value * 100) AS BIGINT)) AS max_ms, round(sum(CAST(floor(value * 100) AS BIGINT)) / count(*), 2) AS avg_ms FROM events GROUP BY 1")
def g25(spark: SparkSession, d: str) -> DataFrame:
    log = read(spark, d, "events").select(F.concat_ws("/", "event_type", (F.col("user_id") % 10).cast("string")).alias("api"), F.floor(F.col("value") * 100).alias("ms"))
    return summaries.durations(log, "api", "ms")


@query("g27_concept_snapshot", "WITH a AS (SELECT p_type AS concept, count(*) AS contents FROM part GROUP BY 1), b AS (SELECT p_type AS concept, count(*) AS live FROM part WHERE p_size > 40 AND p_type <> 'ECONOMY' GROUP BY 1) SELECT concept, coalesce(contents, 0) AS contents, coalesce(live, 0) AS live FROM a FULL JOIN b USING (concept)")
def g27(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").withColumnRenamed("p_type", "concept")
    a, b = p.groupBy("concept").agg(F.count("*").alias("contents")), p.where("p_size > 40 and concept <> 'ECONOMY'").groupBy("concept").agg(F.count("*").alias("live"))
    return a.join(b, "concept", "full").na.fill(0)


@query("g28_asset_snapshot", """WITH u AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'), x AS (SELECT p_brand AS kind, count(*) AS total, count(l_partkey) AS used FROM part LEFT JOIN u ON l_partkey = p_partkey GROUP BY 1)
SELECT * FROM x UNION ALL SELECT 'all', CAST(sum(total) AS BIGINT), CAST(sum(used) AS BIGINT) FROM x""")
def g28(spark: SparkSession, d: str) -> DataFrame:
    used = read(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_partkey").distinct()
    rows = read(spark, d, "part").join(used, F.col("l_partkey") == F.col("p_partkey"), "left").withColumnRenamed("p_brand", "kind")
    return all_cube(rows, [], ["kind"], [F.count("*").alias("total"), F.count("l_partkey").alias("used")]).drop("tag")


@query("g30_group_content_usage", f"WITH {PLAYS_SQL} SELECT content, right(uid, 1) = '7' AS group_user, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS sessions FROM s GROUP BY 1, 2")
def g30(spark: SparkSession, d: str) -> DataFrame:
    group = (F.substring("uid", -1, 1) == "7").alias("group_user")
    return plays(spark, d).groupBy("content", group).agg(F.sum("ms").alias("total_ms"), F.count("*").alias("sessions"))


@query("u21_creation_metrics", """WITH b AS (SELECT page_id % 20 AS content, len(list_distinct(regexp_extract_all(html, '(?i)\\b(?:id|href|src)\\s*=\\s*"([^"]+)"', 1) || regexp_extract_all(html, '"(?:id|asset)"\\s*:\\s*"([^"]+)"', 1))) AS assets FROM pages)
SELECT content, count(*) AS versions, CAST(sum(assets) AS BIGINT) AS assets FROM b GROUP BY 1""")
def u21(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "pages").select((F.col("page_id") % 20).alias("content"), F.size(io.markup_ids(F.col("html"))).alias("assets"))
    return rows.groupBy("content").agg(F.count("*").alias("versions"), F.sum("assets").alias("assets"))


@query("x3_mapped_columns", f"WITH {TELEMETRY_SQL} SELECT mid, CAST(ets // 1000 AS BIGINT) AS seconds, lower(eid) AS eid FROM t")
def x3(spark: SparkSession, d: str) -> DataFrame:
    mapped = {"ets": lambda c: F.floor(c / 1000), "eid": F.lower}
    return io.flatten(events(spark, d).select("mid", "ets", "eid"), renamed={"ets": "seconds"}, mapped=mapped)


@query("s3_file_list", ALL_ORDERS)
def s3(spark: SparkSession, d: str) -> DataFrame:
    """S3: a list of places, each scanned as JSON lines, as one frame."""
    o = _orders(spark, d)
    paths = [_folder(spark, f"list-{i}") for i in range(3)]
    for i, path in enumerate(paths):
        io.write_json_lines(o.where(F.col("o_orderkey") % 3 == i), path)
    return io.json_events(spark, paths, ORDERS)


@query("s4_empty_source", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def s4(spark: SparkSession, d: str) -> DataFrame:
    """A product over a source of type none beside one with rows."""
    return _orders(spark, d).unionByName(io.empty(spark, ORDERS)).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("k1_console_sink", "SELECT count(*) AS n FROM orders")
def k1(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    return spark.createDataFrame([(io.write_console(o),)], "n long")
