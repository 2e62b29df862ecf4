"""Join, aggregate and report queries over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edutide.functions.scalars import ratio
from edutide.operators import joins, reports
from edutide.sources import io
from edutide.sources.shared import stored
from edutide.sources.telemetry import TELEMETRY_SQL, read

from .basics import events, registry

QUERIES: dict = {}
SQL: dict[str, str] = {}


query = registry(QUERIES, SQL)


def _spend(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


CENTS = "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)"
HALF = "o_orderdate {} TIMESTAMP '1998-01-01'"


@query("j1_state_join", f"""WITH n AS (SELECT o_custkey, count(*) AS orders, {CENTS} AS cents FROM orders WHERE {HALF.format('>=')} GROUP BY 1), p AS (SELECT o_custkey, count(*) AS old_orders FROM orders WHERE {HALF.format('<')} GROUP BY 1)
SELECT o_custkey, orders, cents, coalesce(old_orders, 0) AS old_orders FROM n LEFT JOIN p USING (o_custkey)""")
def j1(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    state = _spend(o.where("o_orderdate < '1998-01-01'")).select("o_custkey", F.col("orders").alias("old_orders"))
    return joins.with_state(_spend(o.where("o_orderdate >= '1998-01-01'")), state, ["o_custkey"], {"old_orders": 0})


@query("j2_full_outer", f"""WITH a AS (SELECT o_custkey AS k, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1)
SELECT k, coalesce(orders, 0) AS orders, coalesce(customers, 0) AS customers FROM a FULL JOIN b USING (k)""")
def j2(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").where("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    b = read(spark, d, "customer").where("c_acctbal > 0").groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("customers"))
    return joins.full_with_zeros(a, b, ["k"])


@query("j3_inner_conditions", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1")
def j3(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (read(spark, d, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, (c["c_nationkey"] == n["n_nationkey"]) & (n["n_regionkey"] == 1)).select("o_orderkey", "c_name", "n_name")


@query("j4_root_only", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def j4(spark: SparkSession, d: str) -> DataFrame:
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


@query("j5_not_root", "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey <> s_suppkey")
def j5(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    return joins.dealt_join(c, s, "nation", "c_custkey").where("c_custkey <> s_suppkey").select("c_custkey", "s_suppkey")


@query("j6_first_of_each", """WITH a AS (SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT l_partkey, a.l_orderkey AS returned, b.l_orderkey AS accepted FROM a FULL JOIN b USING (l_partkey)""")
def j6(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_returnflag")
    out = joins.first_of_each(li.where("l_returnflag = 'R'"), li.where("l_returnflag = 'A'"), "l_partkey", "l_orderkey", "l_orderkey")
    return out.select("l_partkey", F.col("left.l_orderkey").alias("returned"), F.col("right.l_orderkey").alias("accepted"))


@query("j7_pairs_but_self", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey")
def j7(spark: SparkSession, d: str) -> DataFrame:
    a, b = read(spark, d, "nation").alias("a"), read(spark, d, "nation").alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") != F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"))


@query("j8_dimension_lookup", "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_brand, s_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def j8(spark: SparkSession, d: str) -> DataFrame:
    li, p, s = (read(spark, d, t) for t in ("lineitem", "part", "supplier"))
    return li.join(p, li["l_partkey"] == p["p_partkey"], "left").join(s, li["l_suppkey"] == s["s_suppkey"], "left").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "p_brand", "s_name")


@query("j9_exploded_places", """WITH r AS (SELECT c_custkey, unnest([c_nationkey, (c_nationkey + 7) % 30, (c_nationkey + 3) % 30]) AS n_nationkey FROM customer)
SELECT c_custkey, n_nationkey, n_name FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY n_nationkey) AS r FROM r JOIN nation USING (n_nationkey)) WHERE r = 1""")
def j9(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_nationkey")
    out = joins.exploded_join(read(spark, d, "customer"), "c_custkey", F.array(k, (k + 7) % 30, (k + 3) % 30), read(spark, d, "nation"), "n_nationkey", "n_nationkey")
    return out.select("c_custkey", "n_nationkey", "n_name")


@query("j10_range_join", """WITH r AS (SELECT s_suppkey, s_suppkey * 3000 AS network_start, s_suppkey * 3000 + 1500 AS network_last FROM supplier),
p AS (SELECT event_id, user_id * 2048 + event_id % 2048 AS ip FROM events)
SELECT event_id, s_suppkey FROM p JOIN r ON ip BETWEEN network_start AND network_last""")
def j10(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey") * 3000
    ranges = read(spark, d, "supplier").select("s_suppkey", s.alias("network_start"), (s + 1500).alias("network_last"))
    n = F.col("user_id") * 2048 + F.col("event_id") % 2048
    text = F.concat_ws(".", *[F.floor(n / 256 ** (3 - i) % 256).cast("string") for i in range(4)])
    points = read(spark, d, "events").select("event_id", joins.ip_number(text).alias("ip"))
    return joins.range_join(points, "ip", ranges, "network_start", "network_last").select("event_id", "s_suppkey")


@query("j11_semi_join", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def j11(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return io.lookup(read(spark, d, "orders"), keys, ["o_orderkey"]).select("o_orderkey")


@query("s5_predicate_lookup", "SELECT p_partkey, p_brand FROM part WHERE p_size > 40 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def s5(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return io.lookup(io.resolver(spark, d)("part").where("p_size > 40"), keys, ["p_partkey"]).select("p_partkey", "p_brand")


@query("s9_json_document", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'view'")
def s9(spark: SparkSession, d: str) -> DataFrame:
    doc = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.when(F.col("event_type") == "view", "TextBook").otherwise("Other").alias("contentType")))
    rows = read(spark, d, "events").select("event_id", doc.alias("doc"))
    return io.hierarchy_column(rows, "doc", "k long, contentType string", "TextBook").select("event_id", "doc.k")


@query("s10_markup_ids", """SELECT page_id, len(list_distinct(regexp_extract_all(html, '(?i)\\b(?:id|href|src)\\s*=\\s*"([^"]+)"', 1) || regexp_extract_all(html, '"(?:id|asset)"\\s*:\\s*"([^"]+)"', 1))) AS assets FROM pages""")
def s10(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", F.size(io.markup_ids(F.col("html"))).cast("long").alias("assets"))


@query("s11_unbatch", f"WITH {TELEMETRY_SQL} SELECT mid, eid FROM t")
def s11(spark: SparkSession, d: str) -> DataFrame:
    batches = events(spark, d).groupBy("sid").agg(F.collect_list(F.struct("mid", "eid")).alias("events"))
    return io.unbatch(batches)


@query("s12_active_tags", f"WITH {TELEMETRY_SQL} SELECT mid, tag FROM (SELECT mid, unnest(tags) AS tag FROM t) WHERE tag IN ('t0', 't1', 't2')")
def s12(spark: SparkSession, d: str) -> DataFrame:
    tags = events(spark, d).select(F.explode("tags").alias("tag")).distinct().withColumn("active", F.col("tag").isin("t0", "t1", "t2"))
    return events(spark, d).select("mid", F.explode("tags").alias("tag")).join(io.active_tags(tags), "tag").select("mid", "tag")


@query("k6_time_series", "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS time, o_orderpriority AS tag, n AS tag_name, count(*) AS orders FROM orders LEFT JOIN (VALUES ('1-URGENT', 'urgent'), ('5-LOW', 'low')) v(p, n) ON p = o_orderpriority GROUP BY ALL".replace("n AS tag_name", "coalesce(n, o_orderpriority) AS tag_name"))
def k6(spark: SparkSession, d: str) -> DataFrame:
    names = read(spark, d, "orders").select(F.col("o_orderpriority").alias("tag")).distinct().where("tag in ('1-URGENT', '5-LOW')").withColumn("tag_name", F.lower(F.substring("tag", 3, 9)))
    rows = read(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_orderpriority").alias("tag")).agg(F.count("*").alias("orders"))
    out = io.time_series(rows, "day", ["tag"], ["orders"], names)
    return out.select("time", F.col("tags")["tag"].alias("tag"), F.col("tags")["tag_name"].alias("tag_name"), F.col("fields")["orders"].cast("long").alias("orders"))


@query("k7_upsert", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS segment, c_name FROM customer")
def k7(spark: SparkSession, d: str) -> DataFrame:
    stored = read(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), "c_name")
    new = read(spark, d, "customer").where("c_acctbal < 0").select("c_custkey", F.lit("DEBT").alias("segment"))
    return io.upsert(stored, new, ["c_custkey"], ["segment"])


@query("k10_change_events", """SELECT p_partkey AS node, '{"nodeUniqueId":' || p_partkey || ',"properties":{"brand":{"ov":null,"nv":"' || p_brand || '"}}}' AS event FROM part""")
def k10(spark: SparkSession, d: str) -> DataFrame:
    from edutide.operators.rollup import change_events

    return change_events(read(spark, d, "part").withColumnRenamed("p_brand", "brand"), "p_partkey", ["brand"])


MONTH = {"time": "o_orderdate", "granularity": "month", "dimensions": {"o_orderpriority": "priority"}}


@query("a2_guarded_ratios", "SELECT c_nationkey, count(*) AS n, CASE WHEN count(*) FILTER (c_acctbal < 0) = 0 THEN 0 ELSE round(count(*) * 1.0 / count(*) FILTER (c_acctbal < 0), 2) END AS per_debtor FROM customer GROUP BY 1")
def a2(spark: SparkSession, d: str) -> DataFrame:
    out = read(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("debtors"))
    return out.select("c_nationkey", "n", ratio(F.col("n"), F.col("debtors")).alias("per_debtor"))


@query("a3_distinct_collect", f"WITH {TELEMETRY_SQL} SELECT did, count(DISTINCT uid) AS users, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM t GROUP BY did")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy("did").agg(F.count_distinct("uid").alias("users"), F.array_join(F.array_sort(F.collect_set("page")), ",").alias("pages"))


@query("a5_first_last", f"WITH {TELEMETRY_SQL} SELECT uid, arg_min(content, ets * 1000000 + mid) AS first_content, arg_max(content, ets * 1000000 + mid) AS last_content FROM t GROUP BY uid")
def a5(spark: SparkSession, d: str) -> DataFrame:
    at = F.struct("ets", "mid")
    return events(spark, d).groupBy("uid").agg(F.min_by("content", at).alias("first_content"), F.max_by("content", at).alias("last_content"))


@query("a7_histogram", f"WITH {TELEMETRY_SQL} SELECT eid, channel, page, count(*) AS count FROM t GROUP BY ALL")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy("eid", "channel", "page").count()


@query("a9_aggregations", """SELECT o_orderpriority AS priority, 'all' AS date, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS long_sum, max(o_totalprice) AS top, min(o_totalprice) AS low,
  first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS first, last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS last, first(o_totalprice ORDER BY o_orderdate, o_totalprice) AS first_price, count(DISTINCT o_custkey) AS exact, true AS hyper_near, true AS theta_near FROM orders GROUP BY 1""")
def a9(spark: SparkSession, d: str) -> DataFrame:
    """The two sketches are held to within a twentieth of the exact count."""
    q = {**MONTH, "granularity": "all", "aggregations": [("count", None, "n"), ("longSum", "o_custkey", "long_sum"), ("doubleMax", "o_totalprice", "top"), ("doubleMin", "o_totalprice", "low"), ("longFirst", "o_orderkey", "first"), ("longLast", "o_orderkey", "last"), ("doubleFirst", "o_totalprice", "first_price"), ("hyperUnique", "o_custkey", "customers"), ("thetaSketch", "o_custkey", "customers2")]}
    orders = read(spark, d, "orders")
    exact = orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count_distinct("o_custkey").alias("exact"))
    near = lambda c: F.abs(F.col(c) - F.col("exact")) <= 0.05 * F.col("exact")
    return reports.group_report(orders, q).join(exact, "priority").withColumn("hyper_near", near("customers")).withColumn("theta_near", near("customers2")).drop("customers", "customers2")


@query("a10_post_aggregations", "SELECT 'all' AS date, o_orderstatus AS status, count(*) AS n, max(o_totalprice) AS top, max(o_totalprice) / count(*) AS per, count(*) + 1 AS plus, CAST(0 AS DOUBLE) AS zero FROM orders GROUP BY 2")
def a10(spark: SparkSession, d: str) -> DataFrame:
    q = {"time": "o_orderdate", "dimensions": {"o_orderstatus": "status"}, "aggregations": [("count", None, "n"), ("doubleMax", "o_totalprice", "top")], "post": [("per", "/", "top", "n"), ("plus", "+", "n", 1), ("zero", "/", "top", 0)]}
    return reports.group_report(read(spark, d, "orders"), q).select("date", "status", "n", "top", "per", F.col("plus").cast("long").alias("plus"), "zero")


@query("a11_group_report", "SELECT strftime(o_orderdate, '%Y-%m') || '-01' AS date, o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2 HAVING count(*) > 5")
def a11(spark: SparkSession, d: str) -> DataFrame:
    q = {**MONTH, "filters": [{"type": "equals", "dimension": "o_orderstatus", "value": "F"}], "aggregations": [("count", None, "n")], "having": [("greaterThan", "n", 5)]}
    return reports.group_report(read(spark, d, "orders"), q)


@query("a12_top_report", """SELECT date, part, n FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY n DESC, part) AS r FROM (SELECT strftime(l_shipdate, '%Y') || '-01-01' AS date, l_partkey AS part, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE r <= 10""")
def a12(spark: SparkSession, d: str) -> DataFrame:
    q = {"time": "l_shipdate", "granularity": "year", "dimensions": {"l_partkey": "part"}, "aggregations": [("count", None, "n")]}
    return reports.top_report(read(spark, d, "lineitem"), q, "n", 10)


@query("a13_time_report", """SELECT strftime(day, '%Y-%m-%d') AS date, count(o_orderkey) AS n FROM (SELECT CAST(unnest(range(DATE '1995-01-01', DATE '1995-03-01', INTERVAL 1 DAY)) AS DATE) AS day)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1""")
def a13(spark: SparkSession, d: str) -> DataFrame:
    rare = [{"type": "equals", "dimension": "o_orderstatus", "value": "P"}, {"type": "equals", "dimension": "o_orderpriority", "value": "1-URGENT"}]
    return reports.time_report(read(spark, d, "orders"), {"time": "o_orderdate", "granularity": "day", "filters": rare, "aggregations": [("count", None, "n")]}, "1995-01-01", "1995-02-28")


@query("a14_normalised", "SELECT CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE c_mktsegment END AS segment, round(max(c_acctbal) + 0.001, 2) AS top FROM customer GROUP BY 1")
def a14(spark: SparkSession, d: str) -> DataFrame:
    segment = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment")
    return reports.normalised(read(spark, d, "customer").groupBy(segment).agg((F.max("c_acctbal") + 0.001).alias("top")))


@query("a15_named_interval", """SELECT 'Last7Days' AS name, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-10' - 7 AND DATE '1998-06-10' - 1
UNION ALL SELECT 'LastWeek', count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-07'
UNION ALL SELECT 'LastMonth', count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'""")
def a15(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("Last7Days", "LastWeek", "LastMonth"):
        part = reports.group_report(read(spark, d, "orders"), {"time": "o_orderdate", "interval": name, "aggregations": [("count", None, "n")]}, "1998-06-10").select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("a16_multi_report", """WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') || '-01' AS date, o_orderpriority AS priority, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2), b AS (SELECT strftime(o_orderdate, '%Y-%m') || '-01' AS date, o_orderpriority AS priority, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT date, priority, orders, top FROM a FULL JOIN b USING (date, priority)""")
def a16(spark: SparkSession, d: str) -> DataFrame:
    status = lambda v: [{"type": "equals", "dimension": "o_orderstatus", "value": v}]
    o = read(spark, d, "orders")
    a = reports.group_report(o, {**MONTH, "filters": status("O"), "aggregations": [("count", None, "orders")]})
    b = reports.group_report(o, {**MONTH, "filters": status("F"), "aggregations": [("doubleMax", "o_totalprice", "top")]})
    return reports.multi_report([a, b], ["date", "priority"])


@query("a17_nested_means", f"WITH {TELEMETRY_SQL}, m AS (SELECT uid, eid, CAST(sum(k) AS BIGINT) AS s, count(*) AS n FROM t GROUP BY 1, 2) SELECT uid, array_to_string(list(eid || '=' || CAST(s // n AS VARCHAR) ORDER BY eid), ',') AS means FROM m GROUP BY uid")
def a17(spark: SparkSession, d: str) -> DataFrame:
    inner = events(spark, d).groupBy("uid", "eid").agg(F.floor(F.sum("k") / F.count("*")).cast("string").alias("mean"))
    return inner.groupBy("uid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("eid", "mean"))), lambda x: F.concat_ws("=", x["eid"], x["mean"])), ",").alias("means"))


@query("a19_durations", "SELECT event_type AS request, count(*) AS count, min(CAST(value * 100 AS BIGINT)) AS min_ms, max(CAST(value * 100 AS BIGINT)) AS max_ms, round(sum(CAST(value * 100 AS BIGINT)) / count(*), 2) AS avg_ms FROM events GROUP BY 1".replace("CAST(value * 100 AS BIGINT)", "CAST(floor(value * 100) AS BIGINT)"))
def a19(spark: SparkSession, d: str) -> DataFrame:
    from edutide.operators.summaries import durations

    log = read(spark, d, "events").select(F.col("event_type").alias("request"), F.floor(F.col("value") * 100).alias("ms"))
    return durations(log, "request", "ms")


@query("a20_lifecycle_times", """WITH c AS (SELECT o_custkey, CASE o_orderstatus WHEN 'O' THEN 'Draft' WHEN 'F' THEN 'Review' ELSE 'Live' END AS status, epoch_us(o_orderdate) // 1000 AS ms FROM orders),
n AS (SELECT *, lead(ms) OVER (PARTITION BY o_custkey ORDER BY ms, status) - ms AS spent FROM c)
SELECT o_custkey, CAST(coalesce(sum(spent) FILTER (status = 'Draft'), 0) AS BIGINT) AS draft_ms, CAST(coalesce(sum(spent) FILTER (status = 'Review'), 0) AS BIGINT) AS review_ms FROM n GROUP BY 1""")
def a20(spark: SparkSession, d: str) -> DataFrame:
    from edutide.functions.time import millis
    from edutide.operators.rollup import lifecycle_times

    status = F.when(F.col("o_orderstatus") == "O", "Draft").when(F.col("o_orderstatus") == "F", "Review").otherwise("Live")
    return lifecycle_times(read(spark, d, "orders").select("o_custkey", status.alias("status"), millis("o_orderdate").alias("ms")), "o_custkey", "status", "ms")


@query("a21_pivot", "SELECT c_nationkey, max(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS \"BUILDING\", max(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS \"MACHINERY\" FROM customer GROUP BY 1")
def a21(spark: SparkSession, d: str) -> DataFrame:
    best = read(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.max("c_acctbal").alias("score"))
    return reports.pivoted(best, ["c_nationkey"], "c_mktsegment", "score", ["BUILDING", "MACHINERY"])


@query("l1_sort_by_text", "SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(CAST(o_custkey AS VARCHAR), ''), o_orderkey) AS place FROM orders")
def l1(spark: SparkSession, d: str) -> DataFrame:
    # A row's place in the global order, from a range partitioning: Spark's sort, without a window over everything.
    rows = read(spark, d, "orders").select("o_orderkey", F.coalesce(F.col("o_custkey").cast("string"), F.lit("")).alias("as_text"))
    # It is written once, so that both uses below see the same parts.
    ordered = rows.repartitionByRange("as_text", "o_orderkey").sortWithinPartitions("as_text", "o_orderkey").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id() % (1 << 33))
    ordered = stored(ordered, "ordered")
    # A row for each part: as many as the shuffle has partitions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ordered.join(F.broadcast(offsets), "part").select("o_orderkey", (F.col("before") + F.col("at") + 1).alias("place"))


@query("o1_union_all", "SELECT o_orderkey AS id, 'o' AS kind FROM orders UNION ALL SELECT c_custkey, 'c' FROM customer")
def o1(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("o").alias("kind")).unionByName(read(spark, d, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id")))


@query("o2_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def o2(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("o3_array_sets", f"WITH {TELEMETRY_SQL}, a AS (SELECT uid, list(DISTINCT page) FILTER (eid = 'IMPRESSION') AS p, list(DISTINCT page) FILTER (eid = 'INTERACT') AS q FROM t GROUP BY uid) SELECT uid, array_to_string(list_sort(list_intersect(p, q)), ',') AS both_, CAST(len(list_distinct(list_concat(p, q))) AS INTEGER) AS either, array_to_string(list_sort(list_filter(p, lambda x: NOT list_contains(q, x))), ',') AS only_seen FROM a WHERE p IS NOT NULL AND q IS NOT NULL")
def o3(spark: SparkSession, d: str) -> DataFrame:
    sets = events(spark, d).groupBy("uid").agg(F.collect_set(F.when(F.col("eid") == "IMPRESSION", F.col("page"))).alias("p"), F.collect_set(F.when(F.col("eid") == "INTERACT", F.col("page"))).alias("q")).where("size(p) > 0 and size(q) > 0")
    text = lambda c: F.array_join(F.array_sort(c), ",")
    return sets.select("uid", text(F.array_intersect("p", "q")).alias("both_"), F.size(F.array_union("p", "q")).alias("either"), text(F.array_except("p", "q")).alias("only_seen"))
