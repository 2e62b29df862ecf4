"""Filters, projections, scalar functions, sources and sinks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.functions import filters, scalars, time
from edutide.sources import io
from edutide.sources.telemetry import REGISTERED_TAGS, TELEMETRY_SQL, read, telemetry

QUERIES: dict = {}
SQL: dict[str, str] = {}


def exact_rounds(sql: str) -> str:
    """round(x, 2) of doubles as Spark has it: half up on the decimal digits that a double is written with."""
    at = 0
    while (at := sql.find("round(", at)) >= 0:
        depth, end = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[at + 6 : end - 1]
        if inner.endswith(", 2"):
            sql = f"{sql[:at]}CAST(round(CAST({inner[:-3]} AS DECIMAL(30, 10)), 2) AS DOUBLE){sql[end:]}"
            at += len("CAST(round(")
        else:
            at += 6
    return sql


def registry(queries: dict, sqls: dict[str, str]):
    """A decorator that registers a query of (spark, folder) under a name, with its SQL."""

    def query(name: str, sql: str | None = None):
        def add(f):
            queries[name] = f
            if sql:
                sqls[name] = exact_rounds(sql)
            return f

        return add

    return query


query = registry(QUERIES, SQL)


def events(spark: SparkSession, d: str) -> DataFrame:
    return telemetry(read(spark, d, "events"))


#: Filter queries: name -> (description, the same condition in SQL).
CASES = {
    "f1_eq": ({"name": "eid", "operator": "EQ", "value": "START"}, "eid = 'START'"),
    "f2_ne": ({"name": "eid", "operator": "NE", "value": "START"}, "eid IS NOT NULL AND eid <> 'START'"),
    "f3_in": ({"name": "content", "operator": "IN", "value": ["c1", "c2"]}, "content IN ('c1', 'c2')"),
    "f3_in_list": ({"name": "tags", "operator": "IN", "value": ["t1"]}, "list_has_all(tags, ['t1'])"),
    "f4_nin": ({"name": "page", "operator": "NIN", "value": ["p1", "p2"]}, "NOT coalesce(page IN ('p1', 'p2'), false)"),
    "f5_isnull": ({"name": "content", "operator": "ISNULL"}, "content IS NULL"),
    "f6_isnotnull": ({"name": "content", "operator": "ISNOTNULL"}, "content IS NOT NULL"),
    "f7_isempty": ({"name": "page", "operator": "ISEMPTY"}, "page IS NULL OR page = ''"),
    "f8_isnotempty": ({"name": "page", "operator": "ISNOTEMPTY"}, "page <> ''"),
    "f9_range": ({"name": "value", "operator": "RANGE", "value": {"start": 5.0, "end": 10.0}}, "value >= 5.0 AND value <= 10.0"),
    "f10_lt": ({"name": "value", "operator": "LT", "value": 3.0}, "value < 3.0"),
}


def _filter_query(f: dict):
    return lambda spark, d: filters.where_all(events(spark, d), [f]).select("mid", "eid", "uid", "value")


for _name, (_f, _sql) in CASES.items():
    query(_name, f"WITH {TELEMETRY_SQL} SELECT mid, eid, uid, value FROM t WHERE {_sql}")(_filter_query(_f))


@query("f11_filter_chain", f"WITH {TELEMETRY_SQL} SELECT mid, uid, ets FROM t WHERE eid IN ('IMPRESSION', 'INTERACT') AND value >= 2.0 AND value <= 20.0 AND NOT coalesce(content IN ('c3'), false)")
def f11(spark: SparkSession, d: str) -> DataFrame:
    chain = [{"name": "eventId", "operator": "IN", "value": ["IMPRESSION", "INTERACT"]}, {"name": "value", "operator": "RANGE", "value": {"start": 2.0, "end": 20.0}}, {"name": "gameId", "operator": "NIN", "value": ["c3"]}]
    return filters.where_all(events(spark, d), chain).select("mid", "uid", "ets")


@query("f12_aliases", f"WITH {TELEMETRY_SQL} SELECT eid AS event_id, ets AS event_ts, content AS game_id, uid AS user_id, sid AS session_id FROM t")
def f12(spark: SparkSession, d: str) -> DataFrame:
    names = {"eventId": "event_id", "eventts": "event_ts", "gameId": "game_id", "userId": "user_id", "sessionId": "session_id"}
    return events(spark, d).select(*[filters.field(k).alias(v) for k, v in names.items()])


@query("f13_value_predicate", f"WITH {TELEMETRY_SQL} SELECT mid, value FROM t WHERE value > 12.5 AND eid = 'INTERACT'")
def f13(spark: SparkSession, d: str) -> DataFrame:
    return filters.where_value(events(spark, d), 12.5, lambda v: (F.col("value") > v) & (F.col("eid") == "INTERACT")).select("mid", "value")


@query("f14_report_filters", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 AND o_totalprice < 200000 AND o_orderpriority LIKE '%-H%' AND regexp_matches(o_orderpriority, '^[12]') AND contains(lower(o_orderpriority), 'high') AND o_orderstatus <> 'P' AND o_orderstatus IN ('O', 'F') AND o_custkey IS NOT NULL")
def f14(spark: SparkSession, d: str) -> DataFrame:
    wanted = [("greaterthan", "o_totalprice", 1000), ("lessthan", "o_totalprice", 200000), ("like", "o_orderpriority", "%-H%"), ("regex", "o_orderpriority", "^[12]"), ("containsignorecase", "o_orderpriority", "HIGH"), ("notequals", "o_orderstatus", "P"), ("in", "o_orderstatus", ["O", "F"]), ("isnotnull", "o_custkey", None)]
    return filters.report_where(read(spark, d, "orders"), [{"type": t, "dimension": c, "value": v} for t, c, v in wanted]).select("o_orderkey", "o_totalprice")


@query("f15_having", "SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1 HAVING count(*) > 10 AND count(*) < 1000000 AND o_orderpriority <> '5-LOW'")
def f15(spark: SparkSession, d: str) -> DataFrame:
    out = read(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return out.where(filters.HAVING["greaterThan"](F.col("n"), 10) & filters.HAVING["lessThan"](F.col("n"), 1000000) & filters.HAVING["not"](F.col("o_orderpriority"), "5-LOW"))


@query("f16_export_filter", f"WITH {TELEMETRY_SQL} SELECT mid, eid, channel FROM t WHERE channel = 'ch1' AND eid IN ('START', 'END') AND list_has_all(tags, ['t2']) AND ets >= 1704067200000 AND ets <= 1706745600000")
def f16(spark: SparkSession, d: str) -> DataFrame:
    request = {"channel": "ch1", "events": ["START", "END"], "tags": ["t2"], "app_id": None, "start_ms": 1704067200000, "end_ms": 1706745600000}
    return filters.where_all(events(spark, d), filters.export_filters(request)).select("mid", "eid", "channel")


@query("p1_csv_fields", f"WITH {TELEMETRY_SQL} SELECT mid, uid, '[' || array_to_string(list_transform(tags, lambda x: '\"' || x || '\"'), ',') || ']' AS tags FROM t")
def p1(spark: SparkSession, d: str) -> DataFrame:
    return io.csv_fields(events(spark, d), "mid,uid,tags")


@query("p3_time_of_millis", f"WITH {TELEMETRY_SQL} SELECT mid, strftime(epoch_ms(ets + 19800000), '%Y-%m-%d %H:%M:%S') AS local_time FROM t")
def p3(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("mid", F.date_format(time._ntz(F.col("ets") + time.DAY_OFFSET_MS), "yyyy-MM-dd HH:mm:ss").alias("local_time"))


@query("p4_struct_to_map", f"WITH {TELEMETRY_SQL} SELECT mid, CAST(json_object('uid', uid, 'eid', eid, 'content', content) AS VARCHAR) AS as_map FROM t")
def p4(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("mid", F.to_json(F.create_map(F.lit("uid"), F.col("uid"), F.lit("eid"), F.col("eid"), F.lit("content"), F.col("content"))).alias("as_map"))


@query("c1_parse_time", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 0 ELSE epoch_us(ts) // 1000000 * 1000 END AS ms FROM events")
def c1(spark: SparkSession, d: str) -> DataFrame:
    ts, i = F.col("ts").cast("timestamp_ntz"), F.col("event_id") % 4
    text = F.when(i == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(i == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(i == 2, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+junk"))).otherwise("not a time")
    return read(spark, d, "events").select("event_id", (time.parse_millis(text) + 0).alias("ms"))


@query("c2_time_diff", f"WITH {TELEMETRY_SQL} SELECT uid, (max(ets) - min(ets)) / 1000 AS seconds FROM t GROUP BY uid")
def c2(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy("uid").agg(time.seconds_between(F.min("ets"), F.max("ets")).alias("seconds"))


@query("c3_round", "SELECT p_partkey, round(p_retailprice / 7, 1) AS rounded FROM part")
def c3(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", F.round(F.col("p_retailprice") / 7, 1).alias("rounded"))


@query("c4_periods", f"""WITH {TELEMETRY_SQL} SELECT mid, CAST(strftime(epoch_ms(ets + 19800000), '%Y%m%d') AS INTEGER) AS day, CAST(isoyear(epoch_ms(ets)) * 1000 + 700 + week(epoch_ms(ets)) AS INTEGER) AS week,
  CAST(strftime(epoch_ms(ets + 19800000), '%Y%m') AS INTEGER) AS month, 0 AS cumulative FROM t""")
def c4(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("mid", *[time.period(F.col("ets"), k).alias(k.lower()) for k in time.PERIODS])


@query("c5_period_lists", """WITH m AS (SELECT CAST(max(ts) AS DATE) AS day FROM events)
SELECT 'day' AS kind, CAST(strftime(day - CAST(i AS INTEGER), '%Y%m%d') AS INTEGER) AS period FROM m, range(1, 8) r(i)
UNION ALL SELECT 'week', CAST(isoyear(day - 7 * CAST(i AS INTEGER)) * 1000 + 700 + week(day - 7 * CAST(i AS INTEGER)) AS INTEGER) FROM m, range(0, 5) r(i)
UNION ALL SELECT 'month', CAST(strftime(date_trunc('month', day) - to_months(CAST(i AS INTEGER)), '%Y%m') AS INTEGER) FROM m, range(0, 12) r(i)""")
def c5(spark: SparkSession, d: str) -> DataFrame:
    as_of = str(read(spark, d, "events").agg(F.max(F.col("ts").cast("date"))).first()[0])
    one = spark.range(1)
    lists = {"day": time.last_days(as_of, 7), "week": time.last_weeks(as_of, 5), "month": time.last_months(as_of, 12)}
    out = None
    for kind, c in lists.items():
        part = one.select(F.lit(kind).alias("kind"), F.explode(c).alias("period"))
        out = part if out is None else out.unionByName(part)
    return out


@query("c6_dates_between", "SELECT o_custkey, CAST(max(o_orderdate) AS DATE) - CAST(min(o_orderdate) AS DATE) AS days, CAST((CAST(max(o_orderdate) AS DATE) - CAST(min(o_orderdate) AS DATE)) // 7 AS BIGINT) AS weeks FROM orders GROUP BY 1")
def c6(spark: SparkSession, d: str) -> DataFrame:
    days = F.datediff(F.max("o_orderdate").cast("date"), F.min("o_orderdate").cast("date")).cast("long")
    return read(spark, d, "orders").groupBy("o_custkey").agg(days.alias("days"), F.floor(days / 7).alias("weeks"))


@query("c7_period_end", f"WITH {TELEMETRY_SQL} SELECT DISTINCT CAST(strftime(epoch_ms(ets + 19800000), '%Y%m%d') AS INTEGER) AS day, epoch_ms(CAST(CAST(epoch_ms(ets + 19800000) AS DATE) AS TIMESTAMP)) + 86399999 - 19800000 AS end_ms FROM t")
def c7(spark: SparkSession, d: str) -> DataFrame:
    days = events(spark, d).select(time.period(F.col("ets"), "DAY").alias("day")).distinct()
    return days.select("day", time.day_period_end_ms(F.col("day")).alias("end_ms"))


@query("c8_age", "SELECT o_orderkey, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2010-02-28') AS INTEGER) AS age FROM orders")
def c8(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", time.age(F.col("o_orderdate").cast("date"), F.lit("2010-02-28").cast("date")).alias("age"))


@query("c9_as_double", "SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE), 0) AS spent FROM events")
def c9(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("value").cast("string"))
    return read(spark, d, "events").select("event_id", scalars.as_double(text).alias("spent"))


@query("c10_message_id", f"WITH {TELEMETRY_SQL} SELECT mid, upper(md5(eid || '|' || uid || '|' || coalesce(content, 'null') || '|' || ets)) AS message_id FROM t")
def c10(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("mid", scalars.message_id(F.col("eid"), F.col("uid"), F.col("content"), F.col("ets")).alias("message_id"))


@query("c11_key_digest", "SELECT o_orderkey, sha256(o_orderkey || '##' || o_custkey || '##' || o_orderpriority) AS digest FROM orders")
def c11(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", scalars.key_digest(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")).alias("digest"))


@query("c12_modulus")
def c12(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("did").distinct().select("did", scalars.in_modulus(F.col("did"), 3).alias("chosen"))


@query("c13_json", "SELECT event_id, '{\"id\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}' AS doc, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def c13(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return read(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("id"), k.alias("k"))).alias("doc"), k.alias("k"))


@query("c14_known_tags", f"WITH {TELEMETRY_SQL} SELECT mid, array_to_string(list_filter(tags, lambda x: x IN ('t0', 't1', 't2')), ',') AS known FROM t")
def c14(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("mid", F.array_join(scalars.known_tags(F.col("tags"), REGISTERED_TAGS), ",").alias("known"))


@query("c15_labels", "SELECT l_orderkey, l_linenumber, '''' || CAST(l_quantity AS BIGINT) || '/50''' AS score, CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR) || '%' AS percent FROM lineitem")
def c15(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", scalars.quoted_score(F.col("l_quantity"), F.lit(50)).alias("score"), F.concat(F.floor(F.col("l_discount") * 100 + 0.5).cast("string"), F.lit("%")).alias("percent"))


@query("c16_clamp_percent", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_totalprice / 2000 > 100 THEN 100 ELSE CAST(trunc(o_totalprice / 2000) AS INTEGER) END AS percent FROM orders")
def c16(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 2000)
    return read(spark, d, "orders").select("o_orderkey", scalars.clamp_percent(raw).alias("percent"))


@query("c17_reformat", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 330 MINUTE, '%d/%m/%Y %H:%M') AS local_time FROM orders")
def c17(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", F.date_format(F.timestamp_add("MINUTE", F.lit(330), F.col("o_orderdate").cast("timestamp_ntz")), "dd/MM/yyyy HH:mm").alias("local_time"))


@query("c18_responses", f"WITH {TELEMETRY_SQL} SELECT mid, 'ans:' || page || ',k:' || k AS responses FROM t WHERE eid = 'INTERACT'")
def c18(spark: SparkSession, d: str) -> DataFrame:
    maps = F.array(F.create_map(F.lit("ans"), F.col("page")), F.create_map(F.lit("k"), F.col("k").cast("string")))
    return events(spark, d).where("eid = 'INTERACT'").select("mid", F.array_join(scalars.flat_responses(maps), ",").alias("responses"))


@query("c19_pair", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS first, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE 0 END AS second FROM part")
def c19(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(",", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"))).otherwise(F.col("p_size").cast("string"))
    a, b = scalars.pair_of_doubles(text)
    return read(spark, d, "part").select("p_partkey", a.alias("first"), b.alias("second"))


@query("c20_period_label", f"WITH {TELEMETRY_SQL} SELECT DISTINCT strftime(epoch_ms(ets + 19800000), '%Y-%m-%d') AS day, strftime(epoch_ms(ets + 19800000), '%Y-%m') AS month FROM t")
def c20(spark: SparkSession, d: str) -> DataFrame:
    label = lambda k: scalars.period_label(time.period(F.col("ets"), k))
    return events(spark, d).select(label("DAY").alias("day"), label("MONTH").alias("month")).distinct()


@query("c21_integer_average", f"WITH {TELEMETRY_SQL} SELECT content, CAST(sum(k) // count(*) AS BIGINT) AS average FROM t GROUP BY 1")
def c21(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy("content").agg(scalars.integer_average(F.sum("k"), F.count("*")).alias("average"))
