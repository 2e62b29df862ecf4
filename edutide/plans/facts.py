"""Fact tables of usage, each built in two batches of which the second is sent twice, with all their measures."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edutide.functions.scalars import exact_ratio, ratio
from edutide.functions.time import PERIODS, last_days, last_months, last_weeks
from edutide.operators import bloom, facts
from edutide.sources.shared import shared_folder, stored
from edutide.sources.telemetry import TELEMETRY_SQL

from .basics import events, registry
from .sequences import PLAYS_SQL
from .usage import DAY, plays

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = registry(QUERIES, SQL)

SPLIT = "period < 20240115"
WHOLE = "kind, period"

#: Rows of facts as SQL: kind and period of each kind of period.
PERIOD_SQL = f"""unnest([{{'kind': 'DAY', 'period': {DAY}}}, {{'kind': 'WEEK', 'period': CAST(isoyear(epoch_ms(ets)) * 1000 + 700 + week(epoch_ms(ets)) AS INTEGER)}},
  {{'kind': 'MONTH', 'period': CAST(strftime(epoch_ms(ets + 19800000), '%Y%m') AS INTEGER)}}, {{'kind': 'CUMULATIVE', 'period': 0}}])"""
BITS_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in bloom.SIZES.items()) + " END"
HALF_SQL = "CAST('0x' || substr(md5({}), {}, 15) AS BIGINT)"


def distinct_sql(name: str, source: str, keys: str, value: str, early: str) -> str:
    """Common table expressions that end with `name`: keys, name (values counted) and name_set (bits set), of rows with kind, period and
    `early`, which are those of the first batch."""
    places = f"list_transform(range(0, {bloom.HASHES}), lambda i: ({HALF_SQL.format('v', 1)} + i * {HALF_SQL.format('v', 16)}) % {BITS_SQL})"
    return f"""{name}_v AS (SELECT DISTINCT {WHOLE}, {keys}, {early} AS early, CAST({value} AS VARCHAR) AS v FROM {source} WHERE {value} IS NOT NULL),
{name}_p AS (SELECT *, {places} AS p FROM {name}_v),
{name}_1 AS (SELECT {WHOLE}, {keys}, list_distinct(flatten(list(p))) AS bits FROM {name}_p WHERE early GROUP BY ALL),
{name}_n AS (SELECT a.*, early OR b.bits IS NULL OR NOT list_has_all(b.bits, p) AS new FROM {name}_p a LEFT JOIN {name}_1 b USING ({WHOLE}, {keys})),
{name} AS (SELECT {WHOLE}, {keys}, count(*) FILTER (new) AS {name}, CAST(len(list_distinct(flatten(list(p)))) AS BIGINT) AS {name}_set FROM {name}_n GROUP BY ALL)"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Play sessions as the input of facts, with flags: anonymous and editor visits, and each user's first session."""
    one = Window.partitionBy("uid").orderBy("start_ms", "sid", "did", "channel", "app", "session")
    s = plays(spark, d).withColumn("ets", F.col("start_ms")).withColumn("sessions", F.lit(1).cast("long"))
    s = s.withColumn("anonymous", (F.substring("uid", -1, 1) == "7").cast("long")).withColumn("editor", (F.col("score") > 2).cast("long"))
    s = s.withColumn("new_users", (F.row_number().over(one) == 1).cast("long")).withColumn("anonymous_ms", F.col("anonymous") * F.col("ms")).withColumn("editor_ms", F.col("editor") * F.col("ms"))
    return s.select("ets", "period", "app", "channel", "uid", "did", "content", "sessions", F.col("ms").alias("total_ms"), "interactions", F.col("start_ms").alias("first_ms"), F.col("end_ms").alias("last_ms"), "anonymous", "anonymous_ms", "editor", "editor_ms", "new_users", F.array("content").alias("contents_list"), F.col("n_events").alias("events"))


ROWS_SQL = f"""{PLAYS_SQL}, f AS (SELECT start_ms AS ets, {SPLIT} AS early, period AS day, app, channel, uid, did, content, ms, interactions, start_ms, end_ms, CAST(right(uid, 1) = '7' AS BIGINT) AS anonymous, CAST(score > 2 AS BIGINT) AS editor, n_events,
  CAST(row_number() OVER (PARTITION BY uid ORDER BY start_ms, sid, did, channel, app, session) = 1 AS BIGINT) AS new_user FROM s),
r0 AS (SELECT *, {PERIOD_SQL} AS p FROM f), r AS (SELECT * EXCLUDE (p), p.kind AS kind, p.period AS period FROM r0)"""

SUMS_SQL = {
    "sessions": "count(*)", "total_ms": "CAST(sum(ms) AS BIGINT)", "interactions": "CAST(sum(interactions) AS BIGINT)", "first_ms": "min(start_ms)", "last_ms": "max(end_ms)",
    "anonymous": "CAST(sum(anonymous) AS BIGINT)", "anonymous_ms": "CAST(sum(anonymous * ms) AS BIGINT)", "editor": "CAST(sum(editor) AS BIGINT)", "editor_ms": "CAST(sum(editor * ms) AS BIGINT)",
    "new_users": "CAST(sum(new_user) AS BIGINT)", "events": "CAST(sum(n_events) AS BIGINT)", "contents_list": "list_sort(list(DISTINCT content))",
}
HOW = {name: {"first_ms": "min", "last_ms": "max", "contents_list": "list"}.get(name, "sum") for name in SUMS_SQL}
VALUES = {"users": "uid", "contents": "content", "devices": "did"}


def _exact(num: str, den: str):
    """A function that gives a ratio of integer columns, exactly rounded, and the same as SQL. Columns need a session, so they come later."""
    return lambda: exact_ratio(F.expr(num), F.expr(den)), f"CASE WHEN {den} = 0 THEN 0 ELSE floor((200 * ({num}) + ({den})) / (2 * ({den}))) / 100 END"


def _avg(ms: str, n: str):
    return _exact(ms, f"1000 * {n}")


def _share(part: str, of: str):
    return _exact(f"100 * {part}", of)


def _per(n: str, of: str):
    return _exact(n, of)


RATE = _exact("60000 * interactions", "total_ms")

#: name -> (keys, sums, distinct counts, ratios: name -> (column, SQL)); content "all" stands for all contents of the other keys.
FACTS = {
    "u4_workflow_fact": (["app", "channel", "content"], ["sessions", "total_ms", "interactions", "first_ms", "last_ms"], ["users", "contents", "devices"], {"avg_ts_session": _avg("total_ms", "sessions"), "avg_interactions_min": RATE}),
    "u5_usage_fact": (["app", "channel"], ["sessions", "total_ms", "interactions"], ["users", "contents", "devices"], {"avg_ts_session": _avg("total_ms", "sessions"), "avg_interactions_min": RATE}),
    "u6_content_fact": (["content"], ["sessions", "total_ms", "interactions"], ["devices"], {"avg_ts_session": _avg("total_ms", "sessions"), "avg_interactions_min": RATE, "avg_sess_device": _per("sessions", "devices")}),
    "u9_launch_fact": (["app"], ["sessions", "total_ms", "contents_list"], ["devices"], {"avg_ts_session": _avg("total_ms", "sessions"), "avg_sess_device": _per("sessions", "devices")}),
    "u10_app_fact": (["app", "channel"], ["sessions", "total_ms", "anonymous", "anonymous_ms", "editor", "new_users"], ["users"], {"avg_ts_session": _avg("total_ms", "sessions"), "avg_ts_anonymous": _avg("anonymous_ms", "anonymous"), "percent_editor": _share("editor", "sessions"), "percent_new": _share("new_users", "users")}),
    "u11_author_fact": (["uid"], ["sessions", "total_ms", "editor", "editor_ms"], [], {"avg_ts_session": _avg("total_ms", "sessions"), "percent_editor_sessions": _share("editor", "sessions"), "percent_editor_time": _share("editor_ms", "total_ms")}),
    "u13_textbook_fact": (["content", "channel"], ["sessions", "total_ms", "events"], [], {"avg_ts_session": _avg("total_ms", "sessions"), "events_session": _per("events", "sessions")}),
}


def table(spark: SparkSession, what: str):
    return facts.fact_table(spark, f"{shared_folder(spark)}/edutide/{what}-{uuid.uuid4().hex}")


def shown(df: DataFrame, distinct: list[str]) -> DataFrame:
    """Facts as results: of a state the number of its bits, of a list its text."""
    for name in distinct:
        df = df.withColumn(f"{name}_set", bloom.bits_set(F.col(f"{name}_bits"))).drop(f"{name}_bits")
    return df.withColumn("contents_list", F.array_join("contents_list", ",")) if "contents_list" in df.columns else df


def _fact(name: str):
    keys, sums, distinct, ratios = FACTS[name]

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _rows(spark, d)
        rows = stored(rows.select("ets", "period", *[c for c in rows.columns if c in {*keys, *sums, *[VALUES[n] for n in distinct]}]), "rows")
        totals = {"content": "all"} if name == "u4_workflow_fact" else {}  # a content's rows, and the same for all
        kind = facts.Facts(keys, {s: HOW[s] for s in sums}, {n: VALUES[n] for n in distinct}, totals=totals)
        kept = table(spark, name)
        for batch, part in (("early", SPLIT), ("late", f"not ({SPLIT})"), ("late", f"not ({SPLIT})")):
            kind.add(kept, batch, rows.where(part))
        return shown(kept.read(), distinct).withColumns({n: c() for n, (c, _) in ratios.items()})

    return run


def _fact_sql(name: str) -> str:
    keys, sums, distinct, ratios = FACTS[name]
    k = ", ".join(keys)
    source = "r"
    more = ""
    if name == "u4_workflow_fact":
        source, more = "r2", ", r2 AS (SELECT * EXCLUDE (content), content AS own, unnest([content, 'all']) AS content FROM r)"
    value = lambda n: "own" if n == "contents" and source == "r2" else VALUES[n]
    parts = "".join(", " + distinct_sql(n, source, k, value(n), "early") for n in distinct)
    sums_sql = ", ".join(f"{SUMS_SQL[s]} AS {s}" for s in sums)
    joins = "".join(f" LEFT JOIN {n} USING ({WHOLE}, {k})" for n in distinct)
    columns = ", ".join(f"coalesce({n}.{n}, 0) AS {n}, coalesce({n}_set, 0) AS {n}_set" for n in distinct)
    lists = "* REPLACE (array_to_string(contents_list, ',') AS contents_list)" if "contents_list" in sums else "*"
    return f"""WITH {ROWS_SQL}{more}{parts}, a AS (SELECT {WHOLE}, {k}, {sums_sql} FROM {source} GROUP BY {WHOLE}, {k}),
x AS (SELECT a.*{', ' + columns if columns else ''} FROM a{joins}) SELECT {lists}{''.join(f', {sql} AS {n}' for n, (_, sql) in ratios.items())} FROM x"""


for _name in FACTS:
    query(_name, _fact_sql(_name))(_fact(_name))


@query("u12_editor_fact", f"""WITH {ROWS_SQL}, d AS (SELECT day, content, app, count(DISTINCT uid) AS users, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS sessions, CAST(sum(interactions) AS BIGINT) AS interactions, min(ets) AS ets FROM f GROUP BY 1, 2, 3),
e AS (SELECT *, {PERIOD_SQL} AS p FROM d), x AS (SELECT p.kind AS kind, p.period AS period, content, app, CAST(sum(users) AS BIGINT) AS users, CAST(sum(total_ms) AS BIGINT) AS total_ms, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(interactions) AS BIGINT) AS interactions FROM e GROUP BY 1, 2, 3, 4)
SELECT *, {_avg('total_ms', 'sessions')[1]} AS avg_ts_session, {RATE[1]} AS avg_interactions_min, {_per('sessions', 'users')[1]} AS sessions_user FROM x""")
def u12(spark: SparkSession, d: str) -> DataFrame:
    """Users are counted by day and then summed, so that one who comes on two days counts twice."""
    day = _rows(spark, d).groupBy("period", "content", "app").agg(F.count_distinct("uid").alias("users"), *[F.sum(c).alias(c) for c in ("total_ms", "sessions", "interactions")], F.min("ets").alias("ets"))
    kind = facts.Facts(["content", "app"], {c: "sum" for c in ("users", "total_ms", "sessions", "interactions")})
    kept = table(spark, "u12")
    for batch, part in (("early", SPLIT), ("late", f"not ({SPLIT})")):
        kind.add(kept, batch, day.where(part))
    return kept.read().withColumns({"avg_ts_session": _avg("total_ms", "sessions")[0](), "avg_interactions_min": RATE[0](), "sessions_user": _per("sessions", "users")[0]()})


@query("u7_popularity_fact", f"""WITH {TELEMETRY_SQL}, f AS (SELECT content, ets, CASE WHEN eid = 'INTERACT' THEN CAST(k % 5 + 1 AS BIGINT) END AS rating, CASE WHEN eid = 'INTERACT' THEN page || ':' || (k % 5 + 1) END AS comment, CAST(eid = 'INTERRUPT' AND score = 0 AS BIGINT) AS dl, CAST(eid = 'INTERRUPT' AND score > 0 AS BIGINT) AS sl FROM t WHERE eid IN ('INTERACT', 'INTERRUPT')),
r0 AS (SELECT *, {PERIOD_SQL} AS p FROM f), x AS (SELECT p.kind AS kind, p.period AS period, content, CAST(coalesce(sum(rating), 0) AS BIGINT) AS rating_sum, count(rating) AS ratings, CAST(sum(dl) AS BIGINT) AS downloads, CAST(sum(sl) AS BIGINT) AS side_loads, coalesce(array_to_string(list_sort(list(DISTINCT comment) FILTER (comment IS NOT NULL)), ','), '') AS comments FROM r0 GROUP BY 1, 2, 3)
SELECT *, CASE WHEN ratings = 0 THEN 0 ELSE round(rating_sum / ratings, 2) END AS avg_rating FROM x""")
def u7(spark: SparkSession, d: str) -> DataFrame:
    """Ratings, their distinct comments, downloads and side loads; the average is made from the sums again."""
    t = events(spark, d).where("eid in ('INTERACT', 'INTERRUPT')")
    rated, loaded = F.col("eid") == "INTERACT", F.col("eid") == "INTERRUPT"
    stars = F.col("k") % 5 + 1
    comment = F.when(rated, F.array(F.concat_ws(":", "page", stars.cast("string")))).otherwise(F.array().cast("array<string>"))
    rows = t.select(
        "ets", "mid", "content", F.when(rated, stars).otherwise(0).alias("rating_sum"), rated.cast("long").alias("ratings"),
        (loaded & (F.col("score") == 0)).cast("long").alias("downloads"), (loaded & (F.col("score") > 0)).cast("long").alias("side_loads"), comment.alias("comments"),
    )
    kind = facts.Facts(["content"], {"rating_sum": "sum", "ratings": "sum", "downloads": "sum", "side_loads": "sum", "comments": "list"})
    kept = table(spark, "u7")
    for i in range(2):
        kind.add(kept, f"half-{i}", rows.where(F.col("mid") % 2 == i))
    return kept.read().withColumn("comments", F.array_join("comments", ",")).withColumn("avg_rating", ratio(F.col("rating_sum"), F.col("ratings")))


@query("u8_item_fact", f"""WITH {TELEMETRY_SQL}, f AS (SELECT 'q' || k AS item, ets, score, page FROM t WHERE eid IN ('INTERACT', 'END')), r0 AS (SELECT *, {PERIOD_SQL} AS p FROM f), r AS (SELECT * EXCLUDE (p), p.kind AS kind, p.period AS period FROM r0),
a AS (SELECT {WHOLE}, item, count(*) AS total, count(*) FILTER (score > 0) AS correct, CAST(sum(score) AS BIGINT) AS score_sum FROM r GROUP BY 1, 2, 3),
w AS (SELECT {WHOLE}, item, page, n, row_number() OVER (PARTITION BY {WHOLE}, item ORDER BY n DESC, page) AS i FROM (SELECT {WHOLE}, item, page, count(*) AS n FROM r WHERE score = 0 GROUP BY 1, 2, 3, 4)),
l AS (SELECT {WHOLE}, item, string_agg(page || ':' || n, ',' ORDER BY i) AS responses FROM w WHERE i <= 5 GROUP BY 1, 2, 3)
SELECT a.*, coalesce(responses, '') AS incorrect, round(score_sum / total, 2) AS avg_score FROM a LEFT JOIN l USING ({WHOLE}, item)""")
def u8(spark: SparkSession, d: str) -> DataFrame:
    """Items with their most frequent wrong responses. Counts are kept by response, since lists of the best five can't be merged."""
    rows = events(spark, d).where("eid in ('INTERACT', 'END')").select("ets", "mid", F.concat(F.lit("q"), "k").alias("item"), F.col("page").alias("response"), F.lit(1).cast("long").alias("total"), (F.col("score") > 0).cast("long").alias("correct"), (F.col("score") == 0).cast("long").alias("wrong"), F.col("score").alias("score_sum"))
    kind = facts.Facts(["item", "response"], {c: "sum" for c in ("total", "correct", "wrong", "score_sum")})
    kept = table(spark, "u8")
    for i in range(2):
        kind.add(kept, f"half-{i}", rows.where(F.col("mid") % 2 == i))
    keys = ["kind", "period", "item"]
    out = kept.read()
    sums = out.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("total", "correct", "score_sum")])
    lists = facts.item_lists(out, keys, "response", "wrong").withColumnRenamed("responses", "incorrect")
    return sums.join(lists, keys, "left").withColumn("incorrect", F.coalesce("incorrect", F.lit(""))).withColumn("avg_score", ratio(F.col("score_sum"), F.col("total")))


@query("a4_sketch_distinct", f"WITH {TELEMETRY_SQL}, r0 AS (SELECT channel, uid, mid % 2 = 0 AS early, {PERIOD_SQL} AS p FROM t), r AS (SELECT * EXCLUDE (p), p.kind AS kind, p.period AS period FROM r0), {distinct_sql('users', 'r', 'channel', 'uid', 'early')} SELECT * FROM users")
def a4(spark: SparkSession, d: str) -> DataFrame:
    """A4: users by channel and period as Bloom states: of two batches, and the second once more, which adds nothing."""
    keys = ["kind", "period", "channel"]
    rows, state = facts.by_period(events(spark, d), ["channel", "uid", "mid"], kinds=PERIODS), None
    for i in (0, 1, 1):
        state = stored(bloom.inserted(rows.where(F.col("mid") % 2 == i), keys, "uid", bloom.size_of(F.col("kind")), state, "users"), "state")
    return shown(state, ["users"])


VIEW_KEYS = {"content": ["content"], "app": ["app"], "channel": ["channel"], "author": ["uid"], "device": ["did"], "launch": ["app", "channel"]}
AS_OF = "2024-02-03"


def view_windows(spark: SparkSession, as_of: str = AS_OF) -> DataFrame:
    """V2: the windows of precomputed views, as rows of window, kind and period: a few dozen."""
    lists = {
        "LAST_7_DAYS": ("DAY", last_days(as_of, 7)), "LAST_14_DAYS": ("DAY", last_days(as_of, 14)), "LAST_30_DAYS": ("DAY", last_days(as_of, 30)),
        "LAST_5_WEEKS": ("WEEK", last_weeks(as_of, 5)), "LAST_12_MONTHS": ("MONTH", last_months(as_of, 12)), "CUMULATIVE": ("CUMULATIVE", F.array(F.lit(0))),
    }
    out = None
    for name, (kind, periods) in lists.items():
        part = spark.range(1).select(F.lit(name).alias("window"), F.lit(kind).alias("kind"), F.explode(periods.cast("array<int>")).alias("period"))
        out = part if out is None else out.unionByName(part)
    return out


WINDOWS_SQL = f"""wd AS (SELECT 'LAST_' || n || '_DAYS' AS "window", 'DAY' AS kind, CAST(strftime(DATE '{AS_OF}' - CAST(i AS INTEGER), '%Y%m%d') AS INTEGER) AS period FROM (VALUES (7), (14), (30)) v(n), range(1, 31) r(i) WHERE i <= n
UNION ALL SELECT 'LAST_5_WEEKS', 'WEEK', CAST(isoyear(DATE '{AS_OF}' - 7 * CAST(i AS INTEGER)) * 1000 + 700 + week(DATE '{AS_OF}' - 7 * CAST(i AS INTEGER)) AS INTEGER) FROM range(0, 5) r(i)
UNION ALL SELECT 'LAST_12_MONTHS', 'MONTH', CAST(strftime(date_trunc('month', DATE '{AS_OF}') - to_months(CAST(i AS INTEGER)), '%Y%m') AS INTEGER) FROM range(0, 12) r(i) UNION ALL SELECT 'CUMULATIVE', 'CUMULATIVE', 0)"""


def _views_sql() -> str:
    parts = [f"""SELECT '{name}' AS fact, "window", concat_ws('/', {', '.join(keys)}) AS key, count(*) AS sessions, CAST(sum(ms) AS BIGINT) AS total_ms, CAST(sum(interactions) AS BIGINT) AS interactions, floor((200 * sum(ms) + 1000 * count(*)) / (2000 * count(*))) / 100 AS avg_ts_session FROM r JOIN wd USING (kind, period) GROUP BY ALL""" for name, keys in VIEW_KEYS.items()]
    return f"WITH {ROWS_SQL}, {WINDOWS_SQL} " + " UNION ALL ".join(parts)


@query("v2_views", _views_sql())
def v2_views(spark: SparkSession, d: str) -> DataFrame:
    """V2: six facts by six windows: facts of the windows' periods, found by one join with the list of all windows."""
    rows, windows = stored(_rows(spark, d), "rows"), F.broadcast(view_windows(spark))
    out = None
    for name, keys in VIEW_KEYS.items():
        kind = facts.Facts(keys, {"sessions": "sum", "total_ms": "sum", "interactions": "sum"})
        made = kind.merge(facts.by_period(rows, [*keys, *kind.measures]), None)
        found = made.join(windows, ["kind", "period"]).groupBy("window", *keys).agg(*[F.sum(c).alias(c) for c in kind.measures])
        part = found.select(F.lit(name).alias("fact"), "window", F.concat_ws("/", *keys).alias("key"), *kind.measures)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("avg_ts_session", _avg("total_ms", "sessions")[0]())


@query("v4_popularity_metrics", f"""WITH {TELEMETRY_SQL} SELECT {DAY} AS period, count(*) FILTER (eid = 'INTERACT') AS ratings, CASE WHEN count(*) FILTER (eid = 'INTERACT') = 0 THEN 0 ELSE round(sum(k % 5 + 1) FILTER (eid = 'INTERACT') / count(*) FILTER (eid = 'INTERACT'), 2) END AS avg_rating,
  count(*) FILTER (eid = 'INTERRUPT' AND score = 0) AS downloads, count(*) FILTER (eid = 'INTERRUPT' AND score > 0) AS side_loads FROM t WHERE eid IN ('INTERACT', 'INTERRUPT') GROUP BY 1""")
def v4_popularity(spark: SparkSession, d: str) -> DataFrame:
    """V4: popularity by day over the contents' facts; the average from sums."""
    t = events(spark, d).where("eid in ('INTERACT', 'INTERRUPT')")
    rated, loaded = (F.col("eid") == "INTERACT").cast("long"), (F.col("eid") == "INTERRUPT").cast("long")
    rows = t.select("ets", "content", rated.alias("ratings"), (rated * (F.col("k") % 5 + 1)).alias("rating_sum"), (loaded * (F.col("score") == 0).cast("long")).alias("downloads"), (loaded * (F.col("score") > 0).cast("long")).alias("side_loads"))
    kind = facts.Facts(["content"], {c: "sum" for c in ("ratings", "rating_sum", "downloads", "side_loads")}, kinds=("DAY",))
    day = kind.merge(facts.by_period(rows, ["content", *kind.measures], kinds=("DAY",)), None).groupBy("period").agg(*[F.sum(c).alias(c) for c in kind.measures])
    return day.select("period", "ratings", ratio(F.col("rating_sum"), F.col("ratings")).alias("avg_rating"), "downloads", "side_loads")


@query("v4_item_metrics", f"""WITH {TELEMETRY_SQL}, i AS (SELECT {DAY} AS period, 'q' || k AS item, score FROM t WHERE eid IN ('INTERACT', 'END')), f AS (SELECT period, item, count(*) AS total, count(*) FILTER (score > 0) AS correct, count(*) FILTER (score = 0) AS wrong FROM i GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY wrong DESC, item) AS place FROM f WHERE wrong > 0)
SELECT f.period, CAST(sum(total) AS BIGINT) AS total, CAST(sum(correct) AS BIGINT) AS correct, coalesce(any_value(top), '') AS top_incorrect FROM f LEFT JOIN (SELECT period, string_agg(item || ':' || wrong, ',' ORDER BY place) AS top FROM r WHERE place <= 5 GROUP BY 1) x USING (period) GROUP BY 1""")
def v4_items(spark: SparkSession, d: str) -> DataFrame:
    """V4: by day: answers, right ones, and the five items most often answered wrong."""
    rows = events(spark, d).where("eid in ('INTERACT', 'END')").select("ets", F.concat(F.lit("q"), "k").alias("item"), F.lit(1).cast("long").alias("total"), (F.col("score") > 0).cast("long").alias("correct"), (F.col("score") == 0).cast("long").alias("wrong"))
    kind = facts.Facts(["item"], {c: "sum" for c in ("total", "correct", "wrong")}, kinds=("DAY",))
    made = kind.merge(facts.by_period(rows, ["item", *kind.measures], kinds=("DAY",)), None)
    lists = facts.item_lists(made, ["period"], "item", "wrong").withColumnRenamed("responses", "top_incorrect")
    sums = made.groupBy("period").agg(F.sum("total").alias("total"), F.sum("correct").alias("correct"))
    return sums.join(lists, "period", "left").withColumn("top_incorrect", F.coalesce("top_incorrect", F.lit("")))
