"""Daily usage summaries: each takes session or raw rows and gives one row per period and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.functions.scalars import per_minute, ratio
from edutide.functions.time import period, round2_ms

from . import sessions
from .cube import all_cube

FIXED = ["period", "app", "channel"]


def play_sessions(t: DataFrame, idle_s: int = 600) -> DataFrame:
    """One row per content play session of a user and day: the input of most summaries."""
    keys = ["sid", "uid", "did", "channel", "app"]
    cut = sessions.by_object(t, keys)
    firsts = {"content": F.min_by("content", F.struct("ets", "mid")), "tags": F.min_by("tags", F.struct("ets", "mid")), "score": F.sum("score")}
    out = sessions.summary(cut, [*keys, "session"], idle_s, extra=firsts)
    return out.withColumn("period", period(F.col("start_ms"), "DAY")).withColumn("ms", F.round(F.col("time_spent") * 1000).cast("long"))


def usage_measures(distinct: tuple[str, ...] = ()) -> list[Column]:
    """Time in ms, sessions, interactions, first and last time; distinct counts of the named columns."""
    return [
        F.sum("ms").alias("total_ms"),
        F.count("*").alias("total_sessions"),
        F.sum("interactions").alias("total_interactions"),
        F.min("start_ms").alias("first_ms"),
        F.max("end_ms").alias("last_ms"),
        *[F.count_distinct(c).alias(f"unique_{c}") for c in distinct],
    ]


def with_ratios(df: DataFrame) -> DataFrame:
    """Averages recomputed from totals: A8."""
    s = F.col("total_ms") / 1000
    return df.withColumn("avg_ts_session", ratio(s, F.col("total_sessions"))).withColumn("avg_interactions_min", per_minute(F.col("total_interactions"), s))


#: How sums and extremes of parts become those of the whole.
MERGED = {"total_ms": F.sum, "total_sessions": F.sum, "total_interactions": F.sum, "first_ms": F.min, "last_ms": F.max}


def workflow_usage(s: DataFrame, registered: list[str]) -> DataFrame:
    """G1: eight combinations of content, user and device, untagged and per tag; distincts where the dimension is 'all'.

    Rows are dealt once, by period and user. There the four combinations with a user are made in place, each from the one with
    all three; the others come from sums by content and device. A row of a finer combination stands for one distinct value
    of a coarser one, so that distinct values are counted by flags of first rows and no row is spread for them."""
    known = F.array_intersect("tags", F.array(*[F.lit(t) for t in registered]).cast("array<string>"))
    named = s.withColumnRenamed("uid", "user").withColumnRenamed("did", "device")
    named = named.where(" and ".join(f"{d} is not null and {d} != ''" for d in ("content", "user", "device")))
    named = named.select(*FIXED, "content", "user", "device", F.coalesce(known, F.array().cast("array<string>")).alias("known"), "ms", "interactions", "start_ms", "end_ms")
    # Null stands for all tags until the end, so that no tag is mistaken for it.
    tags = F.concat(F.array(F.lit(None).cast("string")), "known")
    dealt = named.repartition(*FIXED, "user").withColumn("tag", F.explode(tags))
    keys = [*FIXED, "tag"]
    each = dealt.groupBy(*keys, "content", "user", "device").agg(*usage_measures())
    # Each ranking is of rows that one task has already.
    first = lambda by, order: (F.row_number().over(Window.partitionBy(*keys, *by).orderBy(*order)) == 1).cast("long")
    each = each.withColumn("of_cu", first(["user", "content"], ["device"])).withColumn("of_u", first(["user"], ["content", "device"])).withColumn("of_ud", first(["user", "device"], ["content"]))

    def rolled(rows: DataFrame, dims: list[str], **counts: Column) -> DataFrame:
        merged = [how(c).alias(c) for c, how in MERGED.items()]
        return rows.groupBy(*keys, *dims).agg(*merged, *[c.alias(n) for n, c in counts.items()])

    one, of = F.count("*"), {c: F.sum(c) for c in ("of_cu", "of_u", "of_ud")}
    pairs = rolled(each, ["content", "device"], users=one, **of)  # with what its users are in coarser combinations
    places = F.count_distinct("content"), F.count_distinct("device")
    parts = [
        each, rolled(each, ["content", "user"], devices=one), rolled(each, ["user", "device"], contents=one), rolled(each, ["user"], contents=of["of_cu"], devices=of["of_ud"]),
        pairs, rolled(pairs, ["content"], users=of["of_cu"], devices=one), rolled(pairs, ["device"], users=of["of_ud"], contents=one), rolled(pairs, [], users=of["of_u"], contents=places[0], devices=places[1]),
    ]
    out = None
    for part in parts:
        value = lambda c, default: F.col(c) if c in part.columns else F.lit(default)  # noqa: B023, E731
        part = part.select(*FIXED, *[value(d, "all").alias(d) for d in ("content", "user", "device")], F.coalesce("tag", F.lit("all")).alias("tag"), *MERGED, *[value(f"{d}s", 0).cast("long").alias(f"unique_{d}s") for d in ("user", "content", "device")])
        out = part if out is None else out.unionByName(part)
    return with_ratios(out)


def user_content_usage(s: DataFrame, registered: list[str]) -> DataFrame:
    """Four combinations of user and content, three of them per tag."""
    return with_ratios(all_cube(s, FIXED, ["uid", "content"], usage_measures(), tag_combos=[["uid"], ["content"], []], registered=registered))


def content_usage(s: DataFrame, registered: list[str]) -> DataFrame:
    """G3."""
    return with_ratios(all_cube(s, FIXED, ["content"], usage_measures(("did",)), registered=registered))


def app_usage(s: DataFrame, anonymous: Column) -> DataFrame:
    """Each registered author and all: sessions, anonymous share, new users (those first seen in the period)."""
    first = F.min("period").over(Window.partitionBy("uid"))
    rows = s.withColumn("anonymous", anonymous.cast("int")).withColumn("new_user", (first == F.col("period")).cast("int"))
    measures = [F.sum("ms").alias("total_ms"), F.count("*").alias("total_sessions"), F.sum("anonymous").alias("anonymous_sessions"), F.count_distinct("uid").alias("unique_users"), F.sum("new_user").alias("new_user_sessions")]
    authors = rows.where("anonymous = 0").groupBy(*FIXED, F.col("uid").alias("author")).agg(*measures)
    everyone = rows.groupBy(*FIXED).agg(*measures).withColumn("author", F.lit("all"))
    out = authors.unionByName(everyone)
    return out.withColumn("percent_new", ratio(F.col("new_user_sessions") * 100, F.col("total_sessions")))


def author_usage(s: DataFrame, anonymous: Column, editor: Column) -> DataFrame:
    """Registered sessions by author and all; kept where the editor was visited."""
    rows = s.where(~anonymous).withColumn("editor", editor.cast("int")).withColumnRenamed("uid", "author")
    out = all_cube(rows, FIXED, ["author"], [F.sum("ms").alias("total_ms"), F.count("*").alias("total_sessions"), F.sum("editor").alias("editor_visits")])
    return out.where("editor_visits > 0").withColumn("percent_editor", ratio(F.col("editor_visits") * 100, F.col("total_sessions")))


def launch_usage(launches: DataFrame, registered: list[str]) -> DataFrame:
    """Launches by tag."""
    return with_ratios(all_cube(launches, FIXED, [], usage_measures(("did",)), combos=[[]], registered=registered))


def items(t: DataFrame) -> DataFrame:
    """One row per answered item of a session."""
    return t.where("eid in ('INTERACT', 'END')").select("sid", "uid", "content", F.concat(F.lit("q"), F.col("k")).alias("item"), "score", (F.col("score") > 0).alias("pass"), F.array(F.map_from_arrays(F.array(F.lit("ans")), F.array(F.col("page")))).alias("resvalues"), "tags", "app", "channel", "ets")


def item_usage(i: DataFrame, registered: list[str], top: int = 5) -> DataFrame:
    """By item and tag: answers, correct and incorrect, and the most frequent incorrect responses (ties by response)."""
    rows = i.withColumn("period", period(F.col("ets"), "DAY")).withColumn("tag", F.explode(F.array_union(F.array(F.lit("all")), F.array_intersect("tags", F.array(*[F.lit(t) for t in registered])))))
    keys = [*FIXED, "content", "item", "tag"]
    totals = rows.groupBy(*keys).agg(F.count("*").alias("total_count"), F.count(F.when(F.col("pass"), 1)).alias("correct"), F.sum("score").alias("total_score"))
    wrong = rows.where(~F.col("pass")).withColumn("resp", F.col("resvalues")[0]["ans"]).groupBy(*keys, "resp").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "resp"))
    best = wrong.withColumn("r", rank).where(F.col("r") <= top).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "resp", "n"))), lambda x: F.concat_ws(":", x["resp"], x["n"].cast("string"))), ",").alias("incorrect"))
    return totals.join(best, keys, "left").withColumn("incorrect", F.coalesce("incorrect", F.lit("")))


def popularity(t: DataFrame, registered: list[str]) -> DataFrame:
    """Ratings (feedback rows), downloads and side loads (share rows with no or some transfers), content or all x tag."""
    feedback = t.where("eid = 'INTERACT'").select("ets", "app", "channel", "content", "tags", (F.col("k") % 5 + 1).alias("rating"), F.lit(0).alias("downloads"), F.lit(0).alias("side_loads"))
    shares = t.where("eid = 'INTERRUPT'").select("ets", "app", "channel", "content", "tags", F.lit(None).cast("long").alias("rating"), (F.col("score") == 0).cast("int").alias("downloads"), (F.col("score") >= 1).cast("int").alias("side_loads"))
    rows = feedback.unionByName(shares).withColumn("period", period(F.col("ets"), "DAY"))
    out = all_cube(rows, FIXED, ["content"], [F.count("rating").alias("ratings"), F.sum("rating").alias("rating_sum"), F.sum("downloads").alias("downloads"), F.sum("side_loads").alias("side_loads")], registered=registered)
    return out.withColumn("rating_sum", F.coalesce("rating_sum", F.lit(0))).withColumn("avg_rating", ratio(F.col("rating_sum"), F.col("ratings")))


def sideloading(shares: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per content: downloads, origins with their greatest depth merged with the state's, and the average depth."""
    one = shares.groupBy("content", "origin").agg(F.max("depth").alias("depth"), F.sum((F.col("depth") == 0).cast("long")).alias("n"))
    if state is not None:
        one = one.unionByName(state).groupBy("content", "origin").agg(F.max("depth").alias("depth"), F.sum("n").alias("n"))
    return one


def sideloading_report(state: DataFrame) -> DataFrame:
    out = state.groupBy("content").agg(F.sum("n").alias("downloads"), F.count("*").alias("origins"), F.sum("depth").alias("depth_sum"))
    return out.withColumn("avg_depth", ratio(F.col("depth_sum"), F.col("origins")))


def pipeline_counts(t: DataFrame, kind: str, state: str) -> DataFrame:
    """Rows by day, channel, type and state."""
    return t.withColumn("period", period(F.col("ets"), "DAY")).groupBy("period", "channel", F.col(kind).alias("type"), F.col(state).alias("state")).agg(F.count("*").alias("count"))


def scans(t: DataFrame, codes: Column) -> DataFrame:
    """Per code and channel: scans, first and last; empty and null codes are left out."""
    rows = t.withColumn("code", F.explode(codes)).where("code is not null and code != ''")
    return rows.groupBy("code", "channel").agg(F.count("*").alias("total_scans"), F.min("ets").alias("first_ms"), F.max("ets").alias("last_ms"))


def device_summary(s: DataFrame, t: DataFrame) -> DataFrame:
    """Launches and plays of sessions, full-outer joined with raw downloads and scans; zeros for what is missing."""
    played = s.groupBy("did").agg(F.count_distinct("sid").alias("launches"), F.count("*").alias("plays"), F.count_distinct("content").alias("contents"), F.sum("ms").alias("total_ms"))
    raw = t.groupBy("did").agg(F.count(F.when(F.col("eid") == "INTERRUPT", 1)).alias("downloads"), F.count(F.when((F.col("eid") == "INTERACT") & (F.col("score") > 0), 1)).alias("scans_ok"), F.count(F.when((F.col("eid") == "INTERACT") & (F.col("score") == 0), 1)).alias("scans_failed"), F.min("ets").alias("first_access"))
    return played.join(raw, "did", "full").na.fill(0)


def device_usage(s: DataFrame, state: DataFrame | None = None, floor_ms: int = 1_425_168_000_000) -> DataFrame:
    """Per device, merged with its state: launches, time, first (floored at a date) and last, days and averages."""
    new = s.groupBy("did").agg(F.count("*").alias("launches"), F.sum("ms").alias("total_ms"), F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"))
    if state is not None:
        new = new.unionByName(state.select(*new.columns)).groupBy("did").agg(F.sum("launches").alias("launches"), F.sum("total_ms").alias("total_ms"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    days = F.greatest(F.floor((F.col("last_ms") - F.greatest(F.col("first_ms"), F.lit(floor_ms))) / 86_400_000), F.lit(1)).cast("long")
    return new.withColumn("days", days).withColumn("avg_time", ratio(F.col("total_ms") / 1000, F.col("days"))).withColumn("avg_launches", ratio(F.col("launches"), F.col("days")))


def device_content_usage(s: DataFrame) -> DataFrame:
    """Two levels: per device and content, with the device's distinct contents."""
    both = s.groupBy("did", "content").agg(F.count("*").alias("plays"), F.sum("ms").alias("total_ms"), F.sum("interactions").alias("interactions"), F.min("start_ms").alias("start_ms"))
    return both.withColumn("device_contents", F.count("*").over(Window.partitionBy("did")))


def learner_activity(s: DataFrame, top: int = 5) -> DataFrame:
    """Per learner: mean time, last contents (most recent first, distinct), most active UTC hour."""
    w = Window.partitionBy("uid")
    base = s.groupBy("uid").agg(F.count("*").alias("sessions"), F.sum("ms").alias("total_ms"))
    recent = s.groupBy("uid", "content").agg(F.max("end_ms").alias("end_ms")).withColumn("r", F.row_number().over(w.orderBy(F.desc("end_ms"), "content"))).where(F.col("r") <= top)
    last = recent.groupBy("uid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "content"))), lambda x: x["content"]), ",").alias("last_contents"))
    hour = lambda c: (F.floor(F.col(c) / 3_600_000) % 24).cast("int")
    hours = s.withColumn("a", hour("start_ms")).withColumn("b", hour("end_ms")).withColumn("hour", F.explode(F.transform(F.sequence("a", F.col("b") + F.when(F.col("b") < F.col("a"), 24).otherwise(0)), lambda h: h % 24)))
    active = hours.groupBy("uid", "hour").agg(F.count("*").alias("n")).withColumn("r", F.row_number().over(w.orderBy(F.desc("n"), "hour"))).where("r = 1").select("uid", F.col("hour").alias("active_hour"))
    return base.join(last, "uid").join(active, "uid").withColumn("mean_time", ratio(F.col("total_ms") / 1000, F.col("sessions")))


def proficiency(answers: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Beta posterior per learner and concept: alpha += score, beta += max - score, from 0.5 and 1; pi = alpha / both."""
    new = answers.groupBy("uid", "concept").agg(F.sum("score").alias("s"), F.sum(F.col("max_score") - F.col("score")).alias("m"))
    if state is not None:
        new = new.join(state.select("uid", "concept", "alpha", "beta"), ["uid", "concept"], "full")
    else:
        new = new.withColumn("alpha", F.lit(None).cast("double")).withColumn("beta", F.lit(None).cast("double"))
    alpha = F.round(F.coalesce("alpha", F.lit(0.5)) + F.coalesce("s", F.lit(0)), 4)
    beta = F.round(F.coalesce("beta", F.lit(1.0)) + F.coalesce("m", F.lit(0)), 4)
    out = new.select("uid", "concept", alpha.alias("alpha"), beta.alias("beta"))
    return out.withColumn("pi", F.round(F.col("alpha") / (F.col("alpha") + F.col("beta")), 2))


def daily_funnel(f: DataFrame, stages: list[str]) -> DataFrame:
    """Per day: sessions that reached each stage, and its completion in percent."""
    reached = f.groupBy("period").agg(F.count("*").alias("sessions"), *[F.sum(f"{s}_reached").alias(s) for s in stages])
    return reached.select("period", "sessions", *stages, *[ratio(F.col(s) * 100, F.col("sessions")).alias(f"{s}_percent") for s in stages])


def monitor(jobs: DataFrame) -> DataFrame:
    """Jobs by day: started, completed, failed, input rows."""
    kind = lambda k: F.count(F.when(F.col("status") == k, 1))
    return jobs.groupBy("period").agg(kind("START").alias("started"), kind("END").alias("completed"), kind("INTERRUPT").alias("failed"), F.count("*").alias("rows"))


def durations(log: DataFrame, key: str, ms: str) -> DataFrame:
    """Requests by key: least, greatest and average duration."""
    return log.groupBy(key).agg(F.count("*").alias("count"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.sum(ms).alias("sum_ms")).withColumn("avg_ms", ratio(F.col("sum_ms"), F.col("count"))).drop("sum_ms")


def snapshot(edges: DataFrame, usage: DataFrame, parts: int = 0) -> DataFrame:
    """Contents, live ones, their creation and their active users, at four levels: all, author, partner, both. Rows are dealt by
    content into `parts` (the session's number, if not given); there a level's rows of a content become one, so that contents
    are counted without being brought together."""
    parts = parts or int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = edges.repartition(parts, "content").join(usage.repartition(parts, "content"), "content", "left").where("author is not null and author != '' and partner is not null and partner != ''")
    level = lambda i, author, partner: F.struct(F.lit(i).alias("level"), author.alias("author"), partner.alias("partner"))
    author, partner, every = F.col("author"), F.col("partner"), F.lit("all")
    levels = F.explode(F.array(level(0, author, partner), level(1, author, every), level(2, every, partner), level(3, every, every)))
    each = rows.select("content", (F.col("status") == "Live").alias("live"), "created_ms", F.coalesce("plays", F.lit(0)).alias("plays"), levels.alias("l")).select("content", "live", "created_ms", "plays", "l.*")
    one = each.groupBy("level", "author", "partner", "content").agg(F.max("live").alias("live"), F.sum("created_ms").alias("creation_ms"), F.sum("plays").alias("plays"))
    measures = [F.count("content").alias("contents"), F.count(F.when(F.col("live"), F.col("content"))).alias("live"), F.sum("creation_ms").alias("creation_ms"), F.sum("plays").alias("plays")]
    return one.groupBy("level", "author", "partner").agg(*measures).drop("level")


def coverage(units: DataFrame) -> DataFrame:
    """Per parent: codes attached, distinct and linked."""
    return units.groupBy("parent", "level").agg(F.count("code").alias("codes"), F.count_distinct("code").alias("distinct_codes"), F.count(F.when(F.col("linked"), 1)).alias("linked"))
