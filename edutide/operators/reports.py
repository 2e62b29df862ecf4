"""Reports: declarative aggregates, latest attempts, denormalised progress and assessment tables, extracts, hierarchies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.functions.filters import HAVING, report_where
from edutide.functions.time import interval


def latest_attempt(df: DataFrame, keys: list[str], time: str, ties: list[str]) -> DataFrame:
    """The latest row of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time), *ties))).where("_r = 1").drop("_r")


def with_totals(df: DataFrame, keys: list[str], totals: dict[str, str]) -> DataFrame:
    """Window sums beside each row."""
    w = Window.partitionBy(*keys)
    return df.withColumns({name: F.sum(c).over(w) for name, c in totals.items()})


def aggregate(kind: str, column: str | None, time: str) -> Column:
    """A report's aggregation by name. First and last are by time, of equal times the smallest and the largest value."""
    simple = {"longSum": F.sum, "doubleSum": F.sum, "longMax": F.max, "doubleMax": F.max, "longMin": F.min, "doubleMin": F.min}
    if kind == "count":
        return F.count("*")
    if kind in simple:
        return simple[kind](column)
    if kind in ("longFirst", "doubleFirst"):
        return F.min_by(column, F.struct(time, column))
    if kind in ("longLast", "doubleLast"):
        return F.max_by(column, F.struct(time, column))
    if kind in ("hyperUnique", "cardinality"):
        return F.hll_sketch_estimate(F.hll_sketch_agg(F.col(column)))
    if kind == "thetaSketch":
        return F.theta_sketch_estimate(F.theta_sketch_agg(F.col(column)))
    raise ValueError(f"unknown aggregation: {kind}")


def post_aggregate(fn: str, a: Column, b: Column) -> Column:
    """A10: arithmetic of two aggregates; a division by 0 gives 0."""
    return {"+": a + b, "-": a - b, "*": a * b, "/": F.when(b == 0, 0.0).otherwise(a / b)}[fn]


def bucket(granularity: str, time: str) -> Column:
    return F.lit("all") if granularity == "all" else F.date_format(F.date_trunc(granularity, F.col(time).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm" if granularity in ("hour", "minute") else "yyyy-MM-dd")


def group_report(df: DataFrame, q: dict, as_of: str | None = None) -> DataFrame:
    """Q: time, granularity, dimensions {column: alias}, aggregations [(kind, column, name)], and optionally filters,
    interval, post [(name, fn, a, b)], having [(type, name, value)]."""
    rows = report_where(df, q.get("filters", []))
    if "interval" in q:
        lo, hi = interval(q["interval"], as_of)
        day = F.col(q["time"]).cast("date")
        rows = rows.where((day >= lo) & (day <= hi))
    dims = [F.col(c).alias(a) for c, a in q.get("dimensions", {}).items()]
    out = rows.groupBy(bucket(q.get("granularity", "all"), q["time"]).alias("date"), *dims).agg(*[aggregate(k, c, q["time"]).alias(n) for k, c, n in q["aggregations"]])
    for name, fn, a, b in q.get("post", []):
        out = out.withColumn(name, post_aggregate(fn, F.col(a), F.col(b) if isinstance(b, str) else F.lit(b)))
    for kind, name, value in q.get("having", []):
        out = out.where(HAVING[kind](F.col(name), value))
    return out


def top_report(df: DataFrame, q: dict, metric: str, threshold: int = 100, as_of: str | None = None) -> DataFrame:
    """The first `threshold` values of one dimension by a metric, per time bucket; ties by the dimension."""
    out = group_report(df, q, as_of)
    dim = next(iter(q["dimensions"].values()))
    return out.withColumn("_r", F.row_number().over(Window.partitionBy("date").orderBy(F.desc(metric), dim))).where(F.col("_r") <= threshold).drop("_r")


def time_report(df: DataFrame, q: dict, start: str, end: str) -> DataFrame:
    """One row per day, week or month between start and end, zeros where there are no rows."""
    unit = q["granularity"]
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.date_trunc(unit, F.lit(start)).cast("date"), F.lit(end).cast("date"), F.expr(f"interval 1 {unit}"))).alias("_d"))
    frame = days.select(F.date_format("_d", "yyyy-MM-dd").alias("date"))
    out = frame.join(group_report(df, {**q, "dimensions": {}}), "date", "left")
    return out.na.fill(0)


def normalised(df: DataFrame, rounded: bool = True) -> DataFrame:
    """Null texts become 'unknown', doubles are rounded to two digits."""
    texts = [c for c, t in df.dtypes if t == "string"]
    out = df.na.fill("unknown", texts)
    return out.withColumns({c: F.round(c, 2) for c, t in df.dtypes if t in ("double", "float")}) if rounded else out


def multi_report(frames: list[DataFrame], dims: list[str]) -> DataFrame:
    """Several metrics side by side on their dimensions and date; a later frame's value comes first."""

    def beside(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in b.columns if c in a.columns and c not in dims]
        b = b.withColumnsRenamed({c: f"_{c}" for c in shared})
        out = a.join(b, dims, "full")
        for c in shared:
            out = out.withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
        return out

    for f in frames:
        if not set(dims) <= set(f.columns):
            raise ValueError(f"dimensions differ: {dims} against {f.columns}")
    return reduce(beside, frames)


def pivoted(df: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Names as columns with their first value."""
    return df.groupBy(*keys).pivot(name, names).agg(F.first(value))


def progress(enrolments: DataFrame, users: DataFrame, orgs: DataFrame, places: DataFrame) -> DataFrame:
    """Enrolments with their user, organisation (a sub-organisation, else the root) and place."""
    rows = enrolments.join(users, "userid")
    sub = rows.join(orgs, (rows["orgid"] == orgs["org"]) & (rows["rootorg"] != orgs["org"])).select("enrolment", F.col("orgname").alias("subname"))
    root = orgs.select(F.col("org").alias("rootorg"), F.col("orgname").alias("rootname"))
    return rows.join(sub, "enrolment", "left").join(root, "rootorg", "left").join(places, "place", "left").withColumn("organisation", F.coalesce("subname", "rootname")).drop("subname")


def batch_stats(rows: DataFrame, batch: str) -> DataFrame:
    """R2: participants of each batch and those that completed."""
    return rows.groupBy(batch).agg(F.count_distinct("userid").alias("participants"), F.count_distinct(F.when(F.col("progress") == 100, F.col("userid"))).alias("completed"), F.count("*").alias("enrolments"))


def descend(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes (id, parent) with their level and root, from the roots down, `depth` levels at most."""
    level = nodes.where("parent is null").select("id", "parent", F.col("id").alias("root"), F.lit(0).alias("level"))
    out = level
    for i in range(1, depth + 1):
        up = level.select(F.col("id").alias("parent"), "root")
        level = nodes.where("parent is not null").join(up, "parent").select("id", "parent", "root", F.lit(i).alias("level"))
        out = out.unionByName(level)
    return out


def replay(df: DataFrame, day: Column, start: str, end: str, product) -> DataFrame:
    """A daily product over a range of days in one plan: product gets the rows with a column `day`; days without rows
    give nothing."""
    return product(df.withColumn("day", day).where((F.col("day") >= F.lit(start).cast("date")) & (F.col("day") <= F.lit(end).cast("date"))))


def corrected_status(ends: DataFrame, leaves: DataFrame, enrolments: DataFrame) -> DataFrame:
    """Progress and status of enrolments from the leaf contents that a user has ended: 2 when all, 1 when some, else 0."""
    size = leaves.groupBy("course").agg(F.count_distinct("content").alias("of"))
    done = ends.select("userid", "content").distinct().join(leaves, "content").groupBy("userid", "course").agg(F.count_distinct("content").alias("done"))
    out = enrolments.join(size, "course").join(done, ["userid", "course"], "left").withColumn("done", F.coalesce("done", F.lit(0)))
    return out.withColumn("progress", F.floor(F.col("done") * 100 / F.col("of"))).withColumn("status", F.when(F.col("done") >= F.col("of"), 2).when(F.col("done") > 0, 1).otherwise(0))


def usage_of(df: DataFrame, owner: str, things: Column, names: DataFrame) -> DataFrame:
    """Of each thing that owners use: owners, uses, and its name."""
    rows = df.select(owner, F.explode(things).alias("thing"))
    return rows.groupBy("thing").agg(F.count_distinct(owner).alias("owners"), F.count("*").alias("uses")).join(names, "thing", "left")
