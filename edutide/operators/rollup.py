"""Fact tables: rows of a day rolled up to day, week, month and cumulative periods and merged with what is stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.functions.time import PERIODS, period


def rollup(new: DataFrame, keys: list[str], merge: dict[str, str], ms: str = "ets", kinds: tuple[str, ...] = PERIODS) -> DataFrame:
    """One row per period kind, period and keys. merge: measure -> 'sum', 'min', 'max' or 'sketch'. The four kinds are made in
    one pass: each row is expanded to its periods, and aggregated partially before the shuffle."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), period(F.col(ms), k).alias("period")) for k in kinds]))
    rows = new.withColumn("_p", each).select("_p.kind", "_p.period", *keys, *merge)
    return rows.groupBy("kind", "period", *keys).agg(*[_merged(c, how).alias(c) for c, how in merge.items()])


def _merged(c: str, how: str) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg}[how](c)


def merge(new: DataFrame, stored: DataFrame | None, keys: list[str], how: dict[str, str]) -> DataFrame:
    """Stored facts with new ones added: full outer by a union and one aggregate. That a batch is added once is the concern of
    the table (sources/versioned.py), which has a ledger of its batches."""
    rows = new if stored is None else stored.select(*new.columns).unionByName(new)
    return rows.groupBy(*keys).agg(*[_merged(c, h).alias(c) for c, h in how.items()])


def start_of_period(current: DataFrame, stored: DataFrame | None, keys: list[str], values: list[str], as_of_ms: int) -> DataFrame:
    """U16: for day, week and month of the as-of time: the stored value at the period's start, the current one if there is none."""
    kinds = ("DAY", "WEEK", "MONTH")
    at = F.lit(as_of_ms).cast("long")
    rows = reduce(DataFrame.unionByName, [current.withColumn("kind", F.lit(k)).withColumn("period", period(at, k)) for k in kinds])
    if stored is None:
        return rows.select("kind", "period", *keys, *values, *[F.col(v).alias(f"{v}_start") for v in values])
    old = stored.select("kind", "period", *keys, *[F.col(f"{v}_start") for v in values])
    out = rows.join(old, ["kind", "period", *keys], "left")
    return out.select("kind", "period", *keys, *values, *[F.coalesce(f"{v}_start", v).alias(f"{v}_start") for v in values])


def latest(rows: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """The last row of each key by time, then tie."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time, tie)).alias("_row")).select(key, "_row.*")


def lifecycle_times(changes: DataFrame, key: str, status: str, time: str) -> DataFrame:
    """Milliseconds that each object spent in Draft and in Review, from consecutive changes."""
    nxt = F.lead(time).over(Window.partitionBy(key).orderBy(time, status))
    spent = changes.withColumn("ms", nxt - F.col(time))
    return spent.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col(status) == s, F.col("ms"))), F.lit(0)).alias(f"{s.lower()}_ms") for s in ("Draft", "Review")])


def change_events(df: DataFrame, key: str, props: list[str]) -> DataFrame:
    """One JSON change event per row: nodeUniqueId and {property: {ov, nv}}."""
    change = F.struct(*[F.struct(F.lit(None).cast("string").alias("ov"), F.col(p).alias("nv")).alias(p) for p in props])
    return df.select(F.col(key).alias("node"), F.to_json(F.struct(F.col(key).alias("nodeUniqueId"), change.alias("properties")), {"ignoreNullFields": "false"}).alias("event"))
