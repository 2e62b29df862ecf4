"""Metric events, precomputed views and metric queries over fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_events(facts: DataFrame, updated: Column, product: str) -> DataFrame:
    """V1: day facts updated in a range, as JSON."""
    rows = facts.where(updated & (F.length(F.col("period").cast("string")) == 8))
    return rows.select("period", F.lit(product).alias("product"), F.to_json(F.struct("*")).alias("event"))


def view(facts: DataFrame, periods: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """V2: facts of a list of periods, aggregated by keys; the periods are a semi join."""
    return facts.join(periods.select("period"), "period", "left_semi").groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def query(facts: DataFrame, periods: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """V3: measures of each period, zeros where a period has no facts, and a summary row of period -1 over all."""
    wanted = facts.join(periods.select("period"), "period", "left_semi")
    aggs = [c.alias(n) for n, c in measures.items()]
    each = periods.select("period").join(wanted.groupBy("period").agg(*aggs), "period", "left").na.fill(0)
    total = wanted.groupBy(F.lit(-1).alias("period")).agg(*aggs)
    return each.unionByName(total)




def reducers(metric: str) -> dict[str, Column]:
    """V4: the measures of a metric, over fact columns that carry its totals."""
    total = lambda c: F.sum(c)
    common = {"total_ms": total("total_ms"), "total_sessions": total("total_sessions")}
    return {
        "usage": {**common, "avg_ts_session": F.round(F.sum("total_ms") / F.sum("total_sessions") / 1000, 2)},
        "content": {**common, "contents": F.count_distinct("content")},
        "device": {"devices": F.count_distinct("did")},
        "launch": {"launches": total("total_sessions"), "interactions": total("total_interactions")},
        "interactions": {"interactions": total("total_interactions"), "per_session": F.round(F.sum("total_interactions") / F.sum("total_sessions"), 2)},
        "list": {"contents": F.array_join(F.array_sort(F.collect_set("content")), ",")},
    }[metric]


def consumption(facts: DataFrame, launches: DataFrame) -> DataFrame:
    """Usage per visit, visits per launch, launches and usage per device, by period; guarded ratios."""
    from edutide.functions.scalars import ratio

    out = facts.join(launches, "period", "full").na.fill(0)
    return out.select("period", ratio(F.col("total_ms") / 1000, F.col("visits")).alias("usage_per_visit"), ratio(F.col("visits"), F.col("launches")).alias("visits_per_launch"), ratio(F.col("launches"), F.col("devices")).alias("launches_per_device"), ratio(F.col("total_ms") / 1000, F.col("devices")).alias("usage_per_device"))
