"""Audits, duplicate analysis, repairs and validation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: percentage points within which a difference is amber.
AMBER_BAND = 0.5


def status(percent: Column, threshold: float) -> Column:
    """GREEN up to the threshold, AMBER up to half a point more, else RED."""
    return F.when(percent <= threshold, "GREEN").when(percent <= threshold + AMBER_BAND, "AMBER").otherwise("RED")


def stage_audit(counts: DataFrame, pairs: list[tuple[str, str]], threshold: float = 1.0) -> DataFrame:
    """Per pair of pipeline stages: input, output, difference in percent, status; and the overall one (RED if any is)."""
    stages = F.explode(F.array(*[F.struct(F.lit(a).alias("from_stage"), F.lit(b).alias("to_stage")) for a, b in pairs]))
    frame = counts.sparkSession.range(1).select(stages.alias("p")).select("p.*")
    side = lambda name, n: counts.select(F.col("stage").alias(name), F.col("n").alias(n))
    out = frame.join(side("from_stage", "input"), "from_stage", "left").join(side("to_stage", "output"), "to_stage", "left").na.fill(0)
    percent = F.when(F.col("input") == 0, 0.0).otherwise(F.round(F.abs(F.col("input") - F.col("output")) * 100 / F.col("input"), 2))
    out = out.withColumn("percent", percent).withColumn("status", status(F.col("percent"), threshold))
    overall = out.agg(F.when(F.max(F.col("status") == "RED"), "RED").when(F.max(F.col("status") == "AMBER"), "AMBER").otherwise("GREEN").alias("overall"))
    return out.join(F.broadcast(overall))  # one row


def failed_by_producer(events: DataFrame, failed: Column, producer: list[str], threshold: float = 1.0) -> DataFrame:
    """Failed events of each producer, in percent of all events; the total is one row."""
    total = events.agg(F.count("*").alias("total"))
    out = events.where(failed).groupBy(*producer).agg(F.count("*").alias("failed")).join(F.broadcast(total))
    return out.withColumn("percent", F.round(F.col("failed") * 100 / F.col("total"), 2)).withColumn("status", status(F.col("percent"), threshold))


def store_audit(a: DataFrame, b: DataFrame, day: str, threshold: float = 1.0) -> DataFrame:
    """D3: two stores' counts by day and their difference."""
    left, right = a.groupBy(day).agg(F.count("*").alias("a")), b.groupBy(day).agg(F.count("*").alias("b"))
    out = left.join(right, day, "full").na.fill(0)
    percent = F.when(F.col("a") == 0, F.when(F.col("b") == 0, 0.0).otherwise(100.0)).otherwise(F.round(F.abs(F.col("a") - F.col("b")) * 100 / F.col("a"), 2))
    return out.withColumn("percent", percent).withColumn("status", status(F.col("percent"), threshold))


def duplicates(events: DataFrame, key: str, kind: str, excluded: list[str] | None = None) -> DataFrame:
    """Per kind: rows, distinct keys and the share of rows that repeat one, in percent. Counted by key first, so that a
    much repeated key is combined before the shuffle."""
    rows = events.where(~F.col(kind).isin(excluded)) if excluded else events
    per_key = rows.groupBy(kind, key).agg(F.count("*").alias("n"))
    out = per_key.groupBy(kind).agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.sum((F.col("n") > 1).cast("long")).alias("repeated_keys"))
    return out.withColumn("percent", F.round((F.col("rows") - F.col("keys")) * 100 / F.col("rows"), 2))


def repair(events: DataFrame, stage: str) -> DataFrame:
    """Failed rows of a stage: a text duration becomes a number, flags are set, metadata is cleared."""
    return events.where(F.col("failed_stage") == stage).withColumn("duration", F.col("duration").try_cast("double")).withColumn("repaired", F.lit(True)).withColumn("metadata", F.lit(None).cast("string"))


def with_sync_time(events: DataFrame, sync: str, ets: str) -> DataFrame:
    """A missing sync time becomes the event time."""
    return events.withColumn(sync, F.coalesce(sync, ets))


def sync_day(raw: Column) -> Column:
    """The UTC day of a sync time that is milliseconds (as text, long or double) or a time string; null if neither."""
    ms = raw.cast("string").try_cast("double")
    by_number = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int"))
    return F.coalesce(by_number, F.substring(raw.cast("string"), 1, 10).try_cast("date"))


def validated(log: DataFrame, needed: list[str]) -> DataFrame:
    """The first needed field that is null or blank as the reject reason, null for valid rows."""
    reason = F.lit(None).cast("string")
    for c in reversed(needed):
        reason = F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), f"missing {c}").otherwise(reason)
    return log.withColumn("reject", reason)


def late_audit(events: DataFrame, day: Column, sync: Column, minus: int = 1, plus: int = 2, threshold: float = 1.0) -> DataFrame:
    """T4: per event day, how many events were synced from `minus` days before it to `plus` days after it, and the share of
    those outside, in percent. Events without a sync day are outside; those without an event day aren't counted."""
    rows = events.select(day.alias("day"), F.coalesce(sync.between(F.date_sub(day, minus), F.date_add(day, plus)), F.lit(False)).alias("inside")).where("day IS NOT NULL")
    out = rows.groupBy("day").agg(F.count("*").alias("events"), F.count_if("inside").alias("in_time"))
    out = out.withColumn("percent", F.round((F.col("events") - F.col("in_time")) * 100 / F.col("events"), 2))
    return out.withColumn("status", status(F.col("percent"), threshold))


#: Audits by name. Each is a function of frames and parameters to a frame with a status.
AUDITS: dict[str, Callable[..., DataFrame]] = {"stages": stage_audit, "producers": failed_by_producer, "stores": store_audit, "late": late_audit}


def run_audits(configs: list[dict]) -> DataFrame:
    """Runs audits in order of their priority; each config: name, audit (a name in AUDITS), priority, params, threshold.
    Per audit one row: name, how many lines it checked, how many are RED, and its worst status. An unknown audit raises."""
    unknown = sorted({c["audit"] for c in configs} - set(AUDITS))
    if unknown or not configs:
        raise ValueError(f"unknown audits: {unknown}" if unknown else "no audits")

    def one(c: dict) -> DataFrame:
        red, amber = F.count_if(F.col("status") == "RED"), F.count_if(F.col("status") == "AMBER")
        worst = F.when(red > 0, "RED").when(amber > 0, "AMBER").otherwise("GREEN")
        lines = AUDITS[c["audit"]](**c["params"], threshold=c.get("threshold", 1.0))
        return lines.agg(F.lit(c["name"]).alias("name"), F.count("*").alias("checked"), red.alias("red"), worst.alias("status"))

    return reduce(DataFrame.unionByName, [one(c) for c in sorted(configs, key=lambda c: c.get("priority", 0))])
