"""Sessions: rows of a key in time order, cut by boundary flags and a running sum; then idle-capped measures of each.

No buffer of a key is made in Python: flags come from lag(), session numbers from a running sum, measures from aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.functions.scalars import per_minute
from edutide.functions.time import round2_ms


def _order(keys: list[str], time: str = "ets", tie: str = "mid"):
    return Window.partitionBy(*keys).orderBy(time, tie)


def gaps(df: DataFrame, keys: list[str], idle_s: int = 600) -> DataFrame:
    """gap_ms to the key's previous row, 0 for the first and for gaps over idle_s."""
    gap = F.col("ets") - F.lag("ets").over(_order(keys))
    return df.withColumn("gap_ms", F.when(gap.isNull() | (gap > idle_s * 1000), F.lit(0).cast("long")).otherwise(gap))


def time_spent(df: DataFrame, keys: list[str], idle_s: int = 600) -> DataFrame:
    """Seconds per key, gaps over idle_s as 0."""
    return gaps(df, keys, idle_s).groupBy(*keys).agg(round2_ms(F.sum("gap_ms")).alias("time_spent"), F.count("*").alias("n_events"))


def by_object(df: DataFrame, keys: list[str], object_col: str = "content", starts: tuple[str, ...] = ("START",), ends: tuple[str, ...] = ("END",)) -> DataFrame:
    """Session number within keys. A start row opens one; an end row closes its own; on other rows a change from
    the last object seen on a row that is no end opens one."""
    w = _order(keys)
    is_start, is_end = F.col("eid").isin(*starts), F.col("eid").isin(*ends)
    last_object = F.last(F.when(~is_end, F.col(object_col)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    changed = ~is_start & ~is_end & F.coalesce(last_object != F.col(object_col), F.lit(False))
    after_end = F.coalesce(F.lag(is_end).over(w), F.lit(True))
    new = is_start | changed | after_end
    return df.withColumn("_new", new.cast("int")).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def by_gap(df: DataFrame, keys: list[str], idle_min: int = 30, starts: tuple[str, ...] = ("START",), ends: tuple[str, ...] = ("END",), starts_split: bool = True) -> DataFrame:
    """Session number within keys. A start row opens one (if starts_split); other rows do after a gap of at least
    idle_min, an end row only after a longer one; an end row closes its session. No gap is tested right after an end."""
    w = _order(keys)
    is_start, is_end = F.col("eid").isin(*starts), F.col("eid").isin(*ends)
    gap = F.col("ets") - F.lag("ets").over(w)
    idle = idle_min * 60_000
    late = F.when(is_end, gap > idle).otherwise(gap >= idle)
    if not starts_split:
        late = late & ~is_start
    after_end = F.coalesce(F.lag(is_end).over(w), F.lit(True))
    new = after_end | F.coalesce(late, F.lit(False)) | (is_start if starts_split else F.lit(False))
    return df.withColumn("_new", new.cast("int")).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def pages(df: DataFrame, keys: list[str], page_col: str = "page", opener: str = "IMPRESSION", idle_s: int = 600) -> DataFrame:
    """Per keys and page: seconds from each impression to the next, and visits. Rows before a key's first impression
    belong to no page."""
    w = _order(keys)
    seen = gaps(df, keys, idle_s).withColumn("_seg", F.count(F.when(F.col("eid") == opener, 1)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    opened = df.where(F.col("eid") == opener).withColumn("_seg", F.row_number().over(w)).select(*keys, "_seg", page_col)
    spent = seen.groupBy(*keys, "_seg").agg(F.sum("gap_ms").alias("ms"))
    return opened.join(spent, [*keys, "_seg"], "left").groupBy(*keys, page_col).agg(round2_ms(F.sum(F.coalesce("ms", F.lit(0)))).alias("time_spent"), F.count("*").alias("visits"))


def environments(page_rows: DataFrame, keys: list[str], env: Column) -> DataFrame:
    """Per environment: time summed, visits of its most visited page."""
    return page_rows.withColumn("env", env).groupBy(*keys, "env").agg(F.round(F.sum("time_spent"), 2).alias("time_spent"), F.max("visits").alias("count"))


def stages(df: DataFrame, keys: list[str], stage_col: str = "page", idle_s: int = 600) -> DataFrame:
    """Per stage: time of rows until the stage changes, visits counted at each change, the first one as 'splash' before."""
    w = _order(keys)
    before = F.lag(stage_col).over(w)
    rows = gaps(df, keys, idle_s).withColumn("_from", F.coalesce(before, F.lit("splash"))).withColumn("_visit", F.coalesce(before != F.col(stage_col), F.lit(True)).cast("int"))
    return rows.groupBy(*keys, F.col("_from").alias("stage")).agg(round2_ms(F.sum("gap_ms")).alias("time_spent"), F.sum(F.col("_visit")).alias("changes"))


def navigation(df: DataFrame, keys: list[str], navigate: str = "IMPRESSION", interrupt: str = "INTERRUPT", idle_s: int = 1800) -> DataFrame:
    """Per page of navigation rows: time to the next navigation less what interrupts took in between."""
    w = _order(keys)
    rows = df.withColumn("_seg", F.count(F.when(F.col("eid") == navigate, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    stops = gaps(rows, keys, idle_s).where(F.col("eid") == interrupt).groupBy(*keys, "_seg").agg(F.sum("gap_ms").alias("stop_ms"))
    navs = rows.where(F.col("eid") == navigate).withColumn("next_ms", F.coalesce(F.lead("ets").over(w) - F.col("ets"), F.lit(0)))
    return navs.join(stops, [*keys, "_seg"], "left").groupBy(*keys, "page").agg(round2_ms(F.sum(F.greatest(F.col("next_ms") - F.coalesce("stop_ms", F.lit(0)), F.lit(0)))).alias("time_spent"), F.count("*").alias("visits"))


def interrupts(df: DataFrame, keys: list[str], interrupt: str = "INTERRUPT", resume: str = "START") -> DataFrame:
    """Seconds from an interruption to the next resume row; further resumes add nothing until another interruption."""
    w = _order(keys)
    marks = df.where(F.col("eid").isin(interrupt, resume))
    from_ = F.lag(F.struct("eid", "ets")).over(w)
    ms = F.when((F.col("eid") == resume) & (from_["eid"] == interrupt), F.col("ets") - from_["ets"])
    return marks.withColumn("ms", ms).groupBy(*keys).agg(round2_ms(F.coalesce(F.sum("ms"), F.lit(0))).alias("interrupt_time"), F.count("ms").alias("pairs"))


def summary(df: DataFrame, keys: list[str], idle_s: int = 600, least_s: float = 0.0, short_raw: bool = False, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per session: start, end, idle-capped time, whole time, interactions and their rate, events; time >= least_s."""
    ms = F.sum("gap_ms")
    out = gaps(df, keys, idle_s).groupBy(*keys).agg(
        F.min("ets").alias("start_ms"),
        F.max("ets").alias("end_ms"),
        ms.alias("_ms"),
        F.count("*").alias("n_events"),
        F.count(F.when(F.col("eid") == "INTERACT", 1)).alias("interactions"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )
    spent = round2_ms(F.col("_ms"))
    out = out.withColumn("time_spent", spent).withColumn("time_diff", round2_ms(F.col("end_ms") - F.col("start_ms")))
    return out.withColumn("interactions_per_min", per_minute(F.col("interactions"), F.col("time_spent"), short_raw)).where(F.col("time_spent") >= least_s).drop("_ms")


def attempts(df: DataFrame, keys: list[str], item: str = "k") -> DataFrame:
    """Attempts of a session: how often its most repeated question came."""
    return df.groupBy(*keys, item).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("attempts"))


def nth_in_session(df: DataFrame, keys: list[str], eid: str, n: int) -> DataFrame:
    """Seconds between the (k-1)-th and the k-th row of a kind, for k = 1..n, as columns page1..pagen."""
    w = _order(keys)
    rows = df.withColumn("_from", F.min("ets").over(Window.partitionBy(*keys))).where(F.col("eid") == eid)
    rows = rows.withColumn("k", F.row_number().over(w)).withColumn("ms", F.col("ets") - F.coalesce(F.lag("ets").over(w), F.col("_from"))).where(F.col("k") <= n)
    return rows.groupBy(*keys).agg(*[round2_ms(F.max(F.when(F.col("k") == i, F.col("ms")))).alias(f"page{i}") for i in range(1, n + 1)])


def funnel(df: DataFrame, keys: list[str], stage_of: dict[str, str]) -> DataFrame:
    """Per key: rows of each stage, and whether it was reached, by a lookup of the event id; inverted for 'skipped'."""
    counts = []
    for eid, stage in stage_of.items():
        n = F.count(F.when(F.col("eid") == eid, 1))
        counts += [n.alias(f"{stage}_count"), (n == 0 if stage == "skipped" else n > 0).cast("int").alias(f"{stage}_reached")]
    return df.groupBy(*keys).agg(*counts)


def recommendation_funnel(df: DataFrame, keys: list[str], call: str = "START", shown: str = "IMPRESSION", download: str = "INTERRUPT", played: str = "END") -> DataFrame:
    """Per recommendation call: what followed before the next call: clicks, downloads, plays, and whether it was consumed."""
    w = _order(keys)
    rows = df.withColumn("call", F.count(F.when(F.col("eid") == call, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("call > 0")
    has = lambda e: F.count(F.when(F.col("eid") == e, 1))
    return rows.groupBy(*keys, "call").agg(has(shown).alias("shown"), has("INTERACT").alias("clicked"), has(download).alias("downloads"), has(played).alias("plays"), (has(played) > 0).cast("int").alias("consumed"))
