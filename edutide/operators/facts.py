"""Fact tables (U4 to U13): daily rows rolled up to day, week, month and all time, merged batch by batch with what is stored.

A fact row carries its sums, its extremes, distinct counts as Bloom states (bloom.py) and short lists of distinct values. Ratios are
made from these when facts are read. Each batch rewrites only the periods that it touches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.functions.time import PERIODS, period
from edutide.sources.shared import stored
from edutide.sources.versioned import VersionedTable

from . import bloom


def _merged(c: str, how: str) -> Column:
    return {"sum": F.sum(c), "min": F.min(c), "max": F.max(c), "list": F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))}[how]


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right by these columns, of which a null is the same as a null."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    return left.join(right, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], how).drop(*[f"_right_{k}" for k in keys])


def by_period(rows: DataFrame, columns: list[str], ms: str = "ets", kinds: tuple[str, ...] = PERIODS) -> DataFrame:
    """kind and period before these columns, a row for each kind of period."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), period(F.col(ms), k).alias("period")) for k in kinds]))
    return rows.select(each.alias("_p"), *columns).select("_p.kind", "_p.period", *columns)


@dataclass
class Facts:
    """keys; measures: column -> sum, min, max or list (of an array column, a distinct union); distinct: name -> column whose distinct
    values are counted; totals: key -> the value under which each row counts once more. Rows have a time in milliseconds, `ets`."""

    keys: list[str]
    measures: dict[str, str]
    distinct: dict[str, str] = field(default_factory=dict)
    kinds: tuple[str, ...] = PERIODS
    totals: dict[str, str] = field(default_factory=dict)

    def _summed(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*[_merged(c, how).alias(c) for c, how in self.measures.items()])

    def merge(self, rows: DataFrame, old: DataFrame | None) -> DataFrame:
        """rows: of by_period; old: facts. Facts of all their keys."""
        whole = ["kind", "period", *self.keys]
        counted = {name: bloom.inserted(rows.select(*whole, F.col(value).alias("_v")), whole, "_v", bloom.size_of(F.col("kind")), old, name) for name, value in self.distinct.items()}
        return self._joined(rows, counted, old)

    def _joined(self, rows: DataFrame, counted: dict[str, DataFrame], old: DataFrame | None) -> DataFrame:
        """rows: of the measures; counted: of distinct values, old ones too, by kind, period and keys."""
        whole = ["kind", "period", *self.keys]
        sums = self._summed(rows, whole)
        if old is not None:
            sums = self._summed(sums.unionByName(old.select(*whole, *self.measures)), whole)
        for name, found in counted.items():
            sums = _same(sums, found, whole, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
            sums = sums.withColumn(f"{name}_bits", F.coalesce(f"{name}_bits", F.create_map().cast("map<bigint,binary>")))
        return sums

    def _counted(self, each: DataFrame, old: DataFrame | None) -> dict[str, DataFrame]:
        """Distinct values of rows with all their periods, and of old facts, by kind, period and keys.

        Facts have numbers while values are counted. A value is there once for the periods and keys of its rows, lies with all that it
        has in one partition, and is counted there once for a fact without a shuffle."""
        whole, fine, own = ["kind", "period", *self.keys], [*(f"_{k}" for k in self.kinds), *self.keys], [f"_own_{k}" for k in self.keys]
        groups = each.select(*fine).distinct().withColumns({o: F.col(k) for o, k in zip(own, self.keys)})
        groups = stored(self._spread(groups, [*fine, *own]), "groups")
        facts = groups.select(*whole) if old is None else groups.select(*whole).unionByName(old.select(*whole))
        numbers = stored(facts.distinct().withColumns({"_g": F.monotonically_increasing_id(), "_size": bloom.size_of(F.col("kind"))}), "numbers")
        of = [c if c not in self.keys else f"_own_{c}" for c in fine]
        groups = _same(groups.select(*whole, *of), numbers, whole).groupBy(*of).agg(F.collect_list(F.struct("_g", "_size")).alias("_in"))
        groups = stored(groups.withColumnsRenamed(dict(zip(own, self.keys))).withColumn("_f", F.monotonically_increasing_id()), "groups")
        rows = _same(each.select(*fine, *(F.col(v).alias(f"_of_{n}") for n, v in self.distinct.items())), groups.select(*fine, "_f"), fine)
        old = None if old is None else _same(old, numbers, whole)
        out = {}
        for name in self.distinct:
            found = rows.select("_f", F.col(f"_of_{name}").alias("_v")).where("_v is not null").distinct()
            found = bloom.hashed(found, "_v").repartition("_v").join(groups.select("_f", "_in"), "_f").select(F.explode("_in").alias("_n"), "_v", "_a", "_b")
            counted = bloom.inserted(found.select("_n._g", "_n._size", "_v", "_a", "_b"), ["_g", "_size"], "_v", F.col("_size"), old, name)
            out[name] = counted.join(numbers.drop("_size"), "_g").select(*whole, name, f"{name}_bits")
        return out

    def _spread(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """kind and period before these columns, a row for each kind of period and, of a key with a total, for that as well."""
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("period")) for k in self.kinds]))
        rows = rows.select(each.alias("_p"), *columns).select("_p.kind", "_p.period", *columns)
        for key, total in self.totals.items():
            if key in columns:
                rows = rows.withColumn(key, F.explode(F.array(F.col(key), F.lit(total))))
        return rows

    def add(self, table: VersionedTable, batch: str, rows: DataFrame) -> bool:
        """Rolls rows up into the table, unless the batch is in already. Rows are stored with their periods, and what is left of
        them by all periods at once is spread over these."""
        if batch in table.batches():
            return False
        periods = [f"_{k}" for k in self.kinds]
        wanted = list(dict.fromkeys([*self.keys, *self.measures, *self.distinct.values()]))
        each = stored(rows.select(*[period(F.col("ets"), k).alias(f"_{k}") for k in self.kinds], *wanted), "batch")
        sums = self._spread(self._summed(each, [*periods, *self.keys]), [*self.keys, *self.measures])
        touched = self._spread(each.select(*periods).distinct(), [])
        return table.apply(batch, touched, lambda _, old: self._joined(sums, self._counted(each, old) if self.distinct else {}, old))


def fact_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ["kind", "period"])


def item_lists(facts: DataFrame, keys: list[str], response: str, count: str, top: int = 5) -> DataFrame:
    """U8: facts by keys and response to one row per keys: the `top` most frequent responses with their counts, ties by response."""
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(F.desc(count), response)
    ranked = facts.where(F.col(count) > 0).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", response, count))), lambda x: F.concat_ws(":", x[response], x[count].cast("string"))), ",")
    return ranked.groupBy(*keys).agg(listed.alias("responses"))
