"""The "all" cube (A6): named combinations of dimensions, each real or 'all', plus the same per registered tag.

Untagged combinations are GROUPING SETS over the rows, tagged ones over the rows exploded by tag, so aggregation is partial on
the map side and the 'all' keys put no pile of rows into one task.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subsets(dims: list[str]) -> list[list[str]]:
    return [[d for d, on in zip(dims, mask) if on] for mask in product((1, 0), repeat=len(dims))]


def _sets(df: DataFrame, fixed: list[str], dims: list[str], combos: list[list[str]], aggs: list[Column]) -> DataFrame:
    sets = [[F.col(c) for c in [*fixed, *combo]] for combo in combos]
    out = df.groupingSets(sets, *[F.col(c) for c in [*fixed, *dims]]).agg(*aggs, *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    return out.select(*fixed, *[F.when(F.col(f"_g_{d}") == 1, "all").otherwise(F.col(d)).alias(d) for d in dims], *[c for c in out.columns if c not in (*fixed, *dims) and not c.startswith("_g_")])


def all_cube(df: DataFrame, fixed: list[str], dims: list[str], aggs: list[Column], combos: list[list[str]] | None = None, tag_combos: list[list[str]] | None = None, registered: list[str] | None = None, tags: str = "tags") -> DataFrame:
    """fixed, dims (value or 'all'), tag ('all' or a registered one), measures. combos: the dims that are real in each kind of
    row, all subsets if not given; tag_combos: those emitted per tag. Rows with an empty or null dim are left out."""
    df = df.where(" and ".join(f"{d} is not null and {d} != ''" for d in dims)) if dims else df
    combos = subsets(dims) if combos is None else combos
    out = _sets(df, fixed, dims, combos, aggs).withColumn("tag", F.lit("all"))
    if registered:
        known = F.array_intersect(tags, F.array(*[F.lit(t) for t in registered]))
        tagged = df.withColumn("tag", F.explode(F.array_distinct(known)))
        out = out.unionByName(_sets(tagged, [*fixed, "tag"], dims, combos if tag_combos is None else tag_combos, aggs))
    return out
