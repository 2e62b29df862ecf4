"""Ranks and running totals over the order of a whole table, without one task for all rows.

Rows are dealt to range partitions and stored, so that a row's partition stays the same. Places and totals are made inside each
partition and moved by the totals of all partitions before it, of which there is one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.sources.shared import stored


def running(df: DataFrame, order: list[Column], totals: dict[str, str], parts: int = 0) -> DataFrame:
    """df with _place (from 1, in this order) and, for each item of totals (name -> column), the sum over all rows before.

    Rows that are equal in the order may stand in any order among themselves: give an order that tells rows apart.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = rows.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{name}") for name, c in totals.items()])
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = sums.select("_part", *[F.coalesce(F.sum(c).over(ahead), zero).alias(f"_base{c}") for c in ["_n", *[f"_sum_{name}" for name in totals]]])
    here = Window.partitionBy("_part").orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_place", F.row_number().over(here).cast("long"))
    for name, c in totals.items():
        rows = rows.withColumn(name, F.coalesce(F.sum(c).over(before), zero))
    rows = rows.join(F.broadcast(offsets), "_part").withColumn("_place", F.col("_place") + F.col("_base_n"))
    for name in totals:
        rows = rows.withColumn(name, F.col(name) + F.col(f"_base_sum_{name}"))
    return rows.select(*df.columns, "_place", *totals)
