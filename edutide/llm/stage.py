"""Shared plumbing of the training-data operators: size-checked broadcasts, reading tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.sources.shared import stored

__all__ = ["free_name", "parallelism", "row_digest", "small_side", "stored", "table"]

#: Rows of (long, small value) up to which a side may be broadcast: as a hashed relation, about 64 bytes a row and so 32 MB.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows that it has at most `limit` narrow rows, else df for a shuffled join."""
    return F.broadcast(df) if df.count() <= limit else df


def free_name(df: DataFrame, name: str) -> str:
    """name, behind as many underscores as it takes for no column of df to have it (names are told without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_digest(*columns: str) -> Column:
    """A digest of these columns, the same for rows that are alike in them and for no others: each value stands behind its length."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("null;")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def parallelism(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)
