"""Stored intermediates in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, a temporary one, set once, on a local master alone: on a
    cluster executors would not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet and read it back: an iteration's lineage ends here, and a lost executor costs nothing."""
    path = f"{shared_folder(df.sparkSession)}/edutide/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(rows: int, spark: SparkSession, share: int = 500_000) -> int:
    """Partitions of at most about `share` rows, as many as the session's shuffles have at least: a task's memory doesn't grow with a table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // share))
