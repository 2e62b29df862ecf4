"""Folders: by date, by event id, one named file for each value. What is written appears under its name when it is whole."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from . import files


def write_dated(df: DataFrame, path: str, time: Column, pattern: str = "yyyy-MM-dd", also: tuple[str, ...] = ()) -> None:
    """A folder for each day, named by the pattern (dt=...), and below it for each value of the columns `also`. Days of which much
    comes are spread over several files."""
    rows = df.withColumn("dt", F.date_format(time, pattern)).withColumns({f"by_{c}": F.col(c).cast("string") for c in also})
    parts = ["dt", *[f"by_{c}" for c in also]]
    rows.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)


def scan_dated(spark: SparkSession, path: str, schema: StructType, end: str, start: str | None = None, delta_days: int = 0, pattern: str = "yyyy-MM-dd", exclude: str | None = None, folder: bool = False, created: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """The rows of the days from start (or end less delta_days) to end, both in. The condition is on the folders' names, so that
    no file of another day is opened.

    exclude: files with this in their path are left out. folder: only the folder of `end`. created: instead of days, the files last
    changed on this day (yyyy-MM-dd).
    """
    parts = [StructField("dt", StringType()), *[StructField(f"by_{c}", StringType()) for c in also]]
    df = spark.read.schema(StructType([*schema.fields, *parts])).parquet(path)
    last = F.lit(end).cast("date")
    if created is not None:
        df = df.where(F.to_date("_metadata.file_modification_time") == F.lit(created).cast("date"))
    elif folder:
        df = df.where(F.col("dt") == F.date_format(last, pattern))
    else:
        first = F.lit(start).cast("date") if start else F.date_sub(last, delta_days)
        df = df.where(F.to_date("dt", pattern).between(first, last))
    if exclude:
        df = df.where(~F.contains(F.col("_metadata.file_path"), F.lit(exclude)))
    return df.select(*schema.names)


def write_named(df: DataFrame, path: str, dims: list[str]) -> list[str]:
    """K8: one CSV file with header for each combination of values of dims (which stay in the file), named by the values. All files
    appear together, when the last one is written; an earlier report of that name goes only then. Returns the files' names."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    parts = [f"_{d}" for d in dims]
    rows = df.withColumns({p: F.coalesce(F.col(d).cast("string"), F.lit("null")) for p, d in zip(parts, dims)})
    rows.repartition(*[F.col(p) for p in parts]).write.partitionBy(*parts).option("header", True).csv(f"{staged}/parts")
    names = []
    for found in sorted(files.files(spark, f"{staged}/parts")):
        values = [x.split("=", 1)[1] for x in found.split("/")[:-1]]
        names.append("/".join(values) + ".csv")
        files.move(spark, f"{staged}/parts/{found}", f"{staged}/whole/{names[-1]}")
    if not names:
        df.limit(0).write.option("header", True).csv(f"{staged}/whole")
    if files.exists(spark, path):
        files.remove(spark, path)
    files.move(spark, f"{staged}/whole", path)
    files.remove(spark, staged)
    return [unquote(n) for n in names]


def manifest(spark: SparkSession, path: str, schema: str = "first string", time: str | None = None) -> DataFrame:
    """Of each CSV file below path: file, bytes, rows (without the header); with `time`, a column of the schema, its least and
    greatest value, first_ms and last_ms. All counted from what was written."""
    sizes = spark.createDataFrame(list(files.files(spark, path).items()), "file string, bytes long")
    found = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    name = F.regexp_replace(full, f"^.*?{re.escape(path.split('://')[-1].rstrip('/'))}/", "")
    spans = [F.min(time).alias("first_ms"), F.max(time).alias("last_ms")] if time else []
    rows = found.withColumn("file", name).groupBy("file").agg(F.count("*").alias("rows"), *spans)
    return sizes.join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def write_extract(df: DataFrame, path: str, kind: str, columns: dict[str, list[Column]]) -> None:
    """A folder of CSV files with header for each event id of `columns`, with these columns. The folders appear together."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    for value, own in columns.items():
        df.where(F.col(kind) == value).select(*own).write.option("header", True).csv(f"{staged}/{value}")
    if files.exists(spark, path):
        files.remove(spark, path)
    files.move(spark, staged, path)
