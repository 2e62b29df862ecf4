"""Scans and sinks. Readers take explicit schemas; writers write in parallel and never collect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_events(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON lines by schema; malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def malformed(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """How many lines the scan keeps and drops."""
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return spark.read.text(paths).groupBy(parsed["_corrupt_record"].isNotNull().alias("bad")).count()


def dated(df: DataFrame, column: Column, end: str, delta_days: int = 0, start: str | None = None, exclude: str | None = None) -> DataFrame:
    """Rows of a date column between start (or end less delta) and end, both in; exclude: part of file names to leave out.
    On a table partitioned by the column, this prunes partitions."""
    last = F.lit(end).cast("date")
    first = F.lit(start).cast("date") if start else F.date_sub(last, delta_days)
    out = df.where((column >= first) & (column <= last))
    return out.where(~F.contains(F.input_file_name(), F.lit(exclude))) if exclude else out


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """S4."""
    return spark.createDataFrame([], schema)


def lookup(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of a table for a set of keys; a semi join, broadcast by Spark where the keys are few."""
    return table.join(keys.select(*on).distinct(), on, "left_semi")


def resolver(spark: SparkSession, folder: str):
    """Table name -> DataFrame, for reports that are given their reader."""
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S7."""
    return spark.read.option("header", True).schema(schema).csv(path)


def hierarchy_column(df: DataFrame, column: str, schema: str, kind: str) -> DataFrame:
    """A JSON document column as a struct, rows of one content type."""
    return df.withColumn(column, F.from_json(column, schema)).where(F.col(f"{column}.contentType") == kind)


def markup_ids(body: Column) -> Column:
    """Ids of assets in XML or JSON bodies, distinct, in order; none for null or bodies without any."""
    xml = F.regexp_extract_all(body, F.lit(r'(?i)\b(?:id|href|src)\s*=\s*"([^"]+)"'), 1)
    json = F.regexp_extract_all(body, F.lit(r'"(?:id|asset)"\s*:\s*"([^"]+)"'), 1)
    return F.coalesce(F.array_distinct(F.concat(xml, json)), F.array().cast("array<string>"))


def unbatch(df: DataFrame, column: str = "events") -> DataFrame:
    """The rows of a batch envelope."""
    return df.select(F.explode(column).alias("_e")).select("_e.*")


def active_tags(tags: DataFrame) -> DataFrame:
    """S12."""
    return tags.where("active").select("tag").distinct()


def csv_fields(df: DataFrame, fields: str) -> DataFrame:
    """The named (dotted) fields; nested values as JSON."""
    out = []
    for name in fields.split(","):
        c = F.col(name)
        nested = isinstance(df.select(c).schema[0].dataType, (T.ArrayType, T.StructType, T.MapType))
        out.append((F.to_json(c) if nested else c).alias(name))
    return df.select(*out)


def flatten(df: DataFrame, hidden: tuple[str, ...] = (), renamed: dict[str, str] | None = None, mapped: dict[str, object] | None = None) -> DataFrame:
    """Nested structs as dotted columns, arrays and maps as JSON; some hidden, renamed, or changed by a function."""
    out: list[Column] = []

    def walk(kind: T.StructType, path: list[str]) -> None:
        for f in kind.fields:
            here = [*path, f.name]
            name, c = ".".join(here), F.col(".".join(f"`{p}`" for p in here))
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here)
            elif name not in hidden:
                c = F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.MapType)) else c
                out.append((mapped or {}).get(name, lambda x: x)(c).alias((renamed or {}).get(name, name)))

    walk(df.schema, [])
    return df.select(*out)


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """K2, K3: one JSON string per line, appended, compressed if asked."""
    as_json(df).write.mode("append").option("compression", compression).text(path)


def write_console(df: DataFrame, show: bool = True, rows: int = 20) -> int:
    """K1: prints the first rows as JSON lines, if asked, and the number of all; returns the number."""
    if show:
        as_json(df).show(rows, truncate=False)
    n = df.count()
    print(f"Total rows: {n}")
    return n


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """K4: needs Spark's Kafka connector on the class path."""
    as_json(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish(df: DataFrame, folder: str, name: str, version: str) -> str:
    """K5: a versioned table and a pointer to it; readers follow the pointer, so the swap is one small write."""
    path = f"{folder}/{name}-{version}"
    df.write.parquet(path)
    df.sparkSession.createDataFrame([(name, path)], "name string, path string").coalesce(1).write.mode("overwrite").json(f"{folder}/{name}.current")
    return path


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(spark.read.json(f"{folder}/{name}.current").first()["path"])


def time_series(df: DataFrame, time: str, tags: list[str], fields: list[str], names: DataFrame | None = None) -> DataFrame:
    """K6: (time, tags, fields) points; with `names` (tag, tag_name), a name beside the tag."""
    if names is not None:
        df, tags = df.join(names, "tag", "left").withColumn("tag_name", F.coalesce("tag_name", "tag")), [*tags, "tag_name"]
    pairs = lambda cols, kind: F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast(kind))])
    return df.select(F.col(time).alias("time"), pairs(tags, "string").alias("tags"), pairs(fields, "double").alias("fields"))


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """K7: rows of new replace those of stored by key; with columns, only these are replaced and others keep old values."""
    changed = columns or [c for c in new.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit"))
    out = stored.join(n, keys, "full")
    rest = [c for c in stored.columns if c not in keys]
    return out.select(*keys, *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in rest])


def write_report(df: DataFrame, path: str, dims: list[str]) -> None:
    """K8: CSV with header, a folder per value of dims, which stay in the file."""
    for d in dims:
        df = df.withColumn(f"_{d}", F.col(d))
    df.write.mode("overwrite").partitionBy(*[f"_{d}" for d in dims]).option("header", True).csv(path)


def write_views(df: DataFrame, path: str, key: str, longest: int = 1024) -> None:
    """K9: JSON files per key; keys of `longest` characters or more are left out."""
    df.where(F.length(key) < longest).withColumn("_key", F.col(key)).write.mode("overwrite").partitionBy("_key").json(path)


def dispatch(df: DataFrame, sinks: list) -> int:
    """The same rows to each sink (a function of the frame), once computed; returns how many."""
    if not sinks:
        raise ValueError("no sinks")
    kept = df.persist()
    try:
        for sink in sinks:
            sink(kept)
        return kept.count()
    finally:
        kept.unpersist()
