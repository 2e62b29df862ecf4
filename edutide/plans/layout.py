"""Folders by date, documents of differing keys, extracts by event id, named reports and their manifests, products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.operators import aggregate, products
from edutide.sources import layout, variants
from edutide.sources.telemetry import TELEMETRY_SQL, read

from .basics import events, registry
from .streams import _folder

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = registry(QUERIES, SQL)


def _dated(spark: SparkSession, d: str, pattern: str) -> tuple[str, DataFrame]:
    rows, path = read(spark, d, "events"), _folder(spark, "dated")
    layout.write_dated(rows, path, F.col("ts"), pattern, ("event_type",))
    return path, rows


@query("s2_dated_scan", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' AND event_type <> 'error'")
def s2(spark: SparkSession, d: str) -> DataFrame:
    """Six days before the end, and the end; files below an excluded name left out."""
    path, rows = _dated(spark, d, "yyyy-MM-dd")
    return layout.scan_dated(spark, path, rows.schema, "2024-01-16", delta_days=6, exclude="event_type=error", also=("event_type",)).select("event_id", "ts")


@query("s2_folder_scan", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16'")
def s2_folder(spark: SparkSession, d: str) -> DataFrame:
    """The folder of one day, named by another pattern."""
    path, rows = _dated(spark, d, "yyyyMMdd")
    return layout.scan_dated(spark, path, rows.schema, "2024-01-16", pattern="yyyyMMdd", folder=True, also=("event_type",)).select("event_id", "ts")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON documents: which keys they have follows from their kind."""
    k = F.get_json_object("props", "$.k").cast("long")
    of = lambda kind, c: F.when(F.col("event_type") == kind, c)
    doc = F.struct(
        F.col("event_type").alias("kind"),
        F.struct(
            of("view", F.struct(F.concat(F.lit("p"), k % 7).alias("id"), F.array(k % 3, k % 5).alias("path"))).alias("page"),
            of("click", k).alias("target"), of("error", F.concat(F.lit("e"), k % 10)).alias("code"), of("purchase", F.col("user_id")).alias("buyer"),
        ).alias("edata"),
        F.when(F.col("event_id") % 7 == 0, F.lit("x,y")).alias("odd key"),
    )
    rows = read(spark, d, "events").select("event_id", "event_type", "ts", F.to_json(doc).alias("doc"))
    return rows.select("event_id", "event_type", "ts", variants.parsed(F.col("doc")).alias("v"))


DOCUMENTS_SQL = "e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


@query("p2_flatten", f"""WITH {DOCUMENTS_SQL} SELECT event_id, upper(event_type) AS kind, CASE event_type WHEN 'view' THEN 'p' || k % 7 END AS "page", CASE event_type WHEN 'view' THEN '[' || k % 3 || ',' || k % 5 || ']' END AS "edata.page.path",
  CASE event_type WHEN 'click' THEN k END AS "edata.target", CASE event_type WHEN 'error' THEN 'e' || k % 10 END AS "edata.code", CASE WHEN event_id % 7 = 0 THEN 'x,y' END AS "odd key" FROM e""")
def p2(spark: SparkSession, d: str) -> DataFrame:
    """The union of all rows' keys as header; one column hidden, one renamed, one changed by a function."""
    return variants.flatten(_documents(spark, d), "v", ("event_id",), hidden=("edata.buyer",), renamed={"edata.page.id": "page"}, mapped={"kind": F.upper})


PAGE_DOC = {"title": "<title>([^<]+)</title>", "heading": "<h1[^>]*>([^<]+)</h1>", "lang": '<html[^>]*lang="?([a-z]+)', "charset": 'charset="?([A-Za-z0-9-]+)'}


@query("p2_flatten_pages", "SELECT page_id, " + ", ".join(f"nullif(regexp_extract(html, '{p}', 1), '') AS \"{n}\"" for n, p in sorted(PAGE_DOC.items())) + ", nullif(len(regexp_extract_all(html, '<a\\s')), 0) AS links FROM pages")
def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    """P2 over documents made from pages: what a page lacks, its document lacks."""
    found = [F.nullif(F.regexp_extract("html", p, 1), F.lit("")).alias(n) for n, p in PAGE_DOC.items()]
    links = F.nullif(F.regexp_count("html", F.lit("<a\\s")), F.lit(0)).cast("long").alias("links")
    docs = read(spark, d, "pages").select("page_id", variants.parsed(F.to_json(F.struct(*found, links))).alias("v"))
    out = variants.flatten(docs, "v", ("page_id",))
    missing = [F.lit(None).cast("long" if n == "links" else "string").alias(n) for n in [*PAGE_DOC, "links"] if n not in out.columns]
    return out.select("*", *missing)


EXTRACT_SQL = f"""{DOCUMENTS_SQL}, x AS (SELECT event_type, event_id, epoch_us(ts) // 1000 AS ms, event_type AS kind, CASE event_type WHEN 'view' THEN 'p' || k % 7 || '|[' || k % 3 || ',' || k % 5 || ']' WHEN 'click' THEN CAST(k AS VARCHAR) WHEN 'error' THEN 'e' || k % 10 WHEN 'purchase' THEN CAST(user_id AS VARCHAR) ELSE '{{}}' END AS own,
  CASE event_type WHEN 'view' THEN 'edata.page.id|edata.page.path|' WHEN 'click' THEN 'edata.target|' WHEN 'error' THEN 'edata.code|' WHEN 'purchase' THEN 'edata.buyer|' ELSE 'edata|' END AS head, CASE WHEN event_id % 7 = 0 THEN 'x,y' ELSE '' END AS odd FROM e WHERE user_id % 3 = 2)"""


def _extract(spark: SparkSession, d: str) -> tuple[str, dict[str, list[str]]]:
    from edutide.functions.time import millis

    docs = _documents(spark, d).join(read(spark, d, "events").where("user_id % 3 = 2").select("event_id"), "event_id", "left_semi").withColumn("ms", millis("ts"))
    found = variants.headers(docs, "v", "event_type")
    own = {kind: [F.col("event_id"), F.col("ms"), *variants.columns("v", h)] for kind, h in found.items()}
    path = _folder(spark, "extract")
    layout.write_extract(docs, path, "event_type", own)
    return path, {kind: ["event_id", "ms", *[".".join(at) for at, _ in h]] for kind, h in found.items()}


@query("r5_extract", f"WITH {EXTRACT_SQL} SELECT event_type, event_id, ms, head || 'kind|odd key' AS header, coalesce(own || '|', '') || kind || '|' || odd AS line FROM x")
def r5(spark: SparkSession, d: str) -> DataFrame:
    """A channel's events, a folder of CSV files for each event id with the keys that its rows have as header; read back."""
    path, names = _extract(spark, d)
    out = None
    for kind, header in names.items():
        schema = ", ".join(f"`{n}` {'long' if n in ('event_id', 'ms') else 'string'}" for n in header)
        rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(f"{path}/{kind}")
        values = [F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in header[2:]]
        part = rows.select(F.lit(kind).alias("event_type"), "event_id", "ms", F.lit("|".join(header[2:])).alias("header"), F.concat_ws("|", *values).alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


@query("r6_manifest", f"WITH {EXTRACT_SQL} SELECT event_type, count(*) AS rows, min(ms) AS first_ms, max(ms) AS last_ms FROM x GROUP BY 1")
def r6(spark: SparkSession, d: str) -> DataFrame:
    """Counted from the files that R5 wrote."""
    path, _ = _extract(spark, d)
    files = layout.manifest(spark, path, "event_id long, ms long", "ms")
    return files.groupBy(F.substring_index("file", "/", 1).alias("event_type")).agg(F.sum("rows").alias("rows"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"


def _report(spark: SparkSession, d: str) -> str:
    path = _folder(spark, "report")
    layout.write_named(read(spark, d, "orders").select(*[c.split()[0] for c in ORDERS.split(", ")]), path, ["o_orderpriority", "o_orderstatus"])
    return path


@query("k8_partitioned_report", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderpriority || '/' || o_orderstatus || '.csv' AS file FROM orders")
def k8(spark: SparkSession, d: str) -> DataFrame:
    """K8: one file for each priority and status, named by them; all read back."""
    path = _report(spark, d)
    rows = spark.read.schema(ORDERS).option("header", True).option("recursiveFileLookup", True).csv(path)
    return rows.withColumn("file", F.array_join(F.slice(F.split(F.url_decode(F.col("_metadata.file_path")), "/"), -2, 2), "/"))


@query("k8_manifest", "SELECT o_orderpriority || '/' || o_orderstatus || '.csv' AS file, count(*) AS rows FROM orders GROUP BY 1")
def k8_manifest(spark: SparkSession, d: str) -> DataFrame:
    return layout.manifest(spark, _report(spark, d), ORDERS).select("file", "rows")


@query("x1_products", f"""WITH {TELEMETRY_SQL}
SELECT 'daily' AS product, 'events' AS input, (SELECT count(*) FROM t WHERE eid <> 'INTERRUPT') AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT channel, sid FROM t WHERE eid <> 'INTERRUPT')) AS rows_out
UNION ALL SELECT 'errors', 'events', (SELECT count(*) FROM t WHERE eid = 'INTERRUPT'), (SELECT count(DISTINCT uid) FROM t WHERE eid = 'INTERRUPT')
UNION ALL SELECT 'spend', 'orders', (SELECT count(*) FROM orders), (SELECT count(DISTINCT o_custkey) FROM orders)""")
def x1(spark: SparkSession, d: str) -> DataFrame:
    """Three products by name; how many rows went in and came out is observed while they are written."""
    folder = _folder(spark, "products")
    write = lambda name: lambda df: df.write.parquet(f"{folder}/{name}")
    registry_ = products.Registry()
    registry_.add(products.Product("daily", lambda i, c: {"events": i["events"].where(F.col("eid") != c["without"])}, lambda i, c: i["events"].groupBy("channel", "sid").agg(F.count("*").alias("n")), write("daily")))
    registry_.add(products.Product("errors", lambda i, c: {"events": i["events"].where("eid = 'INTERRUPT'")}, lambda i, c: i["events"].groupBy("uid").agg(F.max("ets").alias("last_ms")), write("errors")))
    registry_.add(products.Product("spend", lambda i, c: i, lambda i, c: i["orders"].groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent")), write("spend")))
    rows = []
    for name, inputs, config in (("daily", {"events": events(spark, d)}, {"without": "INTERRUPT"}), ("errors", {"events": events(spark, d)}, {}), ("spend", {"orders": read(spark, d, "orders")}, {})):
        ran = registry_.run(name, inputs, config)
        rows += [(name, what, n, ran.rows_out) for what, n in ran.rows_in.items()]
    return spark.createDataFrame(rows, "product string, input string, rows_in long, rows_out long")


X2_SQL = """WITH m AS (SELECT event_type, event_id % 9 AS b, sum(value) / count(*) AS mean FROM events GROUP BY 1, 2),
v AS (SELECT event_type, count(*) AS n, var_pop(value) AS variance FROM events GROUP BY 1)
SELECT event_type, n, round(variance, 4) AS variance, round((SELECT median(mean) FROM m WHERE m.event_type = v.event_type), 4) AS median_of_means FROM v"""


@query("x2_custom_aggregate", X2_SQL)
def x2(spark: SparkSession, d: str) -> DataFrame:
    """Two aggregates that a user gives as functions: a variance, and the median of the means of nine groups."""
    import numpy as np

    from edutide.sources.shipping import ship

    ship(spark)

    def add(state, rows):
        n, mean, square, sums, counts = state
        x = rows["value"].to_numpy(float)
        m, own = len(x), x.mean()
        square += ((x - own) ** 2).sum() + (own - mean) ** 2 * n * m / (n + m)
        group = rows["event_id"].to_numpy() % 9
        return n + m, mean + (own - mean) * m / (n + m), square, sums + np.bincount(group, x, 9), counts + np.bincount(group, minlength=9)

    def both(a, b):
        n, delta = a[0] + b[0], b[1] - a[1]
        return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta**2 * a[0] * b[0] / n, a[3] + b[3], a[4] + b[4]

    def end(state):
        n, _, square, sums, counts = state
        return n, square / n, float(np.median(sums[counts > 0] / counts[counts > 0]))

    rows = read(spark, d, "events").select("event_type", "event_id", "value").where("value is not null")
    custom = aggregate.Custom(lambda: (0, 0.0, 0.0, np.zeros(9), np.zeros(9, np.int64)), add, both, end, "n long, variance double, median_of_means double")
    out = aggregate.by(rows, ["event_type"], custom)
    return out.select("event_type", "n", F.round("variance", 4).alias("variance"), F.round("median_of_means", 4).alias("median_of_means"))

