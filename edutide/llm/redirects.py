"""URL verdicts by rules, carried over to redirect-equivalent pages (operator 9).

Canonical links and refresh redirects in a page's markup are edges between URLs, and so is the step from a URL to its canonical
form (without scheme, www, tracking parameters, .html, and a slash at the end). Distributed connected components make classes of
equivalent URLs; the URLs of a class that a rule names decide for those that none names: an explicit allow first, else a
block, else allow. A page's own rule always comes before its class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER
from .components import connected_components
from .stage import stored

UPPER_CASE = "".join(chr(c) for c in range(256) if LOWER[c] != c)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER_CASE, UPPER_CASE.lower())


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the rules (action, host, path) that fits the host or one above it, and the path's beginning: a struct
    (rule, action), or null. For a policy of some hundred rules, kept in the plan."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """A URL without its fragment, scheme and host in lower case."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    return F.concat(lower_ascii(head), F.substr(bare, F.length(head) + 1))


#: Query parameters that only follow visitors.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|msclkid|mc_[ce]id)(=|$)"


def canonical_of(node: Column) -> Column:
    """The form that variants of a URL share, from its node; null without ://. One pattern takes off what stands before the host
    and one what the path ends with."""
    path = F.regexp_replace(F.regexp_replace(F.substring_index(node, "?", 1), r"^https?://(www\.)?", "http://"), r"(?i)((/index)?\.html?)?/*$", "")
    # Kept parameters as ?a&b; an empty list gives nothing.
    kept = F.filter(F.split(F.regexp_extract(node, r"(?s)\?(.*)$", 1), "&"), lambda x: ~x.rlike(TRACKING) & (x != ""))
    query = F.regexp_replace(F.array_join(kept, "&"), r"(?s)^(?=.)", "?")
    return F.concat(F.regexp_extract(path, r"(?s)^.*?://.*$", 0), query)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, without quotes; empty if it isn't there."""
    return F.trim(F.regexp_replace(F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1), "^[\"']|[\"']$", ""))


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, with its . and .. steps taken."""
    def step(done: Column, x: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(x == "..", up).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    parts = F.split(path, "/")
    ends = F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise("")
    return F.concat(F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"), ends)


def resolved(rows: DataFrame, target: str, url: str, out: str) -> DataFrame:
    """rows with a column `out`: target as seen from url, an absolute one; a mere fragment or nothing gives null, and so does any
    relative target where url has no host. Steps are columns of their own, so that each is computed once."""
    t, host, path = F.col("_target"), F.col("_host"), F.col("_path")
    rows = rows.withColumn("_target", F.replace(F.trim(F.col(target)), F.lit("&amp;"), F.lit("&"))).withColumn("_host", F.regexp_extract(F.col(url), r"(?s)^(.*?://[^/?#]*)", 1))
    here = path_of(F.col(url))
    whole = F.regexp_extract(t, r"(?s)^([^?#]*)", 1)
    path = F.when(F.startswith(t, F.lit("/")), whole).when(whole == "", here).otherwise(F.concat(F.regexp_replace(F.when(here == "", "/").otherwise(here), r"[^/]*$", ""), whole))
    rows = rows.withColumn("_path", path)
    dotted = F.col("_path").rlike(r"(^|/)\.{1,2}(/|$)")
    rows = rows.withColumn("_path", F.when(dotted & (whole != ""), _without_dots(F.col("_path"))).otherwise(F.col("_path")))
    found = (
        F.when((t == "") | F.startswith(t, F.lit("#")), None)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (host == ""), None)
        .when(F.startswith(t, F.lit("//")), F.concat(F.regexp_extract(F.col(url), r"^([^:/]+:)//", 1), t))
        .otherwise(F.concat(host, F.col("_path"), F.regexp_extract(t, r"(?s)^[^?#]*(.*)$", 1)))
    )
    return rows.withColumn(out, found).drop("_target", "_host", "_path")


def edges_of(pages: DataFrame) -> DataFrame:
    """pages (url, html) -> edges (u, v) of canonical links and refresh redirects. Comments are no markup; a base is followed."""
    bare = pages.where("url is not null and html is not null").select("url", F.regexp_replace("html", r"(?s)<!--.*?-->", "").alias("html"))
    tags = bare.select("url", F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta|base)\s[^>]*>"), 0).alias("tags"))
    first = F.get(F.filter("tags", lambda t: F.lower(F.substr(t, F.lit(1), F.lit(5))) == "<base"), F.lit(0))
    kind, tag = F.lower(F.substr("tag", F.lit(1), F.lit(5))), F.col("tag")
    tags = tags.select("url", attribute(first, "href").alias("base"), F.explode("tags").alias("tag")).where(tag.rlike("(?i)canonical|refresh"))
    words = F.split(F.lower(attribute(tag, "rel")), r"\s+")
    canonical = F.when((kind == "<link") & F.array_contains(words, "canonical"), attribute(tag, "href"))
    refresh = F.when((kind == "<meta") & (F.lower(attribute(tag, "http-equiv")) == "refresh"), F.regexp_extract(attribute(tag, "content"), r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    found = tags.select("url", "base", F.coalesce(canonical, refresh).alias("target")).where("target != ''")
    # Written after each step: the links are few beside the pages, and expressions would multiply inside each other.
    found = stored(resolved(stored(found, "links"), "base", "url", "base").withColumn("base", F.coalesce("base", "url")), "links")
    found = stored(resolved(found, "target", "base", "target"), "links")
    found = found.select(node_of(F.col("url")).alias("u"), node_of(F.col("target")).alias("v"))
    return found.where("u is not null and v is not null and u != v").distinct()


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of pages: page_id, host, path, rule, verdict, how ('rule', 'alias' or 'default').

    redirects: further edges (u, v) of URLs, as from a crawler's log. URLs of one canonical form are one class. Null URLs and those without :// have an empty host and
    path and are allowed by default; null html has no links. Rows that repeat an id or a URL come back one by one. An empty
    table gives no rows. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    edges = edges_of(rows.select("url", "html"))
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("u")), node_of(F.col("v"))))
    nodes = rows.where(F.contains("url", F.lit("://"))).select(node_of(F.col("url")).alias("u")).union(edges.select("v")).distinct()
    forms = nodes.select("u", canonical_of(F.col("u")).alias("v")).distinct()
    classes = connected_components(edges.union(forms), "redirects")
    named = classes.withColumn("own", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["action"])
    by_class = named.groupBy("component").agg(F.when(F.max(F.coalesce(F.col("own") == "allow", F.lit(False))), "allow").when(F.max(F.coalesce(F.col("own") == "block", F.lit(False))), "block").alias("carried"))
    carried = classes.join(by_class, "component").where("carried is not null").select("node", "carried")
    out = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    out = out.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)).join(carried, "node", "left")
    return out.select(
        "page_id", "host", "path", F.col("own")["rule"].alias("rule"), F.coalesce(F.col("own")["action"], "carried", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("carried").isNotNull(), "alias").otherwise("default").alias("how"),
    )
