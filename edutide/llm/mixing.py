"""Mixing sources to target weights by hash-threshold histograms (operator 11), in DataFrame functions alone.

Every source has a target of words. A document's whole copies follow from target and size of its source; what is left of the
target is met by one more copy of the documents that come first in the order of a hash. That order is never made: words are
summed by source and by the highest BITS bits of the hash, so that buckets before the one in which the target is reached are
taken whole and those behind it not at all. Only the documents of that one bucket are looked at again, by their next BITS
bits, and so on for LEVELS histograms; the few documents of the last bucket are summed one by one. A document stands before
the threshold if the middle of its words does, so that a source's words are off its target by at most half a document.

Thresholds are nested: as a target grows, the documents that are taken stay so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.operators.ordering import running

from .stage import small_side, stored

#: What a word is, and what stands between words.
WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
BITS, LEVELS, HASH_BITS = 12, 2, 60


def words(text: Column) -> Column:
    """The words of a text that isn't null, as an array."""
    return F.array_remove(F.split(text, SPACE, -1), "")


def told(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of a digest of id and text: rows that are alike have the same, whatever the order of the table."""
    whole = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(whole, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """sources (source, source_size) with weight and target: weights repeat over the sources by code point, null last; targets
    share the sum of all sizes by weight but stop at `most` times a source's size, and the excess goes to the others.

    The level at which targets rise with weight is found in one pass over the sources by size for weight: where those before
    are full, what is left for a unit of weight is no more than the next source can take.
    """
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    rows = running(sources, order, {}).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).drop("_place")
    rows = rows.withColumn("full", most * F.col("source_size"))
    ratio = F.col("full") / F.col("weight")
    rows = stored(running(rows, [ratio.asc(), *order], {"full_before": "full", "weight_before": "weight"}), "sources")
    whole = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")).first()
    left, share = F.lit(whole["size"]).cast("long") - F.col("full_before"), F.lit(whole["weight"]) - F.col("weight_before")
    level = rows.where(left / share <= ratio).agg(F.min_by(F.struct(left.alias("left"), share.alias("share")), "_place").alias("at")).first()["at"]
    left, share = (level["left"], level["share"]) if level else (0, 1.0)
    target = F.least(F.col("full").cast("double"), F.lit(float(left)) * F.col("weight") / F.lit(float(share)))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _bucket(level: int) -> Column:
    return F.shiftrightunsigned("hash", HASH_BITS - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def _on(rows: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """rows with what was decided for their source and bucket; a null source is one like others."""
    decided = decided.select(F.col("source").alias("_source"), *[F.col(k).alias(f"_{k}") for k in keys], "*").drop("source", *keys)
    same = rows["source"].eqNullSafe(decided["_source"])
    for k in keys:
        same = same & (rows[k] == decided[f"_{k}"])
    return rows.join(small_side(decided), same).drop("_source", *[f"_{k}" for k in keys])


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: doc_id, size (words), source_size, target (words of its source), taken (words, repeats counted), copies, source.

    Null texts have no words. A null source is one more source, the last. Rows that repeat an id with another text are documents
    of their own; of rows that are alike in id, text and source as many as fit are taken, no matter which. A source without
    words has target 0, and a document without words gets no copy beyond the whole ones. An empty table gives no rows. Other
    columns are not read.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col)
    rows = docs.select(doc_id.alias("doc_id"), F.size(words(F.coalesce(text, F.lit("")))).cast("long").alias("size"), F.col(source_col).cast("string").alias("source"), told(doc_id, text).alias("hash"))
    rows = stored(rows.withColumn("bucket", _bucket(0)), "sizes")
    histogram = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "histogram")
    goal = targets(histogram.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).drop("weight")
    kept = ["source_size", "target", "whole", "rest"]
    before = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, -1)
    decided = _on(histogram, goal.withColumn("base", F.lit(0).cast("long")), [])
    shown = ["doc_id", "size", "source", *kept, "extra"]
    out = []
    for level in range(LEVELS):
        low = F.col("base") + F.coalesce(F.sum("words").over(before.orderBy("bucket")), F.lit(0))
        decided = decided.withColumn("low", low).withColumn("high", F.col("low") + F.col("words"))
        side = F.when(F.col("low") >= F.col("rest"), 0).when(F.col("high") <= F.col("rest"), 1)  # null: the boundary bucket
        decided = stored(decided.select("source", "bucket", *kept, F.col("low").alias("base"), side.cast("long").alias("extra")), "decided")
        out.append(_on(rows, decided.where("extra is not null"), ["bucket"]).select(shown))
        inside = _on(rows, decided.where("extra is null").select("source", "bucket"), ["bucket"])
        rows = stored(inside.withColumn("bucket", _bucket(level + 1)), "boundary")
        bases = decided.where("extra is null").select("source", "base", *kept)
        if level + 1 < LEVELS:
            decided = _on(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), bases, [])
    alike = rows.groupBy("source", "hash", "size", "doc_id").agg(F.count("*").alias("n"))
    alike = _on(alike, bases, []).withColumn("low", F.col("base") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(before.orderBy("hash", "size", "doc_id")), F.lit(0)))
    taken = F.when(F.col("size") > 0, F.ceil((F.col("rest") - F.col("low")) / F.col("size") + 0.5) - 1)
    alike = alike.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("n"), F.coalesce(taken, F.lit(0)))))
    alike = alike.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("extra", (F.col("i") <= F.col("taken")).cast("long"))
    for part in [*out[1:], alike.select(shown)]:
        out[0] = out[0].unionByName(part)
    copies = F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)
    return out[0].select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "source")
