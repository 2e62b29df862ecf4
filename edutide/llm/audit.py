"""How filters interact: what each filter removes in every order of them (operator 12).

Five filters: four look at a document's text, the fifth (E) at whether a document with a smaller id has the same text. What it
needs is first asked of a counting Bloom filter: each task counts the positions of its texts' hashes, counters stop at two, and
the sketches are added up by shard. A text of which one position was met only once is unique, which is certain. Only texts
that may repeat are shuffled, to find the smallest id of each, text by text and exactly. All flags meet as (id, hash, part, mask)
in narrow rows. As a document's fate in any order follows from the set of filters that it fails, counts by part and set (32) are
all that the 120 orders are computed from.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import counted, freed
from .mixing import words
from .stage import small_side, stored

FILTERS = "ABCDE"
#: Positions of a shard, as bits of its hash; texts for which a shard is sized; positions of a text.
SHARD_BITS, SHARD_TEXTS, PROBES = 13, 1024, 4
#: Bits of all shards together, at most, so that they can be broadcast (64 MB); with more texts than fit, more of them only may repeat.
SKETCH_BITS = 1 << 29
#: Hashes that a task counts at once.
CHUNK = 1 << 20


def fails(text: Column, words: Column) -> Column:
    """The filters A to D that a text fails, as bits 1, 2, 4 and 8; words: its words."""
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 2 * F.length(text), F.rlike(text, F.lit("[#$%&*|]"))]
    return reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)])


def _positions(told: Column) -> list[Column]:
    return [F.shiftrightunsigned(told, i * SHARD_BITS).bitwiseAND(F.lit((1 << SHARD_BITS) - 1)) for i in range(PROBES)]


def _sketches(shards: int):
    """Batches of hashes to sparse sketches: for each shard the positions met, and how often, two standing for more."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def sketch() -> pa.RecordBatch:
            own, other = (np.concatenate([w[i] for w in waiting]) for i in range(2))
            waiting.clear()
            shard = other % shards  # of the sign of the divisor, as pmod
            at = [shard << SHARD_BITS | (own >> np.int64(i * SHARD_BITS)) & ((1 << SHARD_BITS) - 1) for i in range(PROBES)]
            # A text counts each of its positions once.
            first = [np.logical_and.reduce([at[i] != at[j] for j in range(i)]) if i else np.ones(len(own), bool) for i in range(PROBES)]
            place, n = counted(np.concatenate([a[f] for a, f in zip(at, first)]))
            whose, begin = np.unique(place >> SHARD_BITS, return_index=True)
            packed = ((place & ((1 << SHARD_BITS) - 1)) << 1 | (n > 1)).astype("<u2").tobytes()
            cuts = [*begin.tolist(), len(place)]
            return pa.RecordBatch.from_arrays([pa.array(whose, pa.int64()), pa.array([packed[2 * a : 2 * b] for a, b in zip(cuts, cuts[1:])], pa.binary())], ["shard", "sketch"])

        held = 0
        for b in batches:
            waiting.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
            held += b.num_rows
            if held >= CHUNK:
                yield sketch()
                held = 0
        if held:
            yield sketch()

    return run


def _merged(key: tuple, rows: pa.Table) -> pa.Table:
    """One shard: a bit for each position that was met twice, as 64-bit words. Counters that stop at two add up in any order."""
    seen = np.zeros(1 << SHARD_BITS, np.uint8)
    for sketch in rows.column("sketch").to_pylist():
        x = np.frombuffer(sketch, "<u2")
        seen[x >> 1] = np.minimum(seen[x >> 1] + 1 + (x & 1), 2)
    words = np.packbits(seen > 1, bitorder="little").view("<i8")
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "twice": pa.array([words.tolist()], pa.list_(pa.int64()))})


def counting_bloom(hashes: DataFrame, texts: int) -> DataFrame:
    """hashes (told, and check, which names the shard): shard and twice, the merged sketch of all of them, for `texts` texts. At most SKETCH_BITS bits."""
    shards = max(1, min(-(-texts // SHARD_TEXTS), SKETCH_BITS >> SHARD_BITS))
    sketches = hashes.select("told", "check").mapInArrow(_sketches(shards), "shard long, sketch binary")
    return stored(sketches.groupBy("shard").applyInArrow(_merged, "shard long, twice array<long>"), "sketch").withColumn("shards", F.lit(shards))


def possible_repeats(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """rows with `possible`: whether the text of this hash (told) may stand in more than one row; if not, it does not."""
    shards = sketch.select("shards").first()
    own = rows.withColumn("_shard", F.pmod(F.col("check"), F.lit(shards[0] if shards else 1)))
    bits = F.broadcast(sketch.select(F.col("shard").alias("_shard"), "twice"))  # at most SKETCH_BITS bits
    hit = [F.getbit(F.get("twice", F.shiftrightunsigned(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _positions(F.col("told"))]
    return own.join(bits, "_shard").withColumn("possible", reduce(lambda a, b: a & b, hit)).drop("_shard", "twice")


def duplicate_flags(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, told, check, ...): narrow rows (all columns but text) with `repeated`: a smaller id has the same text.

    A null id is smaller than none and none is smaller than it. Rows that repeat an id do not repeat each other."""
    narrow = stored(docs.drop("text"), "narrow")
    sketch = counting_bloom(narrow, narrow.count())
    maybe = possible_repeats(docs.select("doc_id", "text", "told", "check"), sketch).where("possible and doc_id is not null")
    first = maybe.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.first("told").alias("told"), F.first("check").alias("check"))
    first = first.select("doc_id", "told", "check").distinct().withColumn("first", F.lit(True))
    own = possible_repeats(narrow, sketch)
    keys = [c for c in own.columns]
    own = own.groupBy(*keys).agg(F.count("*").alias("n"))  # rows that are alike, a null id's among them, are one
    out = own.join(small_side(stored(first, "first")), ["doc_id", "told", "check"], "left")
    return out.withColumn("repeated", F.col("possible") & F.col("doc_id").isNotNull() & F.col("first").isNull()).drop("possible", "first")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, mask (bits of the filters that documents fail), n, good, toxic: all that any order of the filters needs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", words(F.col("text"))).withColumn("mask", fails(F.col("text"), F.col("words"))).drop("words")
    rows = rows.withColumn("told", F.xxhash64("text")).withColumn("check", F.xxhash64(F.lit(1), "text"))
    flags = duplicate_flags(rows).withColumn("mask", F.col("mask") + F.when(F.col("repeated"), 16).otherwise(0))
    flags = flags.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))])
    flags = flags.join(marks, "doc_id", "left")
    return flags.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def orders(counts: DataFrame) -> DataFrame:
    """Every order of the filters by part: filter_order, step, and what its filter keeps, removes, finds removed already, ..."""
    masks = F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic"))))
    parts = counts.groupBy("part").agg(masks.alias("by"))  # at most 32 masks to a part
    steps = []
    for order in permutations(range(len(FILTERS))):
        for i, f in enumerate(order):
            steps.append({"filter_order": "".join(FILTERS[x] for x in order), "step": i + 1, "own": 1 << f, "earlier": sum(1 << x for x in order[:i])})
    fixed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, earlier: int>>")

    def over(what: str, where) -> Column:
        entries = F.filter(F.map_entries("by"), lambda e: where(e["key"]))
        return F.aggregate(entries, F.lit(0).cast("long"), lambda a, e: a + e["value"][what])

    rows = parts.withColumn("_step", F.explode(fixed)).select("part", "_step.*", "by")
    own, earlier = F.col("own"), F.col("earlier")
    here = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(earlier) == 0)
    shares = F.aggregate(
        F.filter(F.map_entries("by"), lambda e: e["key"].bitwiseAND(own) != 0), F.lit(0).cast("long"),
        lambda a, e: a + e["value"]["n"] * (F.lit(factorial(len(FILTERS))) / F.bit_count(e["key"])).cast("long"),
    )
    return rows.select(
        "part", "filter_order", "step", over("n", lambda m: m.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"), over("n", here).alias("removed"),
        over("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(earlier) != 0)).alias("redundant"), over("n", lambda m: m == own).alias("unique_fails"),
        over("good", here).alias("good_lost"), over("toxic", here).alias("toxic_lost"), shares.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null texts are empty, and so alike; a null part is that of the empty string. An id with several labels is good or toxic if one
    of them says so. Every row counts, repeated ones too. Empty documents give no rows, empty labels zeros. Other columns are not read.
    """
    return orders(mask_counts(docs, labels, id_col, text_col, part_col))
