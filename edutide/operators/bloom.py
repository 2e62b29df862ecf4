"""Distinct counts by a Bloom filter that facts carry and merge (A4).

A state is a map of bitmaps, of 32,768 bits each, with as many bits in all as the period's kind is given. They are made and
merged by Spark's own aggregates, so that a state is merged by OR: in any order, and twice as well as once. A value's five places come
from two halves of its MD5, so that any engine finds the same ones. A value counts when a batch brings it and the stored state
does not hold it; as with any such filter, values whose places are all taken are missed, more of them as the filter fills.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bits of a filter by kind of period, and the number of hashes.
SIZES = {"DAY": 1_000, "WEEK": 10_000, "MONTH": 50_000, "CUMULATIVE": 100_000}
HASHES = 5
BITMAP = 32_768
WORDS = BITMAP // 64
#: Stored states of at most so many bits in all (64 MB) are sent to every task.
BROADCAST_BITS = 1 << 29


def size_of(kind: Column) -> Column:
    out = F.lit(None).cast("long")
    for name, bits in SIZES.items():
        out = F.when(kind == name, F.lit(bits).cast("long")).otherwise(out)
    return out


def hashed(values: DataFrame, value: str) -> DataFrame:
    """values with _a and _b, the halves of each value's MD5 from which its places come."""
    digest = F.md5(F.col(value).cast("string").cast("binary"))
    return values.withColumns({n: F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for n, at in (("_a", 1), ("_b", 16))})


def places(bits: Column) -> list[Column]:
    """The places of a hashed value, from 0 on."""
    return [(F.col("_a") + i * F.col("_b")) % bits for i in range(HASHES)]


def _word(place: Column) -> Column:
    """The number of the 64-bit word that has a place."""
    return F.shiftright(place, 6)


def _bit(place: Column) -> Column:
    """Its bit in this word, whose eight bytes are those of the bitmap in order, the first one highest."""
    return (56 - place.bitwiseAND(F.lit(56)) + place.bitwiseAND(F.lit(7))).cast("int")


def words(state: Column, bits: Column) -> Column:
    """A state as an array of its 64-bit words."""

    def word(i: Column) -> Column:
        bitmap, at = F.try_element_at(state, (F.shiftright(i, 9) + 1).cast("long")), (i % WORDS) * 8
        half = lambda n: F.coalesce(F.conv(F.hex(F.substring(bitmap, at + n, F.lit(4))), 16, 10).cast("long"), F.lit(0).cast("long"))
        return F.shiftleft(half(1), 32).bitwiseOR(half(5))

    return F.transform(F.sequence(F.lit(0), _word(bits - 1).cast("int")), word)


def holds(words: Column, at: list[Column]) -> Column:
    """Whether a state, as words, has all these places."""
    there = [F.getbit(F.get(words, _word(p).cast("int")), _bit(p)) == 1 for p in at]
    return F.coalesce(reduce(and_, there), F.lit(False))


def bitmaps(values: DataFrame, keys: list[str], bits: Column) -> DataFrame:
    """keys, bucket, bits and n of hashed distinct values: in bucket 0 their number, in others their bitmaps.

    Bits meet as numbers, by word, in a hash aggregate; only what is left of them, at most a row a word, is made into bitmaps."""
    each = values.select(*keys, F.explode(F.array(F.lit(-1).cast("long"), *places(bits))).alias("_p"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("_p")))
    each = each.groupBy(*keys, _word(F.col("_p")).alias("_w")).agg(F.bit_or(mask).alias("_m"), F.count("*").alias("n"))  # -1 is in word -1
    found = F.when(F.col("_w") >= 0, F.struct((F.col("_w") % WORDS).cast("int").alias("w"), F.lpad(F.hex("_m"), 16, "0").alias("h")))
    bucket = F.when(F.col("_w") < 0, F.lit(0).cast("long")).otherwise(F.shiftright("_w", 9) + 1)
    rows = each.groupBy(*keys, bucket.alias("bucket")).agg(F.array_sort(F.collect_list(found)).alias("_l"), F.coalesce(F.sum(F.when(F.col("_w") < 0, F.col("n"))), F.lit(0).cast("long")).alias("n"))
    gap = lambda x, i: 16 * (x["w"] - F.coalesce(F.get(F.col("_l"), i - 1)["w"], F.lit(-1)) - 1)
    text = F.array_join(F.transform("_l", lambda x, i: F.concat(F.repeat(F.lit("0"), gap(x, i)), x["h"])), "")
    return rows.select(*keys, "bucket", F.when(F.col("bucket") > 0, F.unhex(F.rpad(text, 16 * WORDS, "0"))).alias("bits"), "n")


def bits_set(state: Column) -> Column:
    return F.aggregate(F.map_values(state), F.lit(0).cast("long"), lambda n, b: n + F.bitmap_count(b))


def inserted(values: DataFrame, keys: list[str], value: str, bits: Column, old: DataFrame | None, name: str) -> DataFrame:
    """Per keys: name, the values counted so far, and name_bits, the state; of old facts (with these columns) and new values.

    Null values are none. bits: the size of a key's filter, of its columns. values may be hashed. old is read several times, and so
    should be a table."""
    state, hashes = f"{name}_bits", [c for c in ("_a", "_b") if c in values.columns]
    new = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), *hashes).distinct()
    new = new if hashes else hashed(new, "_value")
    if old is not None:
        held = old.select(*keys, words(F.col(state), bits).alias("_words"))
        size = old.agg(F.sum(bits)).first()[0] or 0
        held = F.broadcast(held) if size <= BROADCAST_BITS else held
        new = new.join(held, keys, "left").where(~holds(F.col("_words"), places(bits))).drop("_words")
    rows = bitmaps(new, keys, bits)
    if old is not None:
        rows = rows.unionByName(old.select(*keys, F.lit(0).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bits"), F.col(name).alias("n")))
        rows = rows.unionByName(old.select(*keys, F.explode(state).alias("bucket", "bits"), F.lit(0).cast("long").alias("n")))
    each = rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))
    maps = F.map_from_entries(F.collect_list(F.when(F.col("bucket") > 0, F.struct("bucket", "bits"))))  # four bitmaps at most
    return each.groupBy(*keys).agg(F.sum("n").alias(name), maps.alias(state))
