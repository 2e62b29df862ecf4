"""Small column functions: ids, coercions, guards, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to(c: Column, default: str) -> Column:
    """A null or blank string becomes the default."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def message_id(*parts: Column) -> Column:
    """Upper-case MD5 of the parts joined by |, a null as the word null."""
    return F.upper(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])))


def key_digest(*parts: Column) -> Column:
    """C11: SHA-256 of the parts joined by ##."""
    return F.sha2(F.concat_ws("##", *[p.cast("string") for p in parts]), 256)


_WORD = 0xFFFFFFFF


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _times(a: Column, b: int) -> Column:
    """The low 32 bits of a product, of two unsigned 32-bit integers in longs, with no step beyond 64 bits."""
    high = lambda a: (F.shiftrightunsigned(a, 16) * b).bitwiseAND(F.lit(0xFFFF))
    return _let(a, lambda a: (a.bitwiseAND(F.lit(0xFFFF)) * b + F.shiftleft(high(a), 16)).bitwiseAND(F.lit(_WORD)))


def _turned(a: Column, n: int) -> Column:
    return _let(a, lambda a: F.shiftleft(a, n).bitwiseAND(F.lit(_WORD)).bitwiseOR(F.shiftrightunsigned(a, 32 - n)))


def _folded(a: Column, n: int) -> Column:
    return _let(a, lambda a: a.bitwiseXOR(F.shiftrightunsigned(a, n)))


#: The seed of a string's hash and the constants of 32-bit Murmur3.
MURMUR_SEED, MURMUR_MIX, MURMUR_ADD, MURMUR_END = 0xF7CA7FD2, (0xCC9E2D51, 0x1B873593), 0xE6546B64, (0x85EBCA6B, 0xC2B2AE35)


def string_hash(text: Column) -> Column:
    """32-bit Murmur3 over a string's UTF-16 units, two at a time, as an unsigned number; null for null."""
    points = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    pair = lambda p: F.array(F.lit(0xD800) + F.shiftrightunsigned(p - 0x10000, 10), F.lit(0xDC00) + (p - 0x10000).bitwiseAND(F.lit(0x3FF)))
    units = F.flatten(F.transform(points, lambda p: F.when(p > 0xFFFF, pair(p)).otherwise(F.array(p))))
    mixed = lambda h, d: h.bitwiseXOR(_times(_turned(_times(d, MURMUR_MIX[0]), 15), MURMUR_MIX[1]))
    steps = F.transform(F.sequence(F.lit(0), F.lit(1) * F.floor(F.size(units) / 2).cast("int")), lambda i: F.struct(F.try_element_at(units, 2 * i + 1).alias("a"), F.try_element_at(units, 2 * i + 2).alias("b")))

    def step(h: Column, d: Column) -> Column:
        whole = (_times(_turned(mixed(h, F.shiftleft(d["a"], 16) + d["b"]), 13), 5) + MURMUR_ADD).bitwiseAND(F.lit(_WORD))
        return F.when(d["b"].isNotNull(), whole).when(d["a"].isNotNull(), mixed(h, d["a"])).otherwise(h)

    h = F.aggregate(steps, F.lit(MURMUR_SEED).cast("long"), step).bitwiseXOR(F.size(units).cast("long"))
    return _folded(_times(_folded(_times(_folded(h, 16), MURMUR_END[0]), 13), MURMUR_END[1]), 16)


def in_modulus(key: Column, divisor: int) -> Column:
    """Whether the key's hash is a multiple of the divisor (of its signed value, which is so when the signed remainder is 0)."""
    if divisor <= 0:
        return F.lit(False)
    signed = _let(string_hash(key.cast("string")), lambda h: h - F.when(h >= 1 << 31, F.lit(1 << 32)).otherwise(0))
    return F.coalesce(signed % divisor == 0, F.lit(False))


def as_double(c: Column) -> Column:
    """A number from a string or number, else 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """A2: num / den rounded, 0 where den is 0."""
    return F.when(den == 0, 0.0).otherwise(F.round(num / den, digits))


def exact_ratio(num: Column, den: Column) -> Column:
    """A2: num / den of integers, rounded half up to two digits as the fraction is, not as a double near it is; 0 where den is 0."""
    return F.when(den == 0, 0.0).otherwise(F.floor((200 * num + den) / (2 * den)) / 100)


def per_minute(n: Column, seconds: Column, short_raw: bool = False) -> Column:
    """A2: interactions per minute, 0 without any or without time; short_raw: below a minute, the bare count."""
    rate = F.round(n / (seconds / 60), 2)
    if short_raw:
        rate = F.when(seconds < 60, n.cast("double")).otherwise(rate)
    return F.when((n == 0) | (seconds == 0), 0.0).otherwise(rate)


def clamp_percent(c: Column) -> Column:
    """An integer percentage: 0 for null, at most 100."""
    return F.when(c.isNull(), 0).when(c > 100, 100).otherwise(c.cast("int")).cast("int")


def quoted_score(score: Column, of: Column) -> Column:
    """C15: 'a/b' in quotes."""
    return F.concat(F.lit("'"), score.cast("long").cast("string"), F.lit("/"), of.cast("long").cast("string"), F.lit("'"))


def known_tags(tags: Column, registered: list[str]) -> Column:
    """C14: a row's tags that are registered."""
    return F.array_intersect(tags, F.array(*[F.lit(t) for t in registered]))


def pair_of_doubles(c: Column) -> tuple[Column, Column]:
    """C19: '13.0,6.0' as two doubles; 0 for what isn't there."""
    parts = F.split(c, ",")
    return as_double(F.get(parts, F.lit(0))), as_double(F.get(parts, F.lit(1)))


def flat_responses(maps: Column) -> Column:
    """Key:value of all entries of an array of maps."""
    return F.flatten(F.transform(maps, lambda m: F.transform(F.map_entries(m), lambda e: F.concat_ws(":", e["key"], e["value"]))))


def integer_average(total: Column, n: Column) -> Column:
    """An average by whole division, 0 for none."""
    return F.when(n == 0, 0).otherwise(F.floor(total / n)).cast("long")


def period_label(period: Column) -> Column:
    """C20: a day period as yyyy-MM-dd, a month as yyyy-MM, a week as yyyy-ww, else 'all'."""
    p = period.cast("string")
    return (
        F.when(F.length(p) == 8, F.concat_ws("-", F.substring(p, 1, 4), F.substring(p, 5, 2), F.substring(p, 7, 2)))
        .when(F.length(p) == 7, F.concat_ws("-", F.substring(p, 1, 4), F.substring(p, 6, 2)))
        .when(F.length(p) == 6, F.concat_ws("-", F.substring(p, 1, 4), F.substring(p, 5, 2)))
        .otherwise("all")
    )
