"""Time: epoch milliseconds, parsing with fallbacks, periods and lists of periods. As-of dates are always parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The periods of fact tables, the offset of day and month periods, and the tried time formats.
PERIODS = ("DAY", "WEEK", "MONTH", "CUMULATIVE")
DAY_OFFSET_MS = 19_800_000
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss")


def millis(ts: str | Column) -> Column:
    """Epoch milliseconds of a time without zone, read as UTC."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz")) / 1000).cast("long")


def parse_millis(text: Column) -> Column:
    """Epoch ms of a time string, by the first format that fits; 0 where none does or it is null."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in FORMATS] + [F.try_to_timestamp(F.substring(text, 1, 19), F.lit(FORMATS[-1]))]
    return F.coalesce(F.unix_millis(F.coalesce(*tries)), F.lit(0).cast("long"))


def seconds_between(start_ms: Column, end_ms: Column) -> Column:
    """C2."""
    return (end_ms - start_ms) / 1000


def round2_ms(ms: Column) -> Column:
    """Seconds of integer milliseconds, rounded half up to two digits without an error of doubles."""
    return F.floor((ms + 5) / 10) / 100


def _ntz(ms: Column) -> Column:
    return F.timestamp_add("SECOND", F.floor(ms / 1000), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def period(ms: Column, kind: str) -> Column:
    """C4: DAY yyyyMMdd and MONTH yyyyMM at +05:30, WEEK ISO yyyy7ww in UTC, CUMULATIVE 0; null for null."""
    shifted, plain = _ntz(ms + DAY_OFFSET_MS), _ntz(ms)
    out = {
        "DAY": F.date_format(shifted, "yyyyMMdd").cast("int"),
        "WEEK": F.extract(F.lit("YEAROFWEEK"), plain).cast("int") * 1000 + 700 + F.weekofyear(plain),
        "MONTH": F.date_format(shifted, "yyyyMM").cast("int"),
        "CUMULATIVE": F.when(ms.isNotNull(), 0),
    }
    return out[kind].cast("int")


def last_days(as_of: str, n: int) -> Column:
    """The n day periods that end with the day before as_of."""
    days = F.sequence(F.date_sub(F.lit(as_of).cast("date"), n), F.date_sub(F.lit(as_of).cast("date"), 1))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd").cast("int"))


def last_months(as_of: str, n: int) -> Column:
    """The n month periods that end with as_of's."""
    first = F.trunc(F.lit(as_of).cast("date"), "MM")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.date_format(F.add_months(first, i - (n - 1)), "yyyyMM").cast("int"))


def last_weeks(as_of: str, n: int) -> Column:
    """The n week periods that end with as_of's."""
    day = F.lit(as_of).cast("date")
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: (F.extract(F.lit("YEAROFWEEK"), F.date_add(day, (i - (n - 1)) * 7)) * 1000 + 700 + F.weekofyear(F.date_add(day, (i - (n - 1)) * 7))).cast("int"),
    )


def day_period_end_ms(day: Column) -> Column:
    """The last millisecond of a day period (yyyyMMdd), at +05:30."""
    start = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.to_date(day.cast("string"), "yyyyMMdd").cast("timestamp_ntz"))
    return start * 1000 + 86_400_000 - 1 - DAY_OFFSET_MS


def interval(name: str, as_of: str) -> tuple[Column, Column]:
    """First and last day (inclusive) of a named interval before as_of, or of a literal 'a/b'."""
    day = F.lit(as_of).cast("date")
    if "/" in name:
        a, b = name.split("/")
        return F.lit(a).cast("date"), F.lit(b).cast("date")
    week, month = F.date_trunc("WEEK", day).cast("date"), F.trunc(day, "MM")
    return {
        "LastDay": (F.date_sub(day, 1), F.date_sub(day, 1)),
        "LastWeek": (F.date_sub(week, 7), F.date_sub(week, 1)),
        "LastMonth": (F.add_months(month, -1), F.date_sub(month, 1)),
        "Last7Days": (F.date_sub(day, 7), F.date_sub(day, 1)),
        "Last30Days": (F.date_sub(day, 30), F.date_sub(day, 1)),
    }[name]


def age(born: Column, as_of: Column) -> Column:
    """Whole years."""
    return F.floor(F.months_between(as_of, born) / 12).cast("int")
