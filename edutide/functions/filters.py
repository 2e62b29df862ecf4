"""Predicates from filter descriptions: {'name': field, 'operator': 'EQ', 'value': ...} and report filters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _in(c: Column, values: list, is_list: bool) -> Column:
    if is_list:  # all of the filter's values are in the field's
        return F.size(F.array_except(F.array(*[F.lit(v) for v in values]), c)) == 0
    return c.isin(values)


def _range(c: Column, value: dict) -> Column:
    lo, hi = value.get("start"), value.get("end")
    if lo is None or hi is None:
        return F.lit(False)
    return (c > lo) & (c < hi) if value.get("date") else (c >= lo) & (c <= hi)


#: F1-F10. Each takes the column, the value and whether the column is a list. They are plain comparisons, which reach the scan;
#: null fields fail (a filter drops null) but for ISNULL, ISEMPTY and NIN.
OPERATORS: dict[str, Callable[[Column, Any, bool], Column]] = {
    "EQ": lambda c, v, is_list: c == v,
    "NE": lambda c, v, is_list: c != v,
    "IN": _in,
    "NIN": lambda c, v, is_list: ~F.coalesce(_in(c, v, is_list), F.lit(False)) if isinstance(v, list) else F.lit(False),
    "ISNULL": lambda c, v, is_list: c.isNull(),
    "ISNOTNULL": lambda c, v, is_list: c.isNotNull(),
    "ISEMPTY": lambda c, v, is_list: c.isNull() | (c.cast("string") == ""),
    "ISNOTEMPTY": lambda c, v, is_list: c.cast("string") != "",
    "RANGE": lambda c, v, is_list: _range(c, v),
    "LT": lambda c, v, is_list: c < v,
}

#: Fixed values, short names of telemetry fields.
ALIASES = {
    "eventId": "eid",
    "ts": "ts",
    "eventts": "ets",
    "gameId": "content",
    "gameVersion": "content_ver",
    "userId": "uid",
    "sessionId": "sid",
    "telemetryVersion": "ver",
    "itemId": "item",
    "tag": "tags",
}


def field(name: str) -> Column:
    """a short name's column, else the dotted path itself."""
    return F.col(ALIASES.get(name, name))


def predicate(df: DataFrame, f: dict) -> Column:
    if f["operator"] not in OPERATORS:
        raise ValueError(f"unknown filter operator: {f['operator']}")
    name = ALIASES.get(f["name"], f["name"])
    kind = df.select(F.col(name)).schema[0].dataType.typeName()
    return OPERATORS[f["operator"]](F.col(name), f.get("value"), kind == "array")


def where_all(df: DataFrame, filters: list[dict]) -> DataFrame:
    """rows that pass every filter, in one predicate that reaches the scan."""
    return df.where(reduce(and_, [predicate(df, f) for f in filters], F.lit(True)))


def where_value(df: DataFrame, value: Any, test: Callable[[Any], Column]) -> DataFrame:
    """rows that pass a test made from a value."""
    return df.where(test(value))


#: Report filters.
REPORT: dict[str, Callable[[Column, Any], Column]] = {
    "isnull": lambda c, v: c.isNull(),
    "isnotnull": lambda c, v: c.isNotNull(),
    "equals": lambda c, v: c == v,
    "notequals": lambda c, v: c != v,
    "contains": lambda c, v: F.contains(c, F.lit(v)),
    "containsignorecase": lambda c, v: F.contains(F.lower(c), F.lit(v.lower())),
    "in": lambda c, v: c.isin(v),
    "notin": lambda c, v: ~c.isin(v),
    "regex": lambda c, v: c.rlike(v),
    "like": lambda c, v: c.like(v),
    "greaterthan": lambda c, v: c > v,
    "lessthan": lambda c, v: c < v,
}

#: Filters on aggregates.
HAVING: dict[str, Callable[[Column, Any], Column]] = {
    "equalTo": lambda c, v: c == v,
    "not": lambda c, v: c != v,
    "greaterThan": lambda c, v: c > v,
    "lessThan": lambda c, v: c < v,
}


def report_where(df: DataFrame, filters: list[dict]) -> DataFrame:
    return df.where(reduce(and_, [REPORT[f["type"]](F.col(f["dimension"]), f.get("value")) for f in filters], F.lit(True)))


#: F16: fixed values, which request key of a data export stands for which field and operator.
EXPORT_KEYS = {"channel": ("channel", "EQ"), "app_id": ("app", "EQ"), "events": ("eid", "IN"), "tags": ("tags", "IN"), "users": ("uid", "IN"), "contents": ("content", "IN")}


def export_filters(request: dict) -> list[dict]:
    """F16: filters of an export request; keys that it leaves out don't filter."""
    out = [{"name": EXPORT_KEYS[k][0], "operator": EXPORT_KEYS[k][1], "value": v} for k, v in request.items() if k in EXPORT_KEYS and v is not None]
    if request.get("start_ms") is not None:
        out.append({"name": "ets", "operator": "RANGE", "value": {"start": request["start_ms"], "end": request["end_ms"]}})
    return out
