"""Rows of JSON documents whose keys differ, as VARIANT: the header is what any row has, and each column is a path into the document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Header = list[tuple[tuple[str, ...], T.DataType]]


def parsed(text: Column) -> Column:
    """A document; null where the text is none."""
    return F.try_parse_json(text)


def _leaves(kind: T.DataType, at: tuple[str, ...] = ()) -> Header:
    if isinstance(kind, T.StructType) and kind.fields:
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, (*at, f.name))]
    return [(at, kind)] if at else []


def _header(ddl: str | None) -> Header:
    """From what schema_of_variant_agg gives. A column that is of several kinds, or always null, is a VARIANT."""
    if ddl is None or not ddl.startswith("OBJECT<"):
        return []
    return _leaves(T._parse_datatype_string(ddl.replace("OBJECT<", "STRUCT<").replace("VOID", "VARIANT")))


def header(docs: DataFrame, column: str) -> Header:
    """The paths to values in any document, in order of their names, and their kinds: one aggregate over all rows."""
    return _header(docs.agg(F.schema_of_variant_agg(column)).first()[0])


def headers(docs: DataFrame, column: str, by: str) -> dict[str, Header]:
    """The header of each value of `by`, of which there are few."""
    rows = docs.where(F.col(by).isNotNull()).groupBy(by).agg(F.schema_of_variant_agg(column).alias("h")).collect()
    return {r[by]: _header(r["h"]) for r in sorted(rows, key=lambda r: r[by])}


def _path(at: tuple[str, ...]) -> str:
    quoted = [x.replace("\\", "\\\\").replace("'", "\\'") for x in at]
    return "$" + "".join(f"['{x}']" for x in quoted)


def columns(column: str, found: Header, hidden: tuple[str, ...] = (), renamed: dict[str, str] | None = None, mapped: dict[str, Callable[[Column], Column]] | None = None) -> list[Column]:
    """A column for each path of the header, named by its keys with dots between; arrays and values of several kinds as JSON.
    hidden: paths left out; renamed: path -> name; mapped: path -> function of the column (X3)."""
    out = []
    for at, kind in found:
        name = ".".join(at)
        if name in hidden:
            continue
        plain = not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        value = F.try_variant_get(F.col(column), _path(at), kind.simpleString()) if plain else F.to_json(F.try_variant_get(F.col(column), _path(at), "variant"))
        out.append((mapped or {}).get(name, lambda c: c)(value).alias((renamed or {}).get(name, name)))
    return out


def flatten(docs: DataFrame, column: str, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """The columns `keep` and those of the documents."""
    return docs.select(*keep, *columns(column, header(docs, column), **options))
