"""Aggregates that a user gives as functions (X2), in two phases.

Each task keeps one state for each key that it meets and sends it on; the states of a key, one from a task at most and not its rows,
are merged and finished where they meet. So no group's rows are ever brought together.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


@dataclass
class Custom:
    """init() gives an empty state; combine(state, rows) adds rows, a pandas frame, and returns the state; merge(state, state) joins
    two; finish(state) gives a tuple of the columns of schema. States are pickled."""

    init: Callable[[], Any]
    combine: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], tuple]
    schema: str


def _partial(keys: list[str], custom: Custom, held: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, Any] = {}

        def out() -> pd.DataFrame:
            found = pd.DataFrame(list(states), columns=keys)
            found["state"] = [pickle.dumps(s) for s in states.values()]
            states.clear()
            return found

        for b in batches:
            for key, rows in b.groupby(keys, dropna=False, sort=False):
                key = tuple(None if x is None or x != x else x for x in key)
                states[key] = custom.combine(states[key] if key in states else custom.init(), rows)
            if len(states) > held:
                yield out()
        if states:
            yield out()

    return run


def _final(keys: list[str], custom: Custom):
    names = [c.strip().split()[0] for c in custom.schema.split(",")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        state = None
        for s in rows["state"]:
            state = pickle.loads(s) if state is None else custom.merge(state, pickle.loads(s))
        return pd.DataFrame([(*key, *custom.finish(state))], columns=[*keys, *names])

    return run


def by(df: DataFrame, keys: list[str], custom: Custom, held: int = 100_000) -> DataFrame:
    """One row for each key. held: keys of which a task keeps states before it sends them on, about."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    states = df.mapInPandas(_partial(keys, custom, held), f"{kinds}, state binary")
    return states.groupBy(*keys).applyInPandas(_final(keys, custom), f"{kinds}, {custom.schema}")
