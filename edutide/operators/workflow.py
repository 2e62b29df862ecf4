"""The workflow tree (Z8): nested START/END nodes of a device, their time counted in every node above.

Whether a node is open depends on all rows of its device before, so a stack machine goes through a key's rows in order. Spark brings the
keys together and sorts them, with their rows in order of time, spilling as it needs; a task streams through its keys in Arrow
batches and holds the open nodes of one key alone. Nodes leave as they close, and those that are alike in all are made one after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

NODES = "did string, channel string, app string, type string, mode string, start_ms long, end_ms long, time_ms long, events long, interactions long"
#: Rows of these kinds have no place in the tree.
SKIPPED = ("LOG", "AUDIT", "SEARCH")


@dataclass
class Node:
    type: str
    mode: str
    start: int
    parent: Node | None = None
    last: int = 0
    ms: int = 0
    events: int = 0
    interactions: int = 0
    open: bool = True
    below: list = field(default_factory=list)

    def key(self) -> tuple[str, str]:
        return self.type.lower(), self.mode.lower()


class Tree:
    """What is open for one key; closed nodes with time go to `out`."""

    def __init__(self, idle_ms: int, break_ms: int):
        self.idle, self.pause = idle_ms, break_ms
        self.root: Node | None = None
        self.at: Node | None = None
        self.last: int | None = None
        self.out: list[tuple] = []

    def _emit(self, n: Node) -> None:
        if n.ms > 0:
            self.out.append((n.type, n.mode, n.start, n.last, n.ms, n.events, n.interactions))

    def _close(self, n: Node) -> None:
        for child in list(n.below):
            self._close(child)
        if n.open:
            n.open = False
            self._emit(n)
            if n.parent is not None:
                n.parent.below.remove(n)

    def _push(self, type_: str, mode: str, ets: int, parent: Node | None) -> Node:
        n = Node(type_, mode, ets, parent, ets)
        if parent is not None:
            parent.below.append(n)
        self.at = n
        return n

    def _add(self, eid: str, ets: int, gap: int) -> None:
        n = self.at
        while n is not None:
            n.ms, n.last, n.events = n.ms + gap, ets, n.events + 1
            n.interactions += eid == "INTERACT"
            n = n.parent

    def _pause(self, ets: int) -> None:
        """Emit what all open nodes have so far, and go on with the same nodes from here."""
        seen, todo = [], [self.root] if self.root else []
        while todo:
            n = todo.pop()
            seen.append(n)
            todo += n.below
        for n in reversed(seen):
            if n.open:
                self._emit(n)
                n.start, n.last, n.ms, n.events, n.interactions = ets, ets, 0, 0, 0

    def row(self, eid: str, ets: int, type_: str, mode: str) -> None:
        gap = 0 if self.last is None else ets - self.last
        if gap > self.pause and type_ != "app":
            self._pause(ets)
        gap = 0 if gap > self.idle else gap
        self.last = ets
        alive = self.root is not None and self.root.open
        if eid == "START":
            if not alive:
                if type_ != "app":
                    self.root = self._push("app", "", ets, None)
                    self._push(type_, mode, ets, self.root)
                else:
                    if self.at is not None and self.at.open:
                        self._close(self.at)
                    self.root = self._push(type_, mode, ets, None)
            elif self.at is None or not self.at.open:
                self._push(type_, mode, ets, self.root)
            else:
                same = self.at
                while same is not None and same.key() != (type_.lower(), mode.lower()):
                    same = same.parent
                if same is None:
                    self._push(type_, mode, ets, self.at)
                else:
                    self._close(same)
                    if same is self.root:
                        self.root = self._push(type_, mode, ets, None)
                    else:
                        self._push(type_, mode, ets, same.parent)
            self._add(eid, ets, gap)
        elif eid == "END":
            same = self.at if self.at is not None and self.at.open else None
            while same is not None and same.key() != (type_.lower(), mode.lower()):
                same = same.parent
            if same is not None:
                self._add(eid, ets, gap)
                self._close(same)
                self.at = same.parent
        else:
            if self.at is None or not self.at.open:
                self.root = self._push("app", "", ets, None)
            self._add(eid, ets, gap)

    def taken(self) -> list[tuple]:
        """The nodes closed since it was last asked."""
        out, self.out = self.out, []
        return out

    def end(self) -> list[tuple]:
        if self.at is not None and self.at.open:
            self._close(self.at)
        if self.root is not None and self.root.open:
            self._close(self.root)
        return self.taken()


KEYS = ["did", "channel", "app"]
_STRINGS = [*KEYS, "type", "mode"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if n in _STRINGS else pa.int64()) for i, n in enumerate(names)], names)


def _streamed(idle_ms: int, break_ms: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        tree, ready = None, []
        for b in batches:
            columns = [b.column(c).to_pylist() for c in [*KEYS, "eid", "ets", "type", "mode"]]
            for *key, eid, ets, type_, mode in zip(*columns):
                if tuple(key) != now or tree is None:
                    if tree is not None:
                        ready += [(*now, *x) for x in tree.end()]
                    now, tree = tuple(key), Tree(idle_ms, break_ms)
                tree.row(eid, ets, type_, mode)
                if len(tree.out) >= held:
                    ready += [(*now, *x) for x in tree.taken()]
                if len(ready) >= held:
                    yield _batch(ready)
                    ready = []
        if tree is not None:
            ready += [(*now, *x) for x in tree.end()]
        if ready:
            yield _batch(ready)

    return run


def workflow(df: DataFrame, type_col: str = "content", mode_col: str = "page", idle_s: int = 600, break_min: int = 30, held: int = 1024) -> DataFrame:
    """Per closed node with time: keys, type, mode, start and end, time_ms, events, interactions; exact duplicates once. Null types and
    modes are empty. held: closed nodes that a task keeps before it hands them on."""
    rows = df.where(~df["eid"].isin(*SKIPPED)).selectExpr(*KEYS, "mid", "ets", "eid", f"coalesce({type_col}, '') AS type", f"coalesce({mode_col}, '') AS mode")
    ordered = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "ets", "mid")
    return ordered.mapInArrow(_streamed(idle_s * 1000, break_min * 60_000, held), NODES).distinct()
