"""Vector codes by product quantisation, with a GNAT over each codebook's entries (operator 13).

Vectors are cut into equal parts; a part's code is the index of the nearest of its codebook's entries. A codebook is small (entries
times components, whatever the number of vectors), so that it is built on the driver, sent to the tasks, and each round's sums come
back as one row for each entry and component. Its entries hang in a geometric near-neighbour access tree: a node has split points
and a child for each; it keeps, for each child and split point, the range of distances between them. Where a query is so far
from or so near to a split point that no member of a child can be as near as the best entry so far, the whole child is left out.

Squared distances are exact integers. Bounds are in doubles, with room for their rounding, and leave out what is strictly farther
only, so that ties are decided by integers and the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import freed
from .mtree import integer_vectors
from .stage import small_side, stored

#: Split points of a node; entries up to which a node is a leaf.
SPLITS, LEAF = 8, 6
#: Room for rounding in a bound, for each unit of the distances in it: far above the error of a square root and a difference of doubles.
ROOM = 1e-12


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of x and those of y: in 64 bits where they fit, else as Python's integers."""
    most = max((int(abs(int(a.min()))) + int(abs(int(a.max()))) for a in (x, y) if a.size), default=0)
    if x.dtype != object and 4 * most * most * max(1, x.shape[1]) < 1 << 62:
        out = np.zeros((len(x), len(y)), np.int64)
        for i in range(x.shape[1]):
            d = x[:, i, None] - y[None, :, i]
            out += d * d
        return out
    d = x.astype(object)[:, None, :] - y.astype(object)[None, :, :]
    return (d * d).sum(2) if x.shape[1] else np.zeros((len(x), len(y)), np.int64)


def _root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


@dataclass
class Node:
    """splits: indexes of entries; children: for each split point its other entries, as a node or None; low, high: by child and
    split point, the least and greatest distance."""

    splits: np.ndarray
    points: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def build(entries: np.ndarray, own: np.ndarray | None = None) -> Node | None:
    """The tree over these entries (rows), or over those of `own`."""
    own = np.arange(len(entries)) if own is None else own
    if not len(own):
        return None
    if len(own) <= LEAF:
        return Node(own, entries[own])
    away = _root(squared(entries[own], entries[own]))
    picked = [0]  # split points far from each other
    while len(picked) < min(SPLITS, len(own)):
        picked.append(int(away[:, picked].min(1).argmax()))
        if picked[-1] in picked[:-1]:  # no entry differs from all of them
            return Node(own, entries[own])
    near = away[:, picked].argmin(1)
    near[picked] = -1
    node = Node(own[picked], entries[own[picked]], [], np.full((len(picked), len(picked)), np.inf), np.full((len(picked), len(picked)), -np.inf))
    for j in range(len(picked)):
        members = np.flatnonzero(near == j)
        node.children.append(build(entries, own[members]))
        if len(members):
            node.low[j], node.high[j] = away[np.ix_(members, picked)].min(0), away[np.ix_(members, picked)].max(0)
    return node


def nearest(tree: Node, queries: np.ndarray, counter: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of queries the nearest entry's index (of several the lowest) and the squared distance. counter: distances computed."""
    best = np.full(len(queries), -1, np.int64)
    dist = np.zeros(len(queries), object if queries.dtype == object else np.int64)
    waiting: list[tuple[Node, np.ndarray]] = [(tree, np.arange(len(queries)))]
    while waiting:
        node, rows = waiting.pop()
        exact = squared(queries[rows], node.points)
        if exact.dtype == object and dist.dtype != object:
            dist = dist.astype(object)
        if counter is not None:
            counter[0] += exact.size
        order = np.argsort(node.splits)  # of equal distances the lowest index comes first
        first = order[exact[:, order].argmin(1)]
        d, i = exact[np.arange(len(rows)), first], node.splits[first]
        better = (best[rows] < 0) | (d < dist[rows]) | ((d == dist[rows]) & (i < best[rows]))
        best[rows[better]], dist[rows[better]] = i[better], d[better]
        if node.low is None:
            continue
        to, reach = _root(exact), _root(dist[rows])[:, None]
        room = ROOM * (1.0 + to + reach)
        for j, child in enumerate(node.children):
            if child is not None:
                maybe = ((to - reach - room <= node.high[j] * (1 + ROOM)) & (to + reach + room >= node.low[j] * (1 - ROOM))).all(1)
                if maybe.any():
                    waiting.append((child, rows[maybe]))
    return best, dist


class Codebooks:
    """entries: by part, a matrix of integers; the trees over them are made once in each worker."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries
        self._trees: list[Node | None] | None = None

    def __getstate__(self) -> list[np.ndarray]:
        return self.entries

    def __setstate__(self, entries: list[np.ndarray]) -> None:
        self.__init__(entries)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x: vectors as rows; the codes and squared distances by vector and part."""
        if self._trees is None:
            self._trees = [build(e) for e in self.entries]
        width = x.shape[1] // len(self.entries)
        found = [nearest(t, x[:, p * width : (p + 1) * width]) for p, t in enumerate(self._trees)]
        return np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for v in e.ravel()).encode()).hexdigest()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _sums(books: Codebooks):
    """Rows to one row for each entry met and component: how many parts it has, and their sum in halves of 32 bits."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = high = low = None
        for b in _slices(batches):
            x = _matrix(b.column("v"))
            if count is None:
                parts, width, k = len(books.entries), x.shape[1] // len(books.entries), len(books.entries[0])
                count, high, low = np.zeros(parts * k, np.int64), np.zeros((parts * k, width), np.int64), np.zeros((parts * k, width), np.int64)
            slot = books.assign(x)[0] + np.arange(parts) * k
            count += np.bincount(slot.ravel(), minlength=parts * k)
            cut = x.reshape(len(x), parts, width)
            np.add.at(high, slot, cut >> 32)
            np.add.at(low, slot, cut & 0xFFFFFFFF)
        if count is not None:
            used = np.flatnonzero(count)
            width = high.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, width), pa.int64()), pa.array(np.tile(np.arange(width), len(used)), pa.int64()), pa.array(np.repeat(count[used], width)), pa.array(high[used].ravel()), pa.array(low[used].ravel())],
                ["slot", "place", "n", "high", "low"],
            )

    return run


def _encoded(books: Codebooks):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            codes, dist = books.assign(_matrix(b.column("v")))
            texts = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            total = dist.astype(object).sum(1).tolist() if dist.dtype == object else dist.sum(1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(texts, pa.string()), pa.array(total, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks | None:
    """rows (id, v): codebooks that start as the parts of the vectors with the smallest ids, after so many rounds; None without rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()  # `entries` rows at most
    if not first:
        return None
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), -1)
    width = start.shape[1] // parts
    books = Codebooks([start[:, p * width : (p + 1) * width] for p in range(parts)])
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(_sums(books), "slot long, place long, n long, high long, low long")
        exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
        found = sums.groupBy("slot", "place").agg(F.sum("n").alias("n"), exact("high").alias("high"), exact("low").alias("low"))
        new = [e.copy() for e in books.entries]
        for slot, place, n, high, low in found.collect():  # parts * entries * width rows at most
            new[slot // len(first)][slot % len(first), place] = ((int(high) << 32) + int(low)) // n
        books = Codebooks(new)
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """Per vector: vec_id, code (two hex digits a part), error, label_error (the sum over its label, nulls together), codebooks_sha256, label.

    Components become floor(scale * x). Rows whose vector is null or holds a null or non-finite component are left out. Codebooks start
    from the smallest ids, a null id after all others, equal ids by their vectors; of fewer rows there are fewer entries. Rows that
    repeat an id are vectors of their own. An empty table gives no rows. Vectors of several lengths, or of a length that `parts`
    does not divide, are an error, as are a component and an error beyond 64 bits. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name up to 256 entries")
    rows = stored(integer_vectors(vectors, id_col, vector_col, scale, {"label": F.col(label_col)}), "vectors")
    sizes = [r[0] for r in rows.select("size").distinct().limit(2).collect()]
    if len(sizes) > 1 or (sizes and sizes[0] % parts):
        raise ValueError(f"vectors must have one length that {parts} divides, not {sizes}")
    kind = rows.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, code string, error long"
    books = fit(rows, parts, entries, rounds)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string, label " + kind)
    codes = stored(rows.select("id", "label", "v").mapInArrow(_encoded(books), schema), "codes")
    sums = small_side(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    out = codes.join(sums, codes["label"].eqNullSafe(sums["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"), "label")
