"""Exact inner-product top-k by best-first search of M-trees (operator 8).

The vectors are dealt by hash into shards of about SHARD rows. Each shard's M-tree is built once and stored: leaf pages around a
routing object, inner pages around routing objects of their own, all of them vectors of the shard, with covering radii and
every entry's distance to its parent's object. Queries are packed into blocks of about QUERIES; every block goes to every
shard, and the shards' best are merged by query. Distances are Euclidean; for a page with object p and radius r, no member x
has <q, x> above <q, p> + |q| r, and an entry at distance d from its parent's object p' has <q, x> of at most
<q, p'> + |q| (d + r), which is tried first, before anything is computed for the entry. A block's queries go down to their
best leaf first and then from leaf to leaf, the best first, those of them together that a leaf may still hold something for.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import release
from .stage import parallelism, stored

SHARD, PAGE, FANOUT, QUERIES = 8192, 128, 32, 512
#: Blocks of queries that a shard is asked at once, at most.
SPAN = 16


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


@dataclass
class Tree:
    """Rows in the order of the leaves: ids, exact (integers), away (distance to the leaf's object). Nodes, the root first: leaf,
    lo and hi (rows of a leaf, else child nodes), pivot (the object's row), radius, parent (distance to the parent's object)."""

    ids: np.ndarray
    exact: np.ndarray
    away: np.ndarray
    leaf: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    parent: np.ndarray

    def __post_init__(self) -> None:
        """x: the vectors as doubles; longest: the greatest norm; plain: inner products of doubles are exact integers, so that they
        may stand for those of integers, while the query's components are no larger than `top`."""
        self.x = self.exact.astype(np.float64)
        self.longest = float(_norms(self.x).max(initial=0.0))
        self.top = int(np.abs(self.x).max(initial=0.0))

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products of queries with rows, a line a query."""
        most = self.top * int(np.abs(q.astype(np.float64)).max(initial=0.0)) * max(1, q.shape[1])
        if most < 1 << 53:
            return (q.astype(np.float64) @ self.x[rows].T).astype(np.int64)
        if most < 1 << 63:
            return q @ self.exact[rows].T
        found = q.astype(object) @ self.exact[rows].astype(object).T
        return found.astype(np.int64)  # raises OverflowError where a score is beyond 64 bits

    def packed(self) -> bytes:
        return pickle.dumps([_narrow(getattr(self, f.name)) for f in fields(self)])

    @staticmethod
    def unpacked(data: bytes) -> Tree:
        ids, exact, *rest = pickle.loads(data)
        return Tree(ids.astype(np.int64), exact.astype(np.int64), *rest)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Integers in the least bytes that hold them, for the way."""
    if x.dtype != np.int64 or not x.size:
        return x
    low, high = int(x.min()), int(x.max())
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def build(exact: np.ndarray, ids: np.ndarray) -> Tree:
    """The tree of integer vectors. A page whose members can't be told apart stays one leaf."""
    x = exact.astype(np.float64)
    order: list[np.ndarray] = []
    away: list[np.ndarray] = []
    nodes: list[list[float]] = []

    def node(rows: np.ndarray, parent: int | None) -> tuple[np.ndarray, int]:
        pivot = int(rows[_norms(x[rows] - x[rows].mean(0)).argmin()])
        d = _norms(x[rows] - x[pivot])
        nodes.append([0, 0, 0, pivot, d.max(), 0.0 if parent is None else float(_norms((x[pivot] - x[parent])[None])[0])])
        return rows, pivot

    waiting = [node(np.arange(len(x)), None)]
    at = placed = 0
    while at < len(waiting):
        rows, pivot = waiting[at]
        groups = _split(x, rows) if len(rows) > PAGE else []
        if len(groups) < 2:
            order.append(rows)
            away.append(_norms(x[rows] - x[pivot]))
            nodes[at][:3] = 1, placed, placed + len(rows)
            placed += len(rows)
        else:
            nodes[at][:3] = 0, len(waiting), len(waiting) + len(groups)
            waiting += [node(g, pivot) for g in groups]
        at += 1
    by = np.concatenate(order)
    table = np.array(nodes)
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    leaf, lo, hi, pivots = (table[:, i].astype(np.int64) for i in range(4))
    return Tree(ids[by], exact[by], np.concatenate(away), leaf == 1, lo, hi, place[pivots], table[:, 4], table[:, 5])


def _split(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows by the nearest of up to FANOUT of them that differ."""
    pick = rows[np.linspace(0, len(rows) - 1, min(FANOUT, -(-len(rows) // PAGE) + 1)).astype(int)]
    centres = np.unique(x[pick], axis=0)
    if len(centres) == 1:
        centres = np.unique(np.vstack([centres, x[rows[np.argmax(_norms(x[rows] - centres[0]))]][None]]), axis=0)
    near = ((centres**2).sum(1) - 2 * x[rows] @ centres.T).argmin(1)
    return [rows[near == i] for i in range(len(centres)) if (near == i).any()]


class _Best:
    """The k best of each query so far, as they stand in score and id; floor: the least score that may still come in."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.score, self.id = k, np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.found, self.floor = np.zeros(n, np.int64), np.full(n, -np.inf)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, other: np.ndarray) -> None:
        """Scores of some queries with some ids, where `other` says that an id is not the query's own: highest score, then smallest id."""
        k = self.k
        least = np.where(self.found[rows] == k, self.score[rows, -1], np.iinfo(np.int64).min)
        i, j = np.nonzero(other & (scores >= least[:, None]))
        if not len(i):
            return
        hit, i = np.unique(i, return_inverse=True)
        row = rows[hit]
        a, b = np.nonzero(np.arange(k) < self.found[row, None])
        at = np.concatenate([a, i])
        score, number = np.concatenate([self.score[row[a], b], scores[hit[i], j]]), np.concatenate([self.id[row[a], b], ids[j]])
        order = np.lexsort((number, ~score, at))  # ~: the greatest first, with no overflow
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        order, at, place = order[place < k], at[place < k], place[place < k]
        self.score[row[at], place], self.id[row[at], place] = score[order], number[order]
        self.found[row] = np.bincount(at, minlength=len(row))
        full = row[self.found[row] == k]
        self.floor[full] = self.score[full, -1]


def search_all(tree: Tree, q: np.ndarray, own: np.ndarray | None, k: int, counter: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best for each of a block of queries, rows of its own id left out: highest score, then smallest id. Rows of (place in the
    block, score, id), the best first. counter: scores computed."""
    qf = q.astype(np.float64)
    length = _norms(qf)
    room = 1.0 + 1e-11 * length * tree.longest  # for rounding in bounds, which are computed in doubles
    best, everyone = _Best(len(q), k), np.arange(len(q))
    nothing = np.zeros(0, np.int64)
    if not len(tree.ids) or not len(q) or k < 1:
        return nothing, nothing, nothing

    def read(n: int, rows: np.ndarray, at: np.ndarray) -> None:
        lo, hi = int(tree.lo[n]), int(tree.hi[n])
        other = np.ones((len(rows), hi - lo), bool) if own is None else own[rows, None] != tree.ids[lo:hi]
        maybe = other & ((at + room[rows])[:, None] + length[rows, None] * tree.away[lo:hi] >= best.floor[rows, None])
        some, of = maybe.any(1), np.flatnonzero(maybe.any(0))
        if len(of):
            rows = rows[some]
            scores = tree.scores(lo + of, q[rows])
            if counter is not None:
                counter[0] += scores.size
            best.offer(rows, scores, tree.ids[lo + of], other[some][:, of])

    def below(n: int, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children that may hold something for one of the queries, the queries' products with their objects, and bounds."""
        lo, hi = int(tree.lo[n]), int(tree.hi[n])
        cheap = (at + room[rows])[:, None] + length[rows, None] * (tree.parent[lo:hi] + tree.radius[lo:hi]) >= best.floor[rows, None]
        nodes = lo + np.flatnonzero(cheap.any(0))
        inner = qf[rows] @ tree.x[tree.pivot[nodes]].T
        return nodes, inner, inner + length[rows, None] * tree.radius[nodes] + room[rows, None]

    root = qf @ tree.x[tree.pivot[0]]
    first = np.zeros(len(q), np.int64)  # the leaf that a query has been in
    waiting = [(0, everyone, root)]
    while waiting:
        n, rows, at = waiting.pop()
        if tree.leaf[n]:
            first[rows] = n
            read(n, rows, at)
            continue
        nodes, inner, upper = below(n, rows, at)
        to = upper.argmax(1)
        waiting += [(int(nodes[c]), rows[to == c], inner[to == c, c]) for c in np.unique(to)]
    waiting, leaves = [(0, everyone, root)], []
    while waiting:
        n, rows, at = waiting.pop()
        if tree.leaf[n]:
            continue  # the root is the only leaf that comes here
        nodes, inner, upper = below(n, rows, at)
        maybe = (upper >= best.floor[rows, None]) & (first[rows, None] != nodes)
        for c in np.flatnonzero(maybe.any(0)):
            m = maybe[:, c]
            if tree.leaf[nodes[c]]:
                leaves.append((upper[m, c].max(), int(nodes[c]), rows[m], inner[m, c], upper[m, c]))
            else:
                waiting.append((int(nodes[c]), rows[m], inner[m, c]))
    for _, n, rows, at, upper in sorted(leaves, key=lambda leaf: -leaf[0]):
        m = upper >= best.floor[rows]
        if m.any():
            read(n, rows[m], at[m])
    row, place = np.nonzero(np.arange(k) < best.found[:, None])
    return row, best.score[row, place], best.id[row, place]


def search(tree: Tree, q: np.ndarray, own: int | None, k: int, counter: list[int] | None = None) -> list[tuple[int, int]]:
    """The k best (score, id) for one query."""
    _, scores, ids = search_all(tree, q[None], None if own is None else np.array([own]), k, counter)
    return list(zip(scores.tolist(), ids.tolist()))


def _matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    lists = vectors.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def _built(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("id")
    tree = build(_matrix(rows.column("v"), key[1].as_py()), rows.column("id").to_numpy())
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "size": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([tree.packed()], pa.binary())})


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    asked = _narrow(_matrix(rows.column("v"), key[1].as_py()))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "size": pa.array([key[1].as_py()], pa.int32()), "asked": pa.array([pickle.dumps((rows.column("id").to_numpy(), asked))], pa.binary())})


def _search(k: int):
    """A shard's tree of a size and a span of blocks."""

    def run(trees: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        tree = Tree.unpacked(trees.column("tree")[0].as_py()) if len(trees) and len(blocks) else None
        for data in blocks.column("asked") if tree is not None else ():
            ids, asked = pickle.loads(data.as_py())
            row, scores, found = search_all(tree, asked.astype(np.int64), ids, k)
            out.append((ids[row], found, scores))
        found = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        release()
        return pa.table([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])

    return run


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, also: dict[str, Column] | None = None) -> DataFrame:
    """id, v: floor(scale * x) of each component, size, and the columns of `also`. Rows without vector, or with a null or non-finite
    component, go; a component that is no 64-bit integer then is an error."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), *[c.alias(n) for n, c in (also or {}).items()])
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("x").isNotNull() & ~bad)
    large = F.exists("x", lambda c: F.abs(c * scale) >= 2.0**63)
    return rows.select("id", F.when(large, F.raise_error(F.lit("a component is beyond 64 bits"))).otherwise(F.transform("x", lambda c: F.floor(c * scale))).alias("v"), F.size("x").alias("size"), *(also or {}))


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id, score, for the k highest integer inner products; ties to the smaller id.

    Candidates are all rows whose id is not the query's and whose vector is as long as the query's; fewer than k come back if
    there are fewer. Rows that repeat an id are candidates one by one, but tie as equals; a query id that repeats gives the best
    over its vectors. Empty tables give no rows. A score beyond 64 bits is an error.
    """
    data, asked = (integer_vectors(v, id_col, vector_col, scale).where("id is not null") for v in (vectors, queries))
    shards, blocks = max(1, -(-data.count() // SHARD)), max(1, -(-asked.count() // QUERIES))
    tasks = 4 * parallelism(vectors.sparkSession)
    dealt = data.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards))).repartition(max(tasks, shards), "shard", "size")
    trees = stored(dealt.groupBy("shard", "size").applyInArrow(_built, "shard long, size int, tree binary"), "trees")
    packed = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks))).groupBy("block", "size").applyInArrow(_block, "block long, size int, asked binary")
    # A stated query set in blocks: each block once to each shard that has vectors of its size. Both sides are shuffled: what goes to
    # all shards has no bound that would let it pass through the driver, as a broadcast does.
    spans = min(blocks, max(-(-blocks // SPAN), -(-2 * tasks // shards)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    keys, parts = ["shard", "span", "size"], max(tasks, shards * spans // 4)
    sent = packed.withColumn("span", F.col("block") % spans).withColumn("shard", every(shards)).repartition(parts, *keys)
    asked_of = trees.withColumn("span", every(spans)).repartition(parts, *keys)
    found = asked_of.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
