"""Benchmark decontamination by Wu-Manber search over words (operator 7).

The alphabet is the words of a text, as 64-bit hashes. A pattern is a window of consecutive item words. For each pattern
length m, a shift table over blocks of three words says how far the search may jump (m - 2 where a block is in no pattern), a
shift of 0 leads to the bucket of patterns with that last block, the first block is compared next, then all words' hashes,
and the words themselves confirm. Texts are scanned in lanes of at most LANE words, all lanes of a batch in step.

The patterns go to the tasks in passes of at most PASS_BYTES of item text each, whatever the benchmark's size: the driver reads
one pass at a time and broadcasts it, and each worker makes its tables once. Documents are searched where they are read, never
shuffled. With more than one pass, each writes the rows that it hits, and these are merged by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import ALPHANUMERIC, Words, freed, mix, pieces, split
from .stage import free_name, row_digest, small_side, stored

LANE = 512
PASS_BYTES = 4 << 20
TABLE = 1 << 20


def _blocks(h: np.ndarray, size: int) -> np.ndarray:
    """At each word, a hash of the block of `size` words that ends there (the first size-1 are of no use)."""
    out = np.zeros(len(h), np.uint64)
    for j in range(size):
        shifted = h if j == 0 else np.concatenate([np.zeros(min(j, len(h)), np.uint64), h[:-j]])
        out = mix(out * np.uint64(0xA24BAED4963EE407) + shifted)
    return out


class Patterns:
    """All windows of m words of some items: where each begins among the items' words, and the tables. A window takes some thirty
    bytes; its words stand in the items alone."""

    def __init__(self, items: Words, h: np.ndarray, m: int, begin: np.ndarray):
        """begin: the first words of the windows among the items' words, whose hashes are h."""
        self.m, self.block, self.items, self.h = m, min(3, m), items, h
        blocks = _blocks(h, self.block)
        self.shift = np.full(TABLE, m - self.block + 1, np.int16)
        for j in range(self.block - 1, m):
            np.minimum.at(self.shift, (blocks[begin + j] & np.uint64(TABLE - 1)).astype(np.int64), m - 1 - j)
        suffix = blocks[begin + m - 1]
        order = np.argsort(suffix, kind="stable")
        self.begin, self.suffix = begin[order], suffix[order]
        self.prefix = blocks[self.begin + self.block - 1]

    def find(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words of all occurrences, and which item each is of."""
        m, none = self.m, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        blocks = _blocks(h, self.block)
        shift = self.shift[(blocks & np.uint64(TABLE - 1)).astype(np.int64)]
        lo, hi = w.first[:-1] + m - 1, w.first[1:]
        lanes = np.maximum(0, -(-(hi - lo) // LANE))
        at = np.repeat(lo, lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        stop = np.minimum(at + LANE, np.repeat(hi, lanes))
        ends = []
        while len(at):
            jump = shift[at]
            ends.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        ends = np.concatenate(ends) if ends else none[0]
        a, b = np.searchsorted(self.suffix, blocks[ends], "left"), np.searchsorted(self.suffix, blocks[ends], "right")
        n = b - a
        ends = np.repeat(ends, n)
        pattern = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = blocks[ends - m + self.block] == self.prefix[pattern]
        ends, pattern = ends[same], pattern[same]
        if not len(ends):
            return none
        same = (h[ends[:, None] + np.arange(1 - m, 1)] == self.h[self.begin[pattern][:, None] + np.arange(m)]).all(axis=1)
        ends, begin = ends[same], self.begin[pattern[same]]
        sure = self._same_words(w, ends - m + 1, begin)
        return ends[sure], self.items.doc[begin[sure]]

    def _same_words(self, w: Words, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Whether the m words of the text from `at` on are those of the window from `begin` on, byte by byte."""
        same = np.ones(len(at), bool)
        for j in range(self.m):
            left, right = w.start[at + j], self.items.start[begin + j]
            size = w.end[at + j] - left
            same &= size == self.items.end[begin + j] - right
            for k in range(int(size.max(initial=0))):
                inside = np.flatnonzero(same & (size > k))
                if not len(inside):
                    break
                same[inside] = w.data[left[inside] + k] == self.items.data[right[inside] + k]
        return same


def patterns(texts: list[str | None], window: int) -> list[Patterns]:
    """The patterns of each length of the items' texts."""
    w = split(pa.array(texts, pa.string()), ALPHANUMERIC)
    h, n = w.hashes(), np.diff(w.first)
    size = np.minimum(window, n)
    left = np.repeat(w.first[1:], n) - np.arange(len(h))
    size = np.repeat(size, n)
    return [Patterns(w, h, int(m), np.flatnonzero((size == m) & (left >= m))) for m in np.unique(size)]


_made: list = []


def _of(items: Broadcast, window: int) -> tuple[list[Patterns], list[str]]:
    """A pass's patterns and item ids, made once by each worker and kept until another pass comes."""
    value = items.value
    if not _made or _made[0] is not value or _made[1] != window:
        _made[:] = [value, window, patterns([t for _, t in value], window), [k for k, _ in value]]
    return _made[2], _made[3]


def _search(items: Broadcast, window: int, hits_only: bool):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, names = _of(items, window)
        for b in pieces(batches, 1 << 19):
            w = split(b.column("text"), ALPHANUMERIC)
            h, doc = w.hashes(), w.doc
            ranges: list[list[int]] = [[] for _ in range(b.num_rows)]
            have: list[set[str]] = [set() for _ in range(b.num_rows)]
            for p in found:
                ends, which = p.find(w, h)
                for e, k in zip(ends.tolist(), which.tolist()):
                    d = doc[e]
                    at = e - p.m + 1 - int(w.first[d])
                    ranges[d] += [at, at + p.m]
                    have[d].add(names[k])
            keep = [i for i, x in enumerate(have) if x] if hits_only else range(b.num_rows)
            merged = [_merged(ranges[i]) for i in keep]
            rows = b.select(["doc_id", "row"]).take(pa.array(keep, pa.int64()))
            columns = [*rows.columns, pa.array(np.diff(w.first).astype(np.int64)[list(keep)]), pa.array(merged, pa.list_(pa.int64())), pa.array([sorted(have[i]) for i in keep], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "ranges", "items"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 1 << 19):
        w = split(b.column("text"), ALPHANUMERIC)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(np.diff(w.first).astype(np.int64))], ["doc_id", "row", "n_words"])


def _union(key: tuple, hits: pa.Table) -> pa.Table:
    """All passes' ranges and items of one row; a row has one hit a pass at most."""
    ranges = _merged([x for r in hits.column("ranges").to_pylist() for x in r])
    return pa.table({"row": pa.array([key[0].as_py()], pa.string()), "ranges": pa.array([ranges], pa.list_(pa.int64())), "items": pa.array([sorted({x for r in hits.column("items").to_pylist() for x in r})], pa.list_(pa.string()))})


def _merged(flat: list[int]) -> list[int]:
    """Begin, end, begin, end ... of the union of ranges."""
    if not flat:
        return []
    out: list[int] = []
    for a, b in sorted(zip(flat[0::2], flat[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


class _passes:
    """The benchmark, dealt into n passes."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str):
        items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        self.n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES))
        self.items = items.withColumn("pass", F.pmod(F.xxhash64("id", "text"), F.lit(self.n)))

    def search(self, rows: DataFrame, p: int, window: int, hits_only: bool) -> DataFrame:
        """rows: doc_id, row, text."""
        texts = self.items.where(F.col("pass") == p).select("id", "text").collect()  # PASS_BYTES, about
        sent = rows.sparkSession.sparkContext.broadcast([(r["id"], r["text"]) for r in texts])
        return rows.mapInArrow(_search(sent, window, hits_only), "doc_id long, row string, n_words long, ranges array<long>, items array<string>")

    def hits(self, rows: DataFrame, window: int) -> DataFrame:
        """row, ranges, items of the rows that any pass hits, a row once for each pass that does; written pass by pass."""
        out = None
        for p in range(self.n):
            some = stored(self.search(rows, p, window, True).select("row", "ranges", "items").dropDuplicates(["row"]), "hits")
            out = some if out is None else out.union(some)
        return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10) -> DataFrame:
    """docs without the rows that hold a window of an item, as `decontaminate` finds them; all columns stay as they are. Nulls,
    repeated ids and empty tables are as there: each row is judged by its own text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_digest(id_col, text_col).alias("row"))
    gone = _passes(benchmark, item_col, item_text_col).hits(rows, window).select("row").distinct()
    name = free_name(docs, "_gone")
    return docs.join(small_side(gone.toDF(name), 100_000), row_digest(id_col, text_col) == F.col(name), "left_anti")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit (words inside an occurrence of a window), ranges (their merged word ranges,
    begin and end in turn), items (sorted strings), contaminated (n_hit > 0).

    An item of fewer words than `window`, but not none, is one window. Null texts have no words; an item whose id is null
    has the id ''. Rows of docs that repeat an id come back one by one; items that repeat an id count as one. Empty tables:
    no rows, or no hits. Documents aren't shuffled.
    """
    passes = _passes(benchmark, item_col, item_text_col)
    # Beyond one pass a row is told by a digest of its id and text: rows that share it have the same hits.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (F.lit("") if passes.n == 1 else row_digest(id_col, text_col)).alias("row"))
    if passes.n == 1:
        out = passes.search(rows, 0, window, False)
    else:
        hits = passes.hits(rows, window)
        hits = stored(hits.groupBy("row").applyInArrow(_union, "row string, ranges array<long>, items array<string>"), "hits")
        out = rows.mapInArrow(_counted, "doc_id long, row string, n_words long").join(small_side(hits, 100_000), "row", "left")
        out = out.withColumn("ranges", F.coalesce("ranges", F.array().cast("array<long>"))).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    half = F.transform("ranges", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    out = out.withColumn("n_hit", F.aggregate(half, F.lit(0).cast("long"), lambda a, x: a + x))
    return out.select("doc_id", "n_words", "n_hit", "ranges", "items", (F.col("n_hit") > 0).alias("contaminated"))
