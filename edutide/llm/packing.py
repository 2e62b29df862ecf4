"""Packing of tokenised documents into fixed-length sequences (operator 3).

Documents are dealt at random, by a hash that differs from row to row, to tasks and inside a task's share to groups of about
GROUP_BYTES of text: the share is sorted by the hash and cut as it comes. A task so holds one group, however often an id or a text
repeats, and a table read in the same parts gives the same groups. Each group is packed
alone, by first-fit decreasing: what remains of a document after whole sequences are cut from it goes, longest first, into the first
sequence with room, which a tournament tree over the sequences' free capacities finds in a logarithmic number of steps.
Only the text is shuffled, once; no group depends on another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import flat, freed, pieces
from .stage import parallelism
from .units import dropped, units

GROUP_BYTES = 2 << 20
#: Bytes of text for a task, about.
TASK_BYTES = 32 << 20
#: Sequences of a task have ids from its number * STRIDE on.
STRIDE = 1 << 32


class Tournament:
    """Free capacities of `bins` bins; each inner node holds the larger of its two children's."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """Takes `need` from the first bin that has it and returns the bin; there must be one."""
        node, free = 1, self.free
        while node < self.leaves:
            node *= 2
            if free[node] < need:
                node += 1
        found = node - self.leaves
        free[node] -= need
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Each item's bin and its offset there. Ties keep the given order. 0 < sizes <= capacity."""
    tree, used = Tournament(len(sizes), capacity), np.zeros(len(sizes) + 1, np.int64)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        b = tree.first_fit(int(sizes[i]))
        bins[i], offsets[i] = b, used[b]
        used[b] += sizes[i]
    return bins, offsets


def _packed(group: list[pa.RecordBatch], path: str, length: int, end_id: int, first: int) -> pa.RecordBatch:
    """The pieces of one group, in sequences numbered from `first` on."""
    ids, lengths, docs = [], [], []
    for b in group:
        found, off = units(path).encode(b.column("text"))
        ids.append(np.insert(found, off[1:], end_id))
        lengths.append(np.diff(off) + 1)
        docs.append(b.column("doc_id"))
    ids, total = np.concatenate(ids), np.concatenate(lengths)
    begin = np.cumsum(total) - total
    count = -(-total // length)
    doc = np.repeat(np.arange(len(total)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * length
    size = np.minimum(length, total[doc] - start)
    bins, offset = first_fit_decreasing(size, length)
    at = begin[doc] + start
    raw = ids.astype("<u4").tobytes()
    columns = {
        "doc_id": pa.concat_arrays(docs).take(pa.array(doc)), "start": start, "length": size, "doc_tokens": total[doc], "sequence_id": first + bins,
        "offset": offset, "ids": pa.array([raw[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), size.tolist())], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _pack(path: str, length: int, end_id: int, group_bytes: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = STRIDE * (context.partitionId() if context else 0)
        group, size = [], 0
        for b in pieces(batches, min(1 << 18, group_bytes)):
            group.append(b)
            size += int(flat(b.column("text"))[1][-1])
            if size >= group_bytes:
                out = _packed(group, path, length, end_id, first)
                yield out
                first = out.column("sequence_id").to_numpy().max() + 1
                group, size = [], 0
        if group:
            yield _packed(group, path, length, end_id, first)
        dropped(path)

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit integers).

    A document is the ids of its whole text and then end_id. Documents longer than `length` are cut at its multiples.
    Pieces lie in a sequence without gaps from offset 0; only the end of a sequence is free. Null or empty texts are end_id
    alone; rows that repeat an id are packed one by one; a null id is kept as null. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # No task has less than a group, which would only add open sequences.
    tasks = max(1, min(size // group_bytes, max(2 * parallelism(docs.sparkSession), -(-size // TASK_BYTES))))
    dealt = rows.withColumn("deal", F.xxhash64("doc_id", F.monotonically_increasing_id())).repartition(tasks, "deal")
    rows = dealt.sortWithinPartitions("deal").drop("deal")
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(_pack(path, length, end_id, group_bytes), schema)
