"""b-bit MinHash near-duplicate groups (operator 2).

Plan: whole texts -> distinct word shingles -> one fingerprint per set, so exact copies collapse before anything else ->
minima of 128 hash functions per distinct set, of which two low bits are kept, packed in four longs -> 32 bands of four
minima give buckets -> each set against the smallest of its bucket, by the collision-corrected estimate from bit counts, then
on full sets -> connected components. In buckets that still hold several components, the estimate is made for all pairs, and its
links make families: texts that only share a bucket by chance or boilerplate stay out. In a family, in blocks of bounded bytes,
all members of different components are confirmed on full sets -> connected components of all links.

A pair of similarity 0.85 shares no bucket with probability (1 - 0.85^4)^32 = 6e-11, at 0.8 it is 5e-8. The estimate has a
standard error of 0.037 there; the filter stands six of them below the threshold, so that it drops no true link in practice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import NOT_SPACE, freed, mix, pieces, shingles, split
from .components import connected_components
from .stage import stored

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Low bits kept of each minimum, and longs that hold them.
BITS = 2
LONGS = HASHES * BITS // 64
#: Members of a bucket, and members and shingles of a family, that one task compares with as many others, about.
BUCKET, BLOCK, SHINGLES = 4096, 1024, 2 << 20

_SEED = np.arange(1, 2 * HASHES + 1, dtype=np.uint64)
_A, _B = mix(_SEED[:HASHES]) | np.uint64(1), mix(_SEED[HASHES:])


def distinct_shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, sorted inside the text, and where each text's begin (one more than texts)."""
    h, doc = shingles(split(texts, NOT_SPACE), k)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def minima(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(sets, HASHES) minima; at: where each (non-empty) set begins in h."""
    out = np.empty((len(at), HASHES), np.uint64)
    if len(at):
        for i in range(HASHES):
            out[:, i] = np.minimum.reduceat(h * _A[i] + _B[i], at)
    return out


def pack(m: np.ndarray) -> np.ndarray:
    """The BITS low bits of each minimum, in LONGS signed longs a set."""
    low = (m & np.uint64((1 << BITS) - 1)).reshape(len(m), LONGS, 64 // BITS)
    shift = (np.arange(64 // BITS) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low << shift, axis=2).view(np.int64)


def band_keys(m: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys: a hash of the band's number and its ROWS minima."""
    out = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77)), (len(m), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + m[:, r::ROWS])
    return out.view(np.int64)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), values.shape[1]).cast(pa.list_(pa.int64()))


def _signatures(k: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 19, "_text"):
            h, off = distinct_shingles(b.column("_text"), k)
            n = np.diff(off)
            full = np.flatnonzero(n)
            m = minima(h, off[:-1][full])
            f1 = np.zeros(len(n), np.int64)
            f2 = np.zeros(len(n), np.int64)
            if len(full):
                f1[full] = np.add.reduceat(mix(h + np.uint64(11)), off[:-1][full]).view(np.int64)
                f2[full] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), off[:-1][full]).view(np.int64)
            sig = np.zeros((len(n), LONGS), np.int64)
            sig[full] = pack(m)
            bands = np.zeros((len(n), BANDS), np.int64)
            bands[full] = band_keys(m)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n.astype(np.int64)), pa.array(f1), pa.array(f2), _longs(sig), _longs(bands)], ["id", "n", "f1", "f2", "sig", "bands"])

    return run


def _sets(k: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 20, "_text"):
            h, off = distinct_shingles(b.column("_text"), k)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))], ["id", "set"])

    return run


def equal_minima(a: str, b: str):
    """Of HASHES minima, how many agree in all low bits, from the packed columns a and b."""
    total = F.lit(0)
    for i in range(LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.lit(HASHES) - total


def corrected(equal: float | object):
    """The similarity that so many equal minima stand for: chance alone makes 2^-BITS of them equal."""
    c = 2.0**-BITS
    return (equal / HASHES - c) / (1 - c)


def least_equal(threshold: float) -> int:
    """Equal minima that a pair of the threshold's similarity has at least, but for six standard errors."""
    p = 2.0**-BITS + (1 - 2.0**-BITS) * threshold
    return int(HASHES * (p - 6 * (p * (1 - p) / HASHES) ** 0.5))


def _lists(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, one list after another, and where each list begins (one more than lists)."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).view(kind), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def _bitsets(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A bit set per list over the values that two or more lists have."""
    u, at, n = np.unique(values, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    shared = n[at] > 1
    at, owner = place[at[shared]], owner[shared]
    bits = np.zeros((len(off) - 1, int((n > 1).sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (owner, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return bits


#: Longs of bit sets that a task holds; larger blocks are intersected pair by pair.
BIT_LONGS = 16 << 20


def _across(least: int, percent: int):
    """Links between different components in one pair of blocks of a family, confirmed on full sets. As soon as a link joins
    two components they count as one, so at most one row fewer than members comes back."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, ids = rows.column("block").to_numpy(), rows.column("id").to_numpy()
        label = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
        sig = _lists(rows.column("sig"), np.uint64)[0].reshape(len(ids), LONGS)
        values, off = _lists(rows.column("set"), np.int64)
        size = np.diff(off)
        shared_longs = len(values) // 128 + 1
        bits = _bitsets(values, off) if shared_longs * len(ids) <= BIT_LONGS else None
        right = np.flatnonzero(block == j)
        out: list[tuple[int, int]] = []
        for a in np.flatnonzero(block == i):
            some = right[(label[right] != label[a]) & (np.minimum(size[right], size[a]) * 100 >= np.maximum(size[right], size[a]) * percent)]
            if i == j:
                some = some[some > a]
            x = sig[some] ^ sig[a]
            differ = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
            some = some[HASHES - differ.astype(np.int64) >= least]
            if not len(some):
                continue
            if bits is not None:
                common = np.bitwise_count(bits[some] & bits[a]).sum(axis=1).astype(np.int64)
            else:
                mine = values[off[a] : off[a + 1]]
                common = np.array([len(np.intersect1d(mine, values[off[b] : off[b + 1]], assume_unique=True)) for b in some])
            for b in some[common * 100 >= (size[some] + size[a] - common) * percent]:
                if label[b] != label[a]:
                    label[label == label[b]] = label[a]
                    out.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())})

    return run


def _similar(least: int, percent: int):
    """bucket, i, j, block, id, n, sig, sorted by bucket, i and j -> for each such group a forest (u, v) that connects the members
    which links of the estimate connect."""

    def forest(block: np.ndarray, i: int, j: int, ids: np.ndarray, size: np.ndarray, sig: np.ndarray) -> list[tuple[int, int]]:
        label, right, out = np.arange(len(ids)), np.flatnonzero(block == j), []
        for a in np.flatnonzero(block == i):
            some = right[label[right] != label[a]]
            if i == j:
                some = some[some > a]
            some = some[np.minimum(size[some], size[a]) * 100 >= np.maximum(size[some], size[a]) * percent]
            x = sig[some] ^ sig[a]
            differ = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
            for b in some[HASHES - differ.astype(np.int64) >= least]:
                if label[b] != label[a]:
                    label[label == label[b]] = label[a]
                    out.append((int(ids[a]), int(ids[b])))
        return out

    def made(rows: pa.Table) -> pa.RecordBatch:
        """Of whole groups."""
        key = [rows.column(c).to_numpy() for c in ("bucket", "i", "j")]
        new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)]))
        block, ids, size = (rows.column(c).to_numpy() for c in ("block", "id", "n"))
        sig = _lists(rows.column("sig"), np.uint64)[0].reshape(len(ids), LONGS)
        out = [e for a, b in zip(new, [*new[1:], len(ids)]) for e in forest(block[a:b], int(key[1][a]), int(key[2][a]), ids[a:b], size[a:b], sig[a:b])]
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in out], pa.int64()), pa.array([e[1] for e in out], pa.int64())], ["u", "v"])

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            last = np.all([t.column(c).to_numpy() == t.column(c)[-1].as_py() for c in ("bucket", "i", "j")], axis=0)
            done = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last group may go on in the next batch
            if done:
                yield made(t.slice(0, done))
            rest = t.slice(done)
        if rest is not None:
            yield made(rest)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: id, n_shingles, component_id (smallest id that links reach, itself included), kept.

    Two texts are linked if 100 * shared >= percent * united distinct shingles; a text of fewer than `shingle` words has
    one shingle, all its words. Null or wordless texts: n_shingles 0, linked with nothing. Rows with a null id: a null
    component, kept. Rows that repeat an id come back one by one, each with the smallest component of any of the id's texts.
    An empty table gives no rows. Other columns of docs are not read. Shingles are told apart by a 64-bit hash: two of a pair of
    texts meet by chance about once in 1e13 pairs of a thousand words.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sig = stored(rows.mapInArrow(_signatures(shingle), "id long, n long, f1 long, f2 long, sig array<long>, bands array<long>"), "signatures")
    some = sig.where("n > 0 and id is not null")
    # One row for each distinct set: the smallest document that has it.
    sets = stored(some.groupBy("f1", "f2", "n").agg(F.min_by(F.struct("id", "sig", "bands"), "id").alias("x")).select("f1", "f2", "n", "x.id", "x.sig", "x.bands"), "sets")
    buckets = sets.select("id", F.explode("bands").alias("bucket"))
    first = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = stored(buckets.join(first, "bucket"), "shared-buckets")
    signs = sets.select("id", "n", "sig")
    sized = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
    least = least_equal(percent / 100)

    hubs = members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    hubs = hubs.join(signs.toDF("a", "n1", "s1"), "a").join(signs.toDF("b", "n2", "s2"), "b").where(sized & (equal_minima("s1", "s2") >= least))
    wanted = members.select(F.col("id").alias("_id")).distinct()
    full = rows.join(wanted, "_id", "left_semi").dropDuplicates(["_id", "_text"])
    full = stored(full.mapInArrow(_sets(shingle), "id long, set array<long>"), "full-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
        shared = F.size(F.array_intersect("x", "y")).cast("long")
        return both.where(shared * 100 >= (F.size("x") + F.size("y") - shared) * percent).select(F.col("a").alias("u"), F.col("b").alias("v"))

    links = stored(confirmed(hubs.select("a", "b")), "links")
    joined = stored(connected_components(links), "joined")
    # Buckets whose members the hubs have not brought together: the estimate for all pairs, in blocks.
    placed = members.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo != hi and n > 2")
    open_ = open_.select("bucket", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks"))

    def in_blocks(rows: DataFrame) -> DataFrame:
        """Rows with `blocks`: dealt into so many, and once for each pair of blocks that theirs is in."""
        rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    inside = in_blocks(members.select("bucket", "id").join(open_, "bucket")).join(signs, "id").select("bucket", "i", "j", "block", "id", "n", "sig")
    inside = inside.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    families = connected_components(inside.mapInArrow(_similar(least, percent), "u long, v long"), "families").toDF("id", "family").join(signs, "id")
    blocks = families.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / SHINGLES)).cast("int").alias("blocks"))
    spread = in_blocks(families.join(blocks, "family").join(joined.withColumnRenamed("node", "id"), "id", "left")).join(full, "id")
    spread = spread.select("family", "i", "j", "block", "id", F.coalesce("component", "id").alias("component"), "sig", "set")
    more = stored(spread.groupBy("family", "i", "j").applyInArrow(_across(least, percent), "u long, v long"), "more-links")
    merged = connected_components(links.union(more)) if more.limit(1).count() else joined

    to_set = some.select("id", "f1", "f2", "n").join(sets.select("f1", "f2", "n", F.col("id").alias("node")), ["f1", "f2", "n"])
    to_component = to_set.join(merged, "node", "left").select("id", F.coalesce("component", "node").alias("component_id"))
    by_id = to_component.groupBy("id").agg(F.min("component_id").alias("component_id"))
    out = sig.select("id", F.col("n").alias("n_shingles")).join(by_id, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
