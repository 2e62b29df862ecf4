"""Quality by an interpolated modified Kneser-Ney n-gram model of trusted text (operator 1).

The model's units are the bytes of UTF-8 text, so that an n-gram of up to seven is one exact integer. Everything is counted
over all trusted rows. All n-grams of four bytes and more that an n-gram's probability needs (its suffixes and their
contexts) share the three bytes before its last one. Tables are sharded by a hash of these three, so that counts of these orders
and the joins with them are made inside a shard; what the shards hold of three bytes is added up:

  trusted texts -> distinct n-grams of each task -> merged by shard -> counts of all orders, counts of counts.
  texts, in blocks of neighbouring rows -> each block's distinct n-grams -> joined with the counts by shard -> their log
  probabilities go back to the block, which sums them over each whole text.

A text has one mark before its beginning. The n-grams that would reach farther back are none: a byte near the beginning is
judged by what stands between the mark and it. N-grams travel as compressed differences of sorted integers. Only the table of
three bytes (at most 259^3 rows, whatever the input) and four counts of counts an order come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import counted, distinct, flat, freed, mix, pieces, release
from .stage import parallelism, small_side, stored

#: Bytes that UTF-8 never has: before the beginning of a text, after its end, and where an n-gram has no more units.
BEGIN, END, NONE = 0xFF, 0xFE, 0xFD
#: Bytes of text in a scoring block and of trusted text to a shard, about; blocks that ask a shard in one task.
BLOCK_BYTES, SHARD_BYTES, TOGETHER = 48 << 20, 4 << 20, 256
#: N-grams that are sorted at once.
WINDOW = 1 << 20
#: Distinct n-grams that a task holds before it hands them on.
HELD = 3_000_000


class Grams:
    """The n-grams that end at each byte of each text and at its end, in windows of at most WINDOW."""

    def __init__(self, texts: pa.Array, order: int):
        data, off = flat(texts)
        n = np.diff(off)
        size = n + order
        at = np.cumsum(size) - size
        self.order, self.units = order, n + 1
        self.padded = np.full(int(size.sum()), NONE, np.uint8)
        self.keep = np.ones(len(self.padded), bool)
        if len(n):
            shift = np.repeat(np.arange(len(n)) * order + order - 1, n)
            self.padded[np.arange(len(data)) + shift] = data
            self.padded[at + order - 2] = BEGIN
            self.padded[at + size - 1] = END
            self.keep[(at[:, None] + np.arange(order - 1)).ravel()] = False
        self.end = at + size

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(n-grams, the text of each)."""
        for lo in range(0, len(self.padded), WINDOW):
            start, hi = max(0, lo - self.order + 1), min(lo + WINDOW, len(self.padded))
            part = self.padded[start:hi].astype(np.int64)
            code = part.copy()
            for j in range(1, self.order):
                code[j:] |= part[:-j] << (8 * j)
            keep = np.flatnonzero(self.keep[lo:hi]) + lo
            yield code[keep - start], np.searchsorted(self.end, keep, side="right")


def shard_of(g: np.ndarray, shards: int) -> np.ndarray:
    return (mix(((g >> 8) & 0xFFFFFF).astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _packed(values: np.ndarray) -> bytes:
    """Integers as compressed differences, after their number."""
    planes = np.diff(values.astype(np.int64), prepend=0).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


#: Log probabilities travel rounded to steps of 1/2048, as three bytes: down to -8191, where the least that a double's logarithm can be is -745.2.
STEP = 1 / 2048


def _steps(lp: np.ndarray) -> bytes:
    planes = np.round(-lp / STEP).astype("<u4").view(np.uint8).reshape(-1, 4).T[:3]
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unsteps(blob: bytes, n: int) -> np.ndarray:
    planes = np.zeros((4, n), np.uint8)
    planes[:3] = np.frombuffer(pa.decompress(blob, 3 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _unpacked(blob: bytes | pa.Buffer) -> np.ndarray:
    n = int.from_bytes(memoryview(blob)[:8], "little")
    planes = np.frombuffer(pa.decompress(memoryview(blob)[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def _by_shard(g: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its n-grams in g, in order)."""
    s = shard_of(g, shards)
    order = np.argsort(s, kind="stable")
    cuts = np.searchsorted(s[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k] : cuts[k + 1]]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the same n-grams added up; n-grams sorted."""
    g, c = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
    order = np.argsort(g, kind="stable")
    g, c = g[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    return g[at], np.add.reduceat(c, at) if len(g) else c


def _count(order: int, shards: int):
    def out(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        g, c = _added(parts)
        rows = [(k, _packed(g[at]), _packed(c[at])) for k, at in _by_shard(g, shards)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["shard", "grams", "counts"])

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, base = [], 0, 0
        for b in pieces(batches, WINDOW):
            for g, _ in Grams(b.column("text"), order).windows():
                parts.append(counted(g))
                size += len(parts[-1][0])
            if size > 2 * base + HELD // 2:  # merged only when what is new outweighs what was merged
                parts = [_added(parts)]
                base = size = len(parts[0][0])
                if size > HELD:
                    yield out(parts)
                    parts, size, base = [], 0, 0
        if parts:
            yield out(parts)

    return run


def shorter(g: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams at the ends of given distinct (n+1)-grams, and their counts: distinct units to the left, but occurrences where
    nothing can stand to the left, at the beginning of a text."""
    low = g & ((1 << (8 * n)) - 1)
    by = np.argsort(low, kind="stable")
    low, c = low[by], c[by]
    at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
    if not len(low):
        return low, c
    types, g = np.diff(np.append(at, len(low))), low[at]
    return g, np.where(np.isin(g >> (8 * (n - 1)), (BEGIN, NONE)), np.add.reduceat(c, at), types)


def whole(g: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of these that have n units."""
    there = g >> (8 * (n - 1)) != NONE
    return g[there], c[there]


def orders(g: np.ndarray, c: np.ndarray, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """n-grams and counts of all orders from `order` down to 3: occurrences at the highest, below it as `shorter` has them. Those
    of fewer than n units are still among them."""
    out = {order: (g, c)}
    for n in range(order - 1, 2, -1):
        out[n] = shorter(*out[n + 1], n)
    return out


def _merge(order: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        g, c = _added([(_unpacked(x), _unpacked(y)) for x, y in zip(rows.column("grams").to_pylist(), rows.column("counts").to_pylist())])
        every = orders(g, c, order)
        seen = [int((whole(*every[n], n)[1] == i).sum()) for n in range(4, order + 1) for i in range(1, 5)]
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "grams": pa.array([_packed(g)], pa.binary()), "counts": pa.array([_packed(c)], pa.binary()),
            "seen": pa.array([seen], pa.list_(pa.int64())), "threes": pa.array([every[3][0].tolist()], pa.list_(pa.int32())), "three_counts": pa.array([every[3][1].tolist()], pa.list_(pa.int64())),
        })

    return run


def discounts(seen: list[int]) -> np.ndarray:
    """D1, D2, D3+ of one order from how many of its n-grams have counts 1 to 4. One is added to each of the four, so that the
    discounts are defined on any table; each is kept between nothing and its count."""
    n = [0, *(x + 1 for x in seen)]
    y = n[1] / (n[1] + 2 * n[2])
    return np.array([min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.01), i - 0.01) for i in (1, 2, 3)])


def _shares(g: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted n-grams: each one's discounted share of its context; the contexts; the weight each leaves to the lower order."""
    cut = d[np.minimum(c, 3) - 1]
    h = g >> 8
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(h):
        return np.zeros(0), h, np.zeros(0)
    total = np.add.reduceat(c, at).astype(np.float64)
    return (c - cut) / np.repeat(total, np.diff(np.append(at, len(h)))), h[at], np.add.reduceat(cut, at) / total


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in range(1, 5)]


@dataclass
class Low:
    """Orders 1 to 3. pairs: probability of the lower byte of each of 2^16 pairs after the higher one; grams, share, contexts, left:
    of order 3, as _shares has them."""

    pairs: np.ndarray
    grams: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


def low_orders(g: np.ndarray, c: np.ndarray) -> Low:
    """From all n-grams of three units, sorted, and their counts; over 257 units, the bytes and the end."""
    two, pairs = shorter(g, c, 2)
    one, types = counted(two & 0xFF)
    p = np.full(256, 1 / 257)
    if len(one):
        cut = discounts(_counts_of_counts(types))[np.minimum(types, 3) - 1]
        p = p * cut.sum() / types.sum()
        p[one] += (types - cut) / types.sum()
    out = np.tile(p, 256)
    share, h, left = _shares(two, pairs, discounts(_counts_of_counts(pairs)))
    for x, b in zip(h.tolist(), left.tolist()):
        out[x << 8 : (x + 1) << 8] *= b
    out[two] += share
    g, c = whole(g, c, 3)
    return Low(out, g, *_shares(g, c, discounts(_counts_of_counts(c))))


@dataclass
class Model:
    """tables: a row a shard, with its n-grams and counts; cuts: discounts by order from 4 on; low: the orders below."""

    order: int
    shards: int
    tables: DataFrame
    cuts: dict[int, np.ndarray]
    low: Low


def train(trusted: DataFrame, order: int = 7) -> Model:
    """trusted has a column text; null counts as empty, and rows that repeat count as often as they stand there. order is from
    3 to 7. No trusted rows give empty tables: every byte is then equally likely."""
    if not 3 <= order <= 7:
        raise ValueError("order is 3 to 7")
    size = trusted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(1 << 14, max(4 * parallelism(trusted.sparkSession), -(-size // SHARD_BYTES)))
    packed = trusted.select("text").mapInArrow(_count(order, shards), "shard int, grams binary, counts binary")
    schema = "shard int, grams binary, counts binary, seen array<long>, threes array<int>, three_counts array<long>"
    tables = stored(packed.groupBy("shard").applyInArrow(_merge(order), schema), "ngrams")
    sums = tables.agg(F.count("*"), *[F.coalesce(F.sum(F.col("seen")[i]), F.lit(0)) for i in range(4 * (order - 3))]).first()[1:]
    # At most 259^3 rows come to the driver.
    threes = tables.select(F.explode(F.arrays_zip("threes", "three_counts")).alias("x")).groupBy(F.col("x.threes").alias("g")).agg(F.sum("x.three_counts").alias("c")).orderBy("g").toArrow()
    low = low_orders(threes.column("g").to_numpy().astype(np.int64), threes.column("c").to_numpy())
    return Model(order, shards, tables.select("shard", "grams", "counts"), {n: discounts(list(sums[4 * (n - 4) : 4 * (n - 3)])) for n in range(4, order + 1)}, low)


def _found(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands in a sorted array, and which do."""
    at = np.minimum(np.searchsorted(among, values), max(len(among) - 1, 0))
    return at, among[at] == values if len(among) else np.zeros(len(values), bool)


def _interpolated(p: np.ndarray, low: np.ndarray, grams: np.ndarray, share: np.ndarray, contexts: np.ndarray, left: np.ndarray) -> None:
    """p of the order below becomes that of this one, in place."""
    at, known = _found(low >> 8, contexts)
    p[known] *= left[at[known]]
    at, known = _found(low, grams)
    p[known] += share[at[known]]


def log_probabilities(asked: np.ndarray, g: np.ndarray, c: np.ndarray, order: int, cuts: dict[int, np.ndarray], low: Low) -> np.ndarray:
    """Natural logarithms, interpolated over all orders. g, c: counts of a shard that has all that `asked` needs."""
    p = low.pairs[asked & 0xFFFF]
    _interpolated(p, asked & 0xFFFFFF, low.grams, low.share, low.contexts, low.left)
    every = orders(g, c, order)
    for n in range(4, order + 1):
        grams, counts = whole(*every[n], n)
        _interpolated(p, asked & ((1 << (8 * n)) - 1), grams, *_shares(grams, counts, cuts[n]))
    return np.log(p)


def _asked(order: int, shards: int):
    """What this task's texts ask for: each block's distinct n-grams by shard."""

    def out(block: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        g = distinct(np.concatenate(parts))
        rows = [(k, _packed(g[at])) for k, at in _by_shard(g, shards)]
        return pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.int64()), pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["block", "shard", "grams"])

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list[np.ndarray]] = {}
        base: dict[int, int] = {}
        for block, b in _blocks(batches):
            for g, _ in Grams(b.column("text"), order).windows():
                have.setdefault(block, []).append(distinct(g))
            if sum(map(len, have[block])) > 2 * base.get(block, 0) + HELD // 2:
                have[block] = [distinct(np.concatenate(have[block]))]
                base[block] = len(have[block][0])
            if sum(len(x) for parts in have.values() for x in parts) > 2 * HELD:
                block = max(have, key=lambda k: sum(map(len, have[k])))
                yield out(block, have.pop(block))
                base.pop(block, None)
        for block, parts in have.items():
            yield out(block, parts)

    return run


def _blocks(batches: Iterator[pa.RecordBatch], size: int = WINDOW) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of rows that belong to one block."""
    for b in pieces(batches, size):
        of = b.column("block").to_numpy(zero_copy_only=False)
        for k in distinct(of).tolist():
            yield k, b if len(of) == 1 or (of == k).all() else b.filter(pa.array(of == k))


def _answer(model_order: int, cuts: dict[int, np.ndarray], low: Low):
    def run(asked: pa.Table, table: pa.Table) -> pa.Table:
        wanted = [_unpacked(x) for x in asked.column("grams").to_pylist()]
        g = c = np.zeros(0, np.int64)
        if table.num_rows:
            g, c = _unpacked(table.column("grams")[0].as_py()), _unpacked(table.column("counts")[0].as_py())
        every = distinct(np.concatenate([np.zeros(0, np.int64), *wanted]))
        lp = log_probabilities(every, g, c, model_order, cuts, low)
        answers = [_steps(lp[np.searchsorted(every, x)]) for x in wanted]
        return pa.table({"block": asked.column("block"), "grams": asked.column("grams"), "answers": pa.array(answers, pa.binary())})

    return run


_ZSTD = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))


@freed
def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that go to one block, as one compressed value: a shuffle then moves less than the stored table."""
    for block, b in _blocks(batches, 8 << 20):
        rows = pa.table({"row": b.column("row"), "lang": b.column("lang").cast(pa.string()), "text": b.column("text").cast(pa.large_string())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=_ZSTD) as out:
            out.write_table(rows)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])


def _answers(known: pa.Table, shards: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By shard: a block's n-grams, sorted, and their log probabilities in steps. Each shard is sorted alone, so that little is held twice."""
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for x, y in zip(known.column("grams"), known.column("answers")):
        g = _unpacked(x.as_buffer())
        if len(g):
            parts.setdefault(int(shard_of(g[:1], shards)[0]), []).append((g, _unsteps(y.as_buffer(), len(g))))
    out = {}
    for k in list(parts):
        own = parts.pop(k)
        g, lp = own[0] if len(own) == 1 else (np.concatenate([x[i] for x in own]) for i in range(2))
        by = np.argsort(g, kind="stable") if len(own) > 1 else None
        out[k] = (g, lp) if by is None else (g[by], lp[by])
    return out


def _score(order: int, shards: int, key: pa.DataType):
    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        have = _answers(known, shards)
        ids, langs, sums, sizes = [], [], [np.zeros(0)], [np.zeros(0, np.int64)]
        for blob in texts.column("rows"):
            for b in pieces(pa.ipc.open_stream(blob.as_buffer()), WINDOW):
                grams = Grams(b.column("text"), order)
                total = np.zeros(b.num_rows)
                for codes, text in grams.windows():
                    found = np.zeros(len(codes), np.uint32)
                    for k, at in _by_shard(codes, shards):
                        g, lp = have.get(k, (codes[:0], found[:0]))
                        place, there = _found(codes[at], g)
                        if not there.all():
                            raise RuntimeError("a block's rows are not those that asked: the input gave other rows when it was read again")
                        found[at] = lp[place]
                    total -= np.bincount(text, found, b.num_rows) * STEP
                sums.append(total)
                sizes.append(grams.units)
                ids.append(b.column("row"))
                langs.append(b.column("lang").cast(pa.string()))
        have.clear()
        release()
        return pa.table({"row": pa.chunked_array(ids, key), "lang": pa.chunked_array(langs, pa.string()), "logp": np.concatenate(sums), "units": np.concatenate(sizes)})

    return run


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """docs: row (a long or a string), lang, text. Returns row, lang, logp (sum over the whole text), units (bytes and the end). Null text: empty.

    Rows of one part of an input file are a block, or several where it has more than BLOCK_BYTES of text; rows that don't come
    straight from a file are dealt into blocks by a hash.
    """
    text_key = dict(docs.dtypes)["row"] == "string"
    place = F.struct(F.input_file_name(), F.input_file_block_start())
    rows = docs.select("row", "lang", "text", F.xxhash64(place).alias("place"))
    found = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.approx_count_distinct("place", 0.02).alias("places")).first()
    split = max(1, -(-(found["bytes"] or 0) // (BLOCK_BYTES * max(1, found["places"]))))
    dealt = rows.select("row", "lang", "text", F.xxhash64("place", F.pmod(F.xxhash64("row", "text"), F.lit(split))).alias("block"))
    blocks = max(1, found["places"] * split)
    together = -(-blocks // TOGETHER)  # so many tasks share the blocks that ask one shard, each with its table
    asked = dealt.select("block", "text").mapInArrow(_asked(model.order, model.shards), "block long, shard int, grams binary")
    asked = asked.withColumn("part", F.pmod("block", F.lit(together)).cast("int"))
    tables = model.tables.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(together - 1))))
    answers = asked.groupBy("shard", "part").cogroup(tables.groupBy("shard", "part")).applyInArrow(_answer(model.order, model.cuts, model.low), "block long, grams binary, answers binary")
    bundles = dealt.mapInArrow(_bundled, "block long, rows binary")
    return bundles.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(model.order, model.shards, pa.string() if text_key else pa.int64()), f"row {'string' if text_key else 'long'}, lang string, logp double, units long")


def quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 7, quantile: float = 0.995, prior: int = 100, least_held: int = 20, row_col: str | None = None) -> DataFrame:
    """Per row of docs: doc_id, lang, perplexity, score, threshold, accepted.

    trusted_ids (doc_id): the documents of trusted text. Four fifths of them (by hash) train the model; the others set each
    language's threshold, the `quantile` of their scores. perplexity is exp of the mean negative log probability a byte; score
    is the same mean after `prior` units of the trusted mean are mixed in, so that a text of a few words isn't rejected for
    chance; both are null-safe: a null text is empty and scores as its end alone. A language with fewer than `least_held`
    held-out trusted rows, or a null one, takes the threshold of all together; without any trusted text all is accepted.
    Rows that repeat an id are scored one by one. An empty table gives no rows. row_col: a column, long or string, that tells
    rows apart (rows that share it are alike), which then comes back as doc_id, so that each decision belongs to its row.
    """
    rows = docs.select((F.col(row_col) if row_col else F.col(id_col).cast("long")).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    ids = stored(trusted_ids.select(F.col("doc_id").cast("long").alias("row")).where("row is not null").distinct().withColumn("held", F.pmod(F.xxhash64("row", F.lit("fold")), F.lit(5)) == 0), "trusted")
    if row_col:
        ids = stored(rows.select("row", "id").join(small_side(ids.toDF("id", "held")), "id").select("row", "held"), "trusted-rows")
    model = train(rows.join(small_side(ids.where("not held").select("row")), "row", "left_semi"), order)
    scored = stored(perplexities(rows, model), "scores")
    held = scored.join(small_side(ids.where("held").select("row")), "row", "left_semi")
    centre = held.agg(F.sum("logp").alias("l"), F.sum("units").alias("u")).first()
    mean = -(centre["l"] or 0.0) / (centre["u"] or 1)
    score: Column = F.exp((-F.col("logp") + prior * mean) / (F.col("units") + prior))
    held = held.withColumn("score", score)
    cut = held.groupBy("lang").agg(F.percentile_approx("score", quantile, 10000).alias("threshold"), F.count("*").alias("n"))
    whole = held.agg(F.percentile_approx("score", quantile, 10000)).first()[0]
    # One row per language that trusted text has.
    cut = small_side(stored(cut.where(F.col("n") >= least_held).select("lang", "threshold"), "thresholds"))
    out = scored.join(cut, "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(float("inf") if whole is None else whole)))
    out = out.select(F.col("row").alias("doc_id"), "lang", F.exp(-F.col("logp") / F.col("units")).alias("perplexity"), score.alias("score"), "threshold")
    return out.withColumn("accepted", F.col("score") <= F.col("threshold"))
