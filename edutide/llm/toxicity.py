"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals (operator 6).

Labels are of documents, so token labels are made first: a word is labelled toxic, in a toxic document, if the word itself
or a beginning of it stands in far more toxic than clean documents (ratio and likelihood ratio), unless the word itself is common in clean
ones. The field has two states,
transition weights, and hashed features of each word (the word, its beginnings and ends). Sequences are sentences, at most
LONGEST words each; every word of every text is in one. Forward-backward marginals of all words give a document's expected
number of toxic words and its most toxic one; a logistic curve over these, fitted on labelled documents, is the score.

Fitting reads a bounded sample, by the parameters of `fit`: at most `sample` labelled documents of either label, those of the
smallest hashes, and of their sentences about `sentences` with a toxic word and as many without. The word statistics for token
labels take in all words of these documents. Scoring covers every whole text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import ALPHANUMERIC, Words, flat, freed, mix, pieces, split
from .stage import stored

SAMPLE, SENTENCES, LONGEST, BUCKETS = 8000, 20000, 48, 1 << 18
HEADS, TAILS = (4, 5, 6), (4,)

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


def affixes(w: Words) -> np.ndarray:
    """(words, 1 + heads + tails) hashes: the word, its first and its last bytes (the whole word, where it is shorter)."""
    h = w.hashes()
    columns = [h]
    n = w.end - w.start
    for k, (sizes, tail) in enumerate(((HEADS, False), (TAILS, True))):
        for size in sizes:
            out = np.full(len(h), 1 + size + 100 * k, np.uint64)
            for j in range(size):
                at = w.end - 1 - j if tail else w.start + j
                byte = np.where(j < n, w.data[np.minimum(np.maximum(at, 0), max(len(w.data) - 1, 0))], 0) if len(h) else np.zeros(0)
                out = out * np.uint64(1099511628211) + byte.astype(np.uint64)
            columns.append(mix(out))
    return np.stack(columns, axis=1)


def sequences(w: Words) -> np.ndarray:
    """Where each sequence begins among the words."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(_ENDS[w.data])])
    new = np.ones(len(w.start), bool)
    new[1:] = ends[w.start[1:]] > ends[w.end[:-1]]
    new[w.first[:-1][w.first[:-1] < len(new)]] = True
    begin = np.flatnonzero(new)
    place = np.arange(len(new)) - np.repeat(begin, np.diff(np.append(begin, len(new))))
    return np.flatnonzero(place % LONGEST == 0)


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


@dataclass
class Model:
    lexicon: np.ndarray  # sorted hashes of words and beginnings that make a token label
    mild: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # of words that begin so but are common in clean texts
    emission: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0]))

    def labels(self, f: np.ndarray) -> np.ndarray:
        out = np.zeros(len(f), bool)
        for j in range(1 + len(HEADS)):
            out |= _among(f[:, j], self.lexicon)
        return out & ~_among(f[:, 0], self.mild)

    def energies(self, f: np.ndarray) -> np.ndarray:
        return self.emission[(f & np.uint64(BUCKETS - 1)).astype(np.int64)].sum(axis=1, dtype=np.float64)


def forward_backward(energy: np.ndarray, begin: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 of every word, and for every word but a sequence's first the marginals of its four transitions."""
    total = len(energy)
    t = np.exp(transition)
    size = np.diff(np.append(begin, total))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    e = np.exp(np.clip(energy, -30, 30))
    ahead, back = np.full(total, 0.5), np.full(total, 0.5)
    if not total:
        return ahead, np.zeros((0, 2, 2))
    f = e[begin] / (1 + e[begin])
    ahead[begin] = f
    active = [int(np.searchsorted(-size, -k, side="left")) for k in range(int(size[0]) + 1)]
    for k in range(1, int(size[0])):
        m = active[k]
        at, f = begin[:m] + k, f[:m]
        one = ((1 - f) * t[0, 1] + f * t[1, 1]) * e[at]
        f = one / (one + (1 - f) * t[0, 0] + f * t[1, 0])
        ahead[at] = f
    b = np.full(len(begin), 0.5)
    for k in range(int(size[0]) - 2, -1, -1):
        m = active[k + 1]
        at = begin[:m] + k
        x = b[:m] * e[at + 1]
        one, zero = t[1, 0] * (1 - b[:m]) + t[1, 1] * x, t[0, 0] * (1 - b[:m]) + t[0, 1] * x
        b[:m] = one / (one + zero)
        back[at] = b[:m]
    one, zero = ahead * back, (1 - ahead) * (1 - back)
    p = one / np.maximum(one + zero, 1e-300)
    inner = np.ones(total, bool)
    inner[begin] = False
    i = np.flatnonzero(inner)
    left = np.stack([1 - ahead[i - 1], ahead[i - 1]], axis=1)
    right = np.stack([1 - back[i], back[i] * e[i]], axis=1)
    pair = left[:, :, None] * t[None] * right[:, None, :]
    return p, pair / pair.sum(axis=(1, 2), keepdims=True)


def train_field(features: np.ndarray, labels: np.ndarray, begin: np.ndarray, model: Model, epochs: int = 6, batch: int = 512, rate: float = 0.3) -> None:
    """Adaptive gradient steps on the conditional likelihood, in place. features: bucket numbers by word."""
    rng, sums, tsums = np.random.default_rng(7), np.full(BUCKETS, 1e-6, np.float64), np.full((2, 2), 1e-6)
    end = np.append(begin[1:], len(labels))
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(begin)), max(1, len(begin) // batch)):
            n = end[pick] - begin[pick]
            words = np.repeat(begin[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            f, y = features[words], labels[words]
            p, pair = forward_backward(model.emission[f].sum(axis=1, dtype=np.float64), np.cumsum(n) - n, model.transition)
            g = np.zeros(BUCKETS)
            np.add.at(g, f, ((y - p) / len(pick))[:, None])
            g -= 1e-6 * model.emission
            sums += g * g
            model.emission += (rate * g / np.sqrt(sums)).astype(np.float32)
            inner = np.ones(len(y), bool)
            inner[np.cumsum(n) - n] = False
            i = np.flatnonzero(inner)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[i - 1].astype(int), y[i].astype(int)), 1)
            tg = (seen - pair.sum(axis=0)) / len(pick)
            tsums += tg * tg
            model.transition += 0.1 * tg / np.sqrt(tsums)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 1 << 20):
        w = split(b.column("text"), ALPHANUMERIC)
        f, doc, toxic = affixes(w), w.doc, b.column("toxic").to_numpy(zero_copy_only=False)
        every, of = f[:, : 1 + len(HEADS)].ravel(), np.repeat(doc, 1 + len(HEADS))
        order = np.lexsort((every, of))
        every, of = every[order], of[order]
        new = np.ones(len(every), bool)  # the first of a text's equal ones
        new[1:] = (every[1:] != every[:-1]) | (of[1:] != of[:-1])
        h, at = np.unique(every[new], return_inverse=True)
        bad = np.bincount(at, toxic[of[new]], len(h)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(h)).astype(np.int64) - bad)], ["h", "bad", "good"])


def _labelled(model: Model):
    """Distinct words that the lexicon would label, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 20):
            f = affixes(split(b.column("text"), ALPHANUMERIC))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(f[model.labels(f), 0]).view(np.int64))], ["h"])

    return run


def _kinds(model: Model):
    """How many sentences have a toxic word and how many have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 20):
            w = split(b.column("text"), ALPHANUMERIC)
            begin = sequences(w)
            if len(begin):
                y = model.labels(affixes(w)) & (b.column("toxic").to_numpy(zero_copy_only=False)[w.doc] == 1)
                has = int((np.add.reduceat(y.astype(np.int64), begin) > 0).sum())
                yield pa.RecordBatch.from_arrays([pa.array([has]), pa.array([len(begin) - has])], ["has", "rest"])

    return run


def _examples(model: Model, shares: tuple[float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 20):
            w = split(b.column("text"), ALPHANUMERIC)
            f, begin = affixes(w), sequences(w)
            if not len(begin):
                continue
            y = model.labels(f) & (b.column("toxic").to_numpy(zero_copy_only=False)[w.doc] == 1)
            size = np.diff(np.append(begin, len(y)))
            has = np.add.reduceat(y.astype(np.int64), begin) > 0
            # A sentence with a toxic word or without, with the share that the sample has of its kind, by a hash of its words.
            place = mix(np.add.reduceat(f[:, 0], begin)) / 2.0**64
            keep = np.flatnonzero(place < np.where(has, shares[1], shares[0]))
            bucket = (f & np.uint64(BUCKETS - 1)).astype(np.int32)
            out = [[has[i], bucket[begin[i] : begin[i] + size[i]].ravel(), y[begin[i] : begin[i] + size[i]].astype(np.int8)] for i in keep]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.bool_()), pa.array([x[1] for x in out], pa.list_(pa.int32())), pa.array([x[2] for x in out], pa.list_(pa.int8()))], ["has", "f", "y"])

    return run


def _marginals(model: Model, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Every word's probability to be toxic; per text: (most toxic word's logit, log of 1 + expected toxic words, each
    weighted by its own probability, so that thousands of unlikely ones stay little)."""
    p = forward_backward(model.energies(affixes(w)), sequences(w), model.transition)[0]
    n = len(w.first) - 1
    full = np.flatnonzero(np.diff(w.first))
    top, total = np.zeros(n), np.zeros(n)
    if len(full):
        top[full] = np.maximum.reduceat(p, w.first[full])
        total[full] = np.add.reduceat(p * p, w.first[full])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return p, np.stack([np.log(top / (1 - top)), np.log1p(total)], axis=1)


def _scores(model: Model):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1 << 19):
            w = split(b.column("text"), ALPHANUMERIC)
            p, x = _marginals(model, w)
            score = 1 / (1 + np.exp(-(model.curve[0] + x @ model.curve[1:])))
            points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
            doc, spans = w.doc, [[] for _ in range(b.num_rows)]
            base = points[flat(b.column("text"))[1][:-1]]
            for i in np.flatnonzero(p >= 0.5).tolist():
                d = int(doc[i])
                spans[d].append({"start": int(points[w.start[i]] - base[d]), "end": int(points[w.end[i]] - base[d]), "score": float(p[i])})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(spans, kind)], ["doc_id", "score", "top", "mass", "spans"])

    return run


SCORED = "doc_id long, score double, top double, mass double, spans array<struct<start:long,end:long,score:double>>"


def _logistic(x: np.ndarray, y: np.ndarray, odds: float) -> np.ndarray:
    """Newton steps for a ridge logistic curve; odds: those of label 1 among all rows, where the sample has others."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(1 + x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    if 0 < y.sum() < len(y):
        w[0] += np.log(odds) - np.log(y.sum() / (len(y) - y.sum()))
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sentences: int = SENTENCES) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic (0 or 1; an id with both counts as 1), training rows only.

    sample: labelled documents of either label that are read, at most. sentences: sequences of either kind that train the field,
    about. Rows of docs that repeat an id are all read, and count as one for the curve. No toxic or no clean rows: a constant
    score. Null texts have no words; rows without an id are not used.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    model = Model(np.zeros(0, np.uint64))
    if len(counts) < 2:
        model.curve[0] = 4.0 if counts.get(1) else -4.0
        return model
    picked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    spark = docs.sparkSession
    chosen = spark.createDataFrame(picked[0].union(picked[1]).collect(), "doc_id long, toxic int")  # at most 2 * sample rows
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "sample")  # the one scan of docs
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad_n, good_n = n.get(1, 0), n.get(0, 0)
    if not bad_n or not good_n:
        model.curve[0] = 4.0 if bad_n else -4.0
        return model
    seen = rows.mapInArrow(_statistics, "h long, bad long, good long").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    seen = stored(seen.where("bad >= 1"), "word-statistics")
    share = bad_n / (bad_n + good_n)
    total = F.col("bad") + F.col("good")
    gain = 2 * (F.col("bad") * F.log(F.col("bad") / (total * share)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (total * (1 - share)))).otherwise(0.0))
    ratio = (F.col("bad") / bad_n) / ((F.col("good") + 0.5) / good_n)
    strong = seen.where("bad >= 3").withColumn("gain", gain).where((ratio >= 6) & (F.col("gain") >= 22))  # words of 2 * sample documents
    model.lexicon = np.sort(np.array([r["h"] for r in strong.select("h").collect()], np.int64).view(np.uint64))
    mild = seen.where((F.col("good") >= 2) & (ratio < 6)).join(rows.mapInArrow(_labelled(model), "h long").distinct(), "h", "left_semi")
    model.mild = np.sort(np.array([r["h"] for r in mild.select("h").collect()], np.int64).view(np.uint64))
    kinds = rows.mapInArrow(_kinds(model), "has long, rest long").agg(F.sum("has").alias("has"), F.sum("rest").alias("rest")).first()
    shares = tuple(min(1.0, sentences / max(1, kinds[x] or 0)) for x in ("rest", "has"))
    made = rows.mapInArrow(_examples(model, shares), "has boolean, f array<int>, y array<byte>").withColumn("place", F.xxhash64("f", "y"))
    got = [made.toArrow().sort_by("place")]  # about 2 * sentences rows, in an order that no task decides
    if kinds["has"]:
        both = pa.concat_tables(got).combine_chunks()
        y = both.column("y").combine_chunks()
        y = y.chunk(0) if isinstance(y, pa.ChunkedArray) else y
        f = both.column("f").combine_chunks()
        f = f.chunk(0) if isinstance(f, pa.ChunkedArray) else f
        size = y.value_lengths().to_numpy()
        features = f.flatten().to_numpy().reshape(-1, 1 + len(HEADS) + len(TAILS))
        train_field(features, y.flatten().to_numpy().astype(np.float64), np.cumsum(size) - size, model)
    fitted = rows.mapInArrow(_scores(model), SCORED).select("doc_id", "top", "mass").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("top").alias("top"), F.max("mass").alias("mass")).orderBy("doc_id").collect()  # a row for each chosen id
    x = np.array([[r["top"], r["mass"]] for r in fitted])
    model.curve = _logistic(x, np.array([r["toxic"] for r in fitted], float), counts[1] / counts[0])
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 if score >= threshold), spans (start, end in code points, score).

    Null and wordless texts score as no toxic word does. Null and repeated ids come back row by row; an empty table gives no
    rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_scores(model), SCORED)
    return out.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
