"""Mixing, the filter audit and vector codes against plain versions of themselves."""

import hashlib
import itertools
import math
import re
from collections import defaultdict

import numpy as np
import pytest

from edutide.llm import audit, gnat, mixing

WORDS = re.compile(mixing.WORD)


def plain_targets(sizes, weights, most):
    """Sources in order of code points, null last; the excess is reshared round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, open_ = {}, set(sizes)
    left = sum(sizes.values())
    while open_:
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if each[s] > most * sizes[s]}
        if not full:
            return got | each
        got |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return got


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_those_of_resharing(spark, seed):
    rnd = np.random.default_rng(seed)
    sizes = {None if i == 3 else f"s{i}": int(rnd.integers(0, 4)) * int(10 ** rnd.integers(0, 6)) for i in range(int(rnd.integers(4, 30)))}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for weights, most in (((5, 2, 1), 3), ((1,), 1), ((7, 1), 2)):
        got = {r.source: r.target for r in mixing.targets(df, weights, most).collect()}
        want = plain_targets(sizes, weights, most)
        assert got == pytest.approx(want) if None not in got else [got[k] for k in sizes] == pytest.approx([want[k] for k in sizes])
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    assert mixing.targets(df.limit(0)).count() == 0


def mixed(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, size int")
    return mixing.mix(df, **options).collect()


def test_words_taken_are_near_the_targets(spark, edge_texts, edge_docs, no_docs, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rnd.integers(0, 60))), str(rnd.choice(["a", "b", "c", "hot", "hot", "é"])) if i % 31 else None) for i in range(900)]
    rows += [(1, "alike " * 5, "hot")] * 250 + [(None, None, "none"), (None, " \t", "none")]
    plain = sorted(map(tuple, mixed(spark, rows)), key=str)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    taken, longest = defaultdict(int), defaultdict(int)
    for doc_id, size, source_size, target, words, copies, source in plain:
        assert source_size == sizes[source] and words == copies * size <= 3 * size
        taken[source] += words
        longest[source] = max(longest[source], size)
        assert target == pytest.approx(plain_targets(dict(sizes), (5, 2, 1), 3)[source])
    for _, _, _, target, _, _, source in plain:
        assert abs(taken[source] - target) <= longest[source] / 2 + 1e-6
    assert sorted((d, s) for d, s, *_ in plain if d is not None) == sorted((d, len(WORDS.findall(t or ""))) for d, t, _ in rows if d is not None)
    rnd.shuffle(rows)
    for bits in (1, 4):  # other histograms, other order of rows: the same mixture
        monkeypatch.setattr(mixing, "BITS", bits)
        assert sorted(map(tuple, mixed(spark, [(None if a is None else int(a), b, c) for a, b, c in rows])), key=str) == plain
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(edge_docs).count() == edge_docs.count()


def test_thresholds_are_nested(spark):
    rows = [(i, " ".join(["w"] * (i % 17 + 1)), "ab"[i % 2]) for i in range(400)]
    less = {r.doc_id: r.copies for r in mixed(spark, rows, weights=(5, 2))}
    more = {r.doc_id: r.copies for r in mixed(spark, rows, weights=(6, 2))}
    assert all(more[i] >= less[i] for i in range(0, 400, 2)) and sum(more[i] > less[i] for i in range(0, 400, 2)) > 10


def plain_audit(docs, labels):
    docs = [(i, p or "", t or "") for i, p, t in docs]
    least = {}
    for i, _, t in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}

    def failed(i, t):
        w = WORDS.findall(t)
        found = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and i > least[t]]
        return {f for f, x in zip("ABCDE", found) if x}

    fails = [(p, failed(i, t), i in good, i in toxic) for i, p, t in docs]
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(f, g, x) for p, f, g, x in fails if p == part]
        totals = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, own in enumerate(order, 1):
                removed = [m for m in left if own in m[0]]
                left = [m for m in left if own not in m[0]]
                all_ = [m for m in mine if own in m[0]]
                totals[own] += len(removed)
                out[part, "".join(order), step] = [len(left), len(removed), len(all_) - len(removed), sum(m[0] == {own} for m in mine), sum(m[1] for m in removed), sum(m[2] for m in removed)]
        for order in itertools.permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                out[part, "".join(order), step].append(totals[own])
    return out


@pytest.mark.parametrize("texts, bits, chunk", [(1024, 1 << 29, 1 << 20), (4, 1 << 29, 7), (1024, 1 << 13, 3)])
def test_filter_audit(spark, edge_texts, monkeypatch, texts, bits, chunk):
    monkeypatch.setattr(audit, "SHARD_TEXTS", texts)
    monkeypatch.setattr(audit, "SKETCH_BITS", bits)
    monkeypatch.setattr(audit, "CHUNK", chunk)
    rnd = np.random.default_rng(8)
    rows = [(i, f"p{i % 3}" if i % 7 else None, t) for i, t in enumerate(edge_texts)]
    rows += [(int(rnd.integers(0, 90)), "p1", edge_texts[int(rnd.integers(0, 40))]) for _ in range(60)]
    rows += [(i, "hot", "the same $") for i in range(1000, 1200)] + [(1000, "hot", "the same $")] * 3 + [(None, "", "the same $"), (None, "p2", None), (3, "p0", "ABC " * 300), (4, "p0", " ".join(f"w{i}" for i in range(250)))]
    labels = [(int(i), int(rnd.integers(0, 2)), int(rnd.integers(0, 2))) for i in rnd.integers(0, 1100, 300)] + [(None, 1, 1), (2, None, None), (1001, 1, 0), (1001, 0, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, mask int, told string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in audit.filter_audit(docs, marks).collect()}
    assert got == plain_audit(rows, labels)
    none = audit.filter_audit(docs, marks.limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum", "removed": "sum"}).first()
    assert none["sum(good_lost)"] == none["sum(toxic_lost)"] == 0 < none["sum(removed)"]
    assert audit.filter_audit(docs.limit(0), marks).count() == 0


def test_sketches_clear_unique_texts_only(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.xxhash64("id").alias("told"), F.xxhash64("id", F.lit(1)).alias("check"), "id")
    df = df.unionByName(df.where("id < 200"))
    sketch = audit.counting_bloom(df, df.count())
    got = audit.possible_repeats(df, sketch)
    assert got.count() == 3200 and got.where("id < 200 and not possible").count() == 0
    assert got.where("id >= 200 and possible").count() < 280  # a few in a hundred


def plain_codes(rows, parts, entries, rounds):
    """rows: (id, label, integers)."""
    if not rows:
        return {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(rows[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[2], p) for r in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(cut(r[2], p), e), k) for k, e in enumerate(books[p])) for p in range(parts)] for r in rows]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(r[2], p) for r, f in zip(rows, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by = defaultdict(int)
    for r, e in zip(rows, errors):
        by[r[1]] += e
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by[r[1]], digest, r[1]) for r, f, e in zip(rows, found, errors)), key=str)


@pytest.mark.parametrize("n, spread, entries", [(300, 0.3, 64), (40, 0.3, 64), (500, 0.01, 200), (200, 3e5, 16)])
def test_codes(spark, n, spread, entries):
    rnd = np.random.default_rng(n)
    vectors = [(i if i % 50 else None, [float(np.float32(x)) for x in rnd.normal(0, spread, 32)], i % 5 if i % 9 else None) for i in range(n)]
    vectors += [(7, vectors[9][1], 1)] * 40 + [(7, vectors[10][1], 1)]
    dropped = [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 2), (0, [float("inf")] * 32, 2)]
    df = spark.createDataFrame([(*v, "x") for v in vectors + dropped], "vec_id long, embedding array<float>, label int, code string")
    got = sorted(map(tuple, gnat.compress(df, entries=entries).collect()), key=str)
    assert got == plain_codes([(i, b, [math.floor(256 * x) for x in v]) for i, v, b in vectors], 16, entries, 2)


def test_codes_of_odd_tables(spark):
    df = spark.createDataFrame([(1, [1.0] * 16, 1), (2, [2.0] * 32, 1)], "vec_id long, embedding array<double>, label int")
    assert gnat.compress(df.limit(0)).count() == 0
    assert gnat.compress(spark.createDataFrame([(1, None, 1)], df.schema)).count() == 0
    for bad in (df, spark.createDataFrame([(1, [1.0] * 17, 1)], df.schema)):
        with pytest.raises(ValueError, match="one length"):
            gnat.compress(bad)
    far = spark.createDataFrame([(1, [3.0e16] * 16, "a"), (2, [-3.0e16] * 16, "a"), (3, [3.0e16] * 16, "b")], "vec_id long, embedding array<double>, label string")
    assert {(r.vec_id, r.code, r.error) for r in gnat.compress(far).collect()} == {(1, "00" * 16, 0), (2, "01" * 16, 0), (3, "00" * 16, 0)}


@pytest.mark.parametrize("size", [3, 40, 1 << 20, 1 << 40])
def test_nearest_entries_with_ties(size):
    rnd = np.random.default_rng(size % 97)
    entries = rnd.integers(-size, size, (64, 4))
    entries[40:50] = entries[3:13]  # equal entries
    queries = np.concatenate([rnd.integers(-size, size, (800, 4)), entries, (entries[:32] + entries[32:]) // 2])
    best, dist = gnat.nearest(gnat.build(entries), queries)
    for q, b, d in zip(queries.tolist(), best.tolist(), dist.tolist()):
        assert (d, b) == min((sum((x - y) ** 2 for x, y in zip(q, e)), k) for k, e in enumerate(entries.tolist()))


def test_subtrees_are_left_out():
    rnd = np.random.default_rng(1)
    entries = np.concatenate([rnd.integers(-6, 6, (8, 4)) + c for c in rnd.integers(-500, 500, (8, 4))])
    queries = entries[rnd.integers(0, 64, 500)] + rnd.integers(-3, 3, (500, 4))
    counter = [0]
    gnat.nearest(gnat.build(entries), queries, counter)
    assert counter[0] < 0.5 * 64 * len(queries)
