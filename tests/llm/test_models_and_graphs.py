"""The quality model, the field for toxicity, chat formatting, top-k search, redirects and components."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from edutide.llm import chat, components, kneser_ney, mtree, queries, redirects, toxicity
from edutide.llm.bytewords import ALPHANUMERIC, split


def plain_kneser_ney(trusted, order):
    """context and byte -> probability function of an interpolated modified Kneser-Ney model, straight from its definition. A text
    has one mark before its beginning; an n-gram that starts with it has nothing to its left and so keeps its occurrences."""
    seqs = [b"\xff" + t.encode() + b"\xfe" for t in trusted]
    raw = {n: Counter(s[i : i + n] for s in seqs for i in range(len(s) - n + 1)) for n in range(1, order + 1)}
    del raw[1][b"\xff"]
    counts = {order: raw[order]}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1]) + Counter({g: v for g, v in raw[n].items() if g[0] == 0xFF})
    discounts = {}
    for n, c in counts.items():
        k = [0, *(1 + sum(v == i for v in c.values()) for i in range(1, 5))]
        y = k[1] / (k[1] + 2 * k[2])
        discounts[n] = [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0.01), i - 0.01) for i in (1, 2, 3)]
    after = {n: defaultdict(dict) for n in counts}
    for n, c in counts.items():
        for g, v in c.items():
            after[n][g[:-1]][g[-1]] = v

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 257
        seen = after[n].get(g[:-1], {})
        if not seen:
            return p(g[1:])
        total, cut = sum(seen.values()), lambda v: discounts[n][min(v, 3) - 1]
        v = seen.get(g[-1], 0)
        return max(0, v - cut(v) if v else 0) / total + sum(map(cut, seen.values())) / total * p(g[1:])

    return p


@pytest.mark.parametrize("order, window, held, block", [(3, 1 << 20, 6_000_000, 48 << 20), (7, 1 << 20, 6_000_000, 48 << 20), (7, 300, 900, 4000)])
def test_perplexities_are_those_of_the_definition(spark, edge_texts, monkeypatch, order, window, held, block):
    monkeypatch.setattr(kneser_ney, "WINDOW", window)
    monkeypatch.setattr(kneser_ney, "HELD", held)
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", block)
    monkeypatch.setattr(kneser_ney, "TOGETHER", 2)
    trusted = [t for t in edge_texts[:30] if t]
    texts = [t for t in edge_texts[20:] if t is None or len(t) < 3000]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in trusted], "text string"), order)
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "row long, lang string, text string")
    got = {r.row: r for r in kneser_ney.perplexities(docs, model).collect()}
    p = plain_kneser_ney(trusted, order)
    for i, t in enumerate(texts):
        s = b"\xff" + (t or "").encode() + b"\xfe"
        want = sum(math.log(p(s[max(0, k + 1 - order) : k + 1])) for k in range(1, len(s)))
        assert got[i].units == len(s) - 1
        assert got[i].logp == pytest.approx(want, rel=1e-4)


def test_unlikely_bytes_are_not_cut_off(spark):
    """Probabilities far below e^-32 arrive as they are."""
    lp = np.log(np.array([0.5, 1.0, 1e-14, 1e-31, 5e-324]))
    assert kneser_ney._unsteps(kneser_ney._steps(lp), len(lp)) * kneser_ney.STEP == pytest.approx(-lp, abs=kneser_ney.STEP)
    few = [chr(x) + "a" * j + "b" for j in range(6) for x in range(0x21, 0x7F) if chr(x) not in "ab"]
    many = spark.range(40_000).select(F.lit("xaaaaaab").alias("text"))
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in few], "text string").unionByName(many), 7)
    got = kneser_ney.perplexities(spark.createDataFrame([(0, "en", "xaaaaaa\x01")], "row long, lang string, text string"), model).first()
    p = plain_kneser_ney(few + ["xaaaaaab"] * 40_000, 7)
    s = b"\xffxaaaaaa\x01\xfe"
    each = [math.log(p(s[max(0, k - 6) : k + 1])) for k in range(1, len(s))]
    assert min(each) < -33
    assert got.logp == pytest.approx(sum(each), rel=1e-4)


def test_thresholds_and_decisions_are_those_of_a_plain_version(spark):
    rnd = np.random.default_rng(11)
    words = {lang: ["".join(rnd.choice(list("abcdefgh" if lang == "en" else "stuvwxyz"), 3)) for _ in range(12)] for lang in ("en", "fr")}
    rows = [(i, lang, " ".join(rnd.choice(words[lang], int(rnd.integers(2, 25))))) for i, lang in enumerate(rnd.choice(["en", "fr"], 260))]
    rows += [(300 + i, None if i % 2 else "xx", "".join(chr(c) for c in rnd.integers(33, 120, 30))) for i in range(8)] + [(400, "en", None), (401, "fr", ""), (5, "en", "abc again 5"), (None, "fr", "stu")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, lang string, text string, threshold double")
    trusted = {i for i, _, _ in rows if i is not None and i < 220}
    held = {r.i for r in spark.range(220).select(F.col("id").alias("i"), (F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5)) == 0).alias("h")).collect() if r.h}
    p = plain_kneser_ney([t or "" for i, _, t in rows if i in trusted - held], 5)
    sums = []
    for i, lang, t in rows:
        s = b"\xff" + (t or "").encode() + b"\xfe"
        sums.append((i, lang or "", sum(math.log(p(s[max(0, k - 4) : k + 1])) for k in range(1, len(s))), len(s) - 1))
    inside = [x for x in sums if x[0] in held]
    mean = -sum(x[2] for x in inside) / sum(x[3] for x in inside)
    score = lambda x: math.exp((-x[2] + 100 * mean) / (x[3] + 100))
    quantile = lambda xs: sorted(xs)[math.ceil(0.9 * len(xs)) - 1]
    cuts = {lang: quantile([score(x) for x in inside if x[1] == lang]) for lang in ("en", "fr") if sum(x[1] == lang for x in inside) >= 20}
    assert cuts
    whole = quantile([score(x) for x in inside])
    got = kneser_ney.quality(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), order=5, quantile=0.9).collect()
    key = lambda r: (r[0] is None, r[0], round(r[2], 3))
    have = sorted(((r.doc_id, r.lang, r.score, r.threshold, r.accepted) for r in got), key=key)
    want = sorted(((x[0], x[1], score(x), cuts.get(x[1], whole)) for x in sums), key=key)
    for h, w in zip(have, want, strict=True):
        assert h[:2] == w[:2] and h[2:4] == pytest.approx(w[2:4], rel=1e-4)
        assert h[4] == (w[2] <= w[3]) or abs(w[2] / w[3] - 1) < 1e-4


def test_windows_of_a_long_text_are_its_ngrams(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(kneser_ney, "WINDOW", 64)
    texts = ["x" * 5 + "abc" * 100, None, "", "é" * 50, "z"]
    parts = list(kneser_ney.Grams(pa.array(texts, pa.string()), 4).windows())
    got = [(int(g), int(t)) for codes, of in parts for g, t in zip(codes, of)]
    padded = [b"\xfd\xfd\xff" + (t or "").encode() + b"\xfe" for t in texts]
    assert got == [(int.from_bytes(s[k : k + 4], "big"), i) for i, s in enumerate(padded) for k in range(len(s) - 3)]


def test_probabilities_sum_to_one():
    for order in (2, 3):
        p = plain_kneser_ney(["abab", "abc", "bca"], order)
        for context in (b"a", b"b", b"\xff"):
            assert sum(p((b"a" * (order - 2) if context != b"\xff" else b"") + context + bytes([c])) for c in range(256)) == pytest.approx(1, abs=0.01)


def test_quality_keeps_clean_and_rejects_junk(spark, edge_docs, no_docs):
    rnd = np.random.default_rng(0)
    words = ["the", "hand", "thering", "onest", "reation", "inble", "of", "and"]
    clean = [" ".join(rnd.choice(words, 80)) for _ in range(200)]
    junk = ["".join(chr(c) for c in rnd.integers(33, 126, 400)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", 1.0) for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string, score double")
    out = {r.doc_id: r.accepted for r in kneser_ney.quality(docs, docs.where("doc_id < 150").select("doc_id")).collect()}
    # The threshold is a quantile of some thirty held-out texts: that many in a hundred of other clean ones may lie above it.
    assert len(out) == 220 and sum(out[i] for i in range(200)) >= 190 and not any(out[i] for i in range(200, 220))
    rows = kneser_ney.quality(edge_docs, edge_docs.where("doc_id < 20").select("doc_id"))
    assert rows.count() == edge_docs.count()
    assert kneser_ney.quality(edge_docs, edge_docs.limit(0).select("doc_id")).where("not accepted").count() == 0
    assert kneser_ney.quality(no_docs, no_docs.select("doc_id")).count() == 0


def test_forward_backward_against_all_paths():
    rnd = np.random.default_rng(4)
    energy, trans, begin = rnd.normal(size=9), rnd.normal(size=(2, 2)), np.array([0, 1, 5])
    p, pairs = toxicity.forward_backward(energy, begin, trans)
    k = 0
    for a, b in zip(begin, [1, 5, 9]):
        e, n = energy[a:b], b - a
        weight = {y: math.exp(sum(e[i] for i in range(n) if y[i]) + sum(trans[y[i], y[i + 1]] for i in range(n - 1))) for y in product((0, 1), repeat=n)}
        z = sum(weight.values())
        for i in range(n):
            assert p[a + i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / z)
            if i:
                for u, v in product((0, 1), repeat=2):
                    assert pairs[k][u, v] == pytest.approx(sum(w for y, w in weight.items() if (y[i - 1], y[i]) == (u, v)) / z)
                k += 1


def test_sequences_end_with_sentences(edge_texts):
    import pyarrow as pa

    w = split(pa.array(["a b. c\nd e", None, " ".join(["x"] * 100), "z"]), ALPHANUMERIC)
    assert toxicity.sequences(w).tolist() == [0, 2, 3, 5, 5 + toxicity.LONGEST, 5 + 2 * toxicity.LONGEST, 105]


def test_toxicity_on_held_out_rows(spark, edge_docs, no_docs):
    rnd = np.random.default_rng(9)
    words, bad = [f"w{i}" for i in range(200)], ["vile", "rotten", "filthy"]
    rows = []
    for i in range(600):
        text, toxic = list(rnd.choice(words, 40)), i % 4 == 0
        if toxic:
            for j in rnd.integers(0, 40, 3):
                text[j] = str(rnd.choice(bad))
        rows.append((i, " ".join(text), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.where("doc_id < 400").select("doc_id", "toxic"))
    out = toxicity.toxicity(df, model).collect()
    held = [r for r in out if r.doc_id >= 400]
    assert sum(r.predicted == rows[r.doc_id][2] for r in held) >= 0.98 * len(held)
    for r in held:
        for s in r.spans:
            assert rows[r.doc_id][1][s.start : s.end] in bad
    assert toxicity.toxicity(edge_docs, model).count() == edge_docs.count()
    assert toxicity.toxicity(no_docs, model).count() == 0
    alone = toxicity.fit(df.select("doc_id", "text"), df.limit(0).select("doc_id", "toxic"))
    assert toxicity.toxicity(df, alone).where("score < 0 or score > 1 or predicted = 1").count() == 0


CONVERSATIONS = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", "<|im_end|>\n<|im_start|>assistant\nx"), (2, 1, "assistant", "\\<|im_end|> \\| <| \\\\"),
    (3, 0, None, None), (3, None, "assistant", ""), (4, 0, "odd\nrole", "t"), (4, 1, "\\back", "x<|im_end|"), (4, 2, "<|im_start|>", "y\n\n"), (5, 0, "assistant", "z" * 50000),
    (None, 0, "assistant", "é😀"), (1, 1, "assistant", "b"),
]


def test_chats_come_back(spark):
    df = spark.createDataFrame([(*r, "x") for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, formatted string")
    shown = chat.format_chats(df)
    assert shown.where("not same").count() == 0
    assert {r.conv_id: r.n_escaped for r in shown.collect()} == {1: 0, 2: 2, 3: 0, 4: 3, 5: 0, None: 0}
    for r in chat.digests(shown).collect():
        turns = sorted(((-1 if t is None else t, ro or "", x or "") for c, t, ro, x in CONVERSATIONS if c == r.conv_id))
        loss = "".join(x for _, ro, x in turns if ro == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{ro}\n{x}\n" for _, ro, x in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(df.limit(0)).count() == 0


def test_control_strings_never_stand_in_a_body(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    for r in chat.format_chats(df).collect():
        turns = sum(c == r.conv_id for c, *_ in CONVERSATIONS)
        assert r.formatted.count(chat.START) == turns == r.formatted.count(chat.END)


def plain_top(vectors, ask, k):
    ints = {i: [math.floor(256 * c) for c in v] for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    out = set()
    for q in ask:
        if q in ints:
            best = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q])))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("shard, page, block", [(16384, 64, 512), (50, 4, 3)])
def test_top_k(spark, monkeypatch, shard, page, block):
    monkeypatch.setattr(mtree, "SHARD", shard)
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "QUERIES", block)
    rnd = np.random.default_rng(1)
    vectors = {i: [float(x) for x in rnd.normal(size=6)] for i in range(300)}
    vectors |= {i: [0.5] * 6 for i in range(300, 420)}
    vectors |= {420: None, 421: [1.0, None], 422: [float("nan")] * 6, 423: [float("inf")] * 6, 424: [], 425: [1.0, 2.0], 426: [3.0, -1.0], 450: [0.0] * 6}
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()] + [(None, [1.0] * 6, 1)], "vec_id long, embedding array<float>, shard int")
    floats = {i: None if v is None else [None if c is None else float(np.float32(c)) for c in v] for i, v in vectors.items()}
    ask = [i for i in vectors if i % 25 == 0]
    got = {tuple(r) for r in mtree.top_k(df, df.where("vec_id % 25 = 0")).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == plain_top(floats, ask, 5)
    assert mtree.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("repeats", [2, 6, 9])
def test_top_k_of_a_query_id_that_repeats(spark, repeats):
    others = {i: [float(i)] * 4 for i in range(1, 13)}
    df = spark.createDataFrame([(0, [99.0] * 4)] * repeats + list(others.items()), "vec_id long, embedding array<float>")
    got = {tuple(r) for r in mtree.top_k(df, df.where("vec_id = 0").limit(1)).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == {(0, r, 13 - r, 4 * 256 * 256 * 99 * (13 - r)) for r in range(1, 6)}


def test_search_leaves_computations_out(spark, small):
    rnd = np.random.default_rng(2)
    clustered = np.concatenate([rnd.integers(-5, 5, (2000, 8)) + c for c in rnd.integers(-400, 400, (20, 8))])
    given = spark.read.parquet(f"{small}/embeddings.parquet").where("embedding is not null").collect()
    given = np.floor(256 * np.array([r.embedding for r in given], np.float64)).astype(np.int64)
    for name, exact, most in (("clustered", clustered, 0.5), ("given", given, 1.0)):
        ids = np.arange(len(exact))
        tree, counter = mtree.build(exact, ids), [0]
        asked = range(0, len(exact), len(exact) // 10)
        for q in asked:
            found = mtree.search(tree, exact[q], q, 5, counter)
            best = np.lexsort((ids, -(exact @ exact[q])))
            assert [i for _, i in found] == [i for i in best if i != q][:5]
        share = counter[0] / len(asked) / len(exact)
        print(f"{name}: {share:.4f} of all scores computed")
        assert share <= most


def test_pages_hold_their_members():
    exact = np.random.default_rng(3).integers(-99, 99, (3000, 5))
    t = mtree.build(exact, np.arange(3000))
    below = [None] * len(t.leaf)
    for n in range(len(t.leaf) - 1, -1, -1):
        below[n] = np.arange(t.lo[n], t.hi[n]) if t.leaf[n] else np.concatenate([below[c] for c in range(t.lo[n], t.hi[n])])
        d = np.sqrt(((t.x[below[n]] - t.x[t.pivot[n]]) ** 2).sum(1))
        assert t.pivot[n] in below[n] and d.max() == pytest.approx(t.radius[n])
    assert sorted(below[0]) == list(range(3000)) and (exact[t.ids] == t.exact).all()


@pytest.mark.parametrize("size", [1 << 20, 1 << 28, 1 << 31])
def test_scores_of_large_integers_are_exact(size):
    rnd = np.random.default_rng(5)
    exact = rnd.integers(-size, size, (600, 4))
    tree, q = mtree.build(exact, np.arange(600)), exact[0]
    want = sorted(((-sum(int(a) * int(b) for a, b in zip(v, q)), i) for i, v in enumerate(exact) if i))[:5]
    assert mtree.search(tree, q, 0, 5) == [(-s, i) for s, i in want]
    big = np.full((3, 4), (1 << 62), np.int64)
    with pytest.raises(OverflowError):
        mtree.search(mtree.build(big, np.arange(3)), big[0], 0, 5)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (1, 0), (200, 201), (200, 201), (None, 5)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components.connected_components(df.limit(0)).count() == 0


def link(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


PAGES = [
    (1, "http://a.org/x", link("http://bad.net/y"), "block", "alias"),
    (2, "HTTP://A.org/x?q#f", None, "allow", "default"),
    (3, "http://b.org/1", '<META http-equiv=refresh content="0; url=http://a.org/x">', "block", "alias"),
    (4, "http://www.example.net/en/1", link("http://bad.net/y"), "allow", "rule"),
    (5, "http://example.com/de/z", link("/other"), "block", "rule"),
    (6, "http://example.com/other", "", "block", "alias"),
    (7, "http://good.org/fr/1", link("//good.org/z"), "allow", "rule"),
    (8, "http://good.org/z", link("http://q.net/"), "allow", "alias"),
    (9, None, link("http://bad.net/"), "allow", "default"),
    (10, "no scheme", "x", "allow", "default"),
    (11, "http://bad.net", "", "allow", "default"),
    (12, "http://bad.net/?a", "", "block", "rule"),
    (None, "http://x.org/a", "", "allow", "default"),
    (1, "http://a.org/x", link("http://bad.net/y"), "block", "alias"),
]


def test_url_verdicts(spark):
    # Page 4 is allowed by its own rule and shares a class with pages 1 and 3, so its allow goes before the block there.
    want = [(i, "allow" if u in ("http://a.org/x", "http://b.org/1") else v, h) for i, u, _, v, h in PAGES]
    df = spark.createDataFrame([(i, u, x, "c") for i, u, x, _, _ in PAGES], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.verdict, r.how) for r in redirects.verdicts(df, queries.RULES).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    rest = df.where("page_id is null or page_id != 4")
    assert {r.page_id: r.verdict for r in redirects.verdicts(rest, queries.RULES).collect()}[3] == "block"
    assert redirects.verdicts(df.limit(0), queries.RULES).count() == 0
    log = spark.createDataFrame([("http://x.org/a", "http://bad.net/q")], "u string, v string")
    assert {r.page_id: r.verdict for r in redirects.verdicts(df, queries.RULES, log).collect()}[None] == "block"


def test_canonical_forms_and_relative_targets(spark):
    same = ["https://www.a.org/x/1", "http://a.org/x/1#top", "http://A.org/x/1?utm_source=feed", "https://a.org/x/1.html", "http://a.org/x/1/?ref=x&gclid=3", "http://a.org/x/1/index.html"]
    other = ["http://a.org/x/1?page=2&ref=x", "http://a.org/x/2", "http://m.a.org/x/1"]
    df = spark.createDataFrame([(u,) for u in same + other], "url string")
    got = [r[0] for r in df.select(redirects.canonical_of(redirects.node_of(F.col("url")))).collect()]
    assert set(got[: len(same)]) == {"http://a.org/x/1"} and got[len(same) :] == ["http://a.org/x/1?page=2", "http://a.org/x/2", "http://m.a.org/x/1"]
    from urllib.parse import urljoin

    urls = ["http://h.net/a/b/c?q#f", "http://h.net", "http://h.net/", "https://h.net/a"]
    targets = ["page2.html", "../x", "../../../x/./y", "./", "..", "?p=1", "/r/../s", "//o.org/z", "http://p.org/", "x/y/"]
    df = spark.createDataFrame([(u, t) for u in urls for t in targets], "url string, target string")
    for r in redirects.resolved(df, "target", "url", "got").collect():
        assert r.got == urljoin(r.url, r.target), r
    none = spark.createDataFrame([("http://h.net/a", "#x"), ("http://h.net/a", "mailto:x"), ("nothing", "x"), ("http://h.net/", "")], "url string, target string")
    assert [r.got for r in redirects.resolved(none, "target", "url", "got").collect()] == [None] * 4


def test_links_in_markup(spark):
    pages = [
        ("http://a.org/1/", '<link href="two words" rel="alternate canonical">', "http://a.org/1/two words"), ("http://a.org/2", "<!-- <link rel=canonical href=/no> -->", None),
        ("http://a.org/3", "<link rel=canonical data-href=/no href='/yes?a=1&amp;b=2'>", "http://a.org/yes?a=1&b=2"), ("http://a.org/4", "<base href=http://b.org/c/><LINK REL=Canonical HREF=d>", "http://b.org/c/d"),
        ("http://a.org/5", "<meta http-equiv='Refresh' content='3;URL=../e'>", "http://a.org/e"), ("http://a.org/6", "<link rel=stylesheet href=/no><meta charset=utf-8>", None),
    ]
    df = spark.createDataFrame([p[:2] for p in pages], "url string, html string")
    assert {(r.u, r.v) for r in redirects.edges_of(df).collect()} == {(u, v) for u, _, v in pages if v}


def test_url_classes_of_random_pages(spark):
    """Against a plain walk over links and canonical forms: verdicts of classes, with an allow before a block."""
    rnd = np.random.default_rng(6)
    hosts, forms = ["www.x.com", "x.com", "q.net", "example.net", "z.org", "example.com"], ["{}", "{}#top", "{}?utm_source=feed", "{}.html", "{}/", "{}?page=2&ref=x"]
    url = lambda: f"http{'s' * int(rnd.integers(0, 2))}://" + str(rnd.choice(hosts)) + str(rnd.choice(["/en/", "/de/", "/fr/", "/"])) + str(rnd.choice(forms)).format(rnd.integers(0, 8))
    rows = [(i, url(), link(url()) if rnd.random() < 0.15 else "<p>") for i in range(250)]
    bare = lambda u: u.split("#")[0]

    def form(u):
        base, _, query = bare(u).partition("?")
        base = re.sub(r"((/index)?\.html?)?/*$", "", re.sub(r"^https?://(www\.)?", "http://", base), count=1)
        query = "&".join(x for x in query.split("&") if x and not re.match(redirects.TRACKING, x))
        return base + ("?" + query if query else "")

    near = defaultdict(set)
    for _, u, html in rows:
        ends = [bare(u), form(u), *(x for v in re.findall('href="([^"]*)"', html) for x in (bare(v), form(v)))]
        for a, b in [(ends[0], ends[1]), *([(ends[0], ends[2]), (ends[2], ends[3])] if len(ends) > 2 else [])]:
            near[a].add(b)
            near[b].add(a)

    def rule(u):
        host, path = re.match(r"[a-z]+://([^/?#]*)([^?#]*)", u).groups()
        fits = [(len(h + p), a) for a, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    want = {}
    for i, u, _ in rows:
        seen, todo = {bare(u)}, [bare(u)]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        carried = {rule(x) for x in seen}
        want[i] = rule(u) or ("allow" if "allow" in carried else "block" if "block" in carried else "allow")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in redirects.verdicts(df, queries.RULES).collect()}
    assert {i: r.verdict for i, r in got.items()} == want
    assert sum(r.how == "alias" for r in got.values()) > 10


def test_hosts_and_paths(spark):
    urls = [("https://M.Ex.Net/en/25#top", "m.ex.net", "/en/25"), ("a://b?c/d", "b", ""), ("x://y/z://w", "y", "/z://w"), ("none", "", ""), (None, "", "")]
    df = spark.createDataFrame([(u,) for u, _, _ in urls], "url string")
    assert [tuple(r) for r in df.select(redirects.host_of(F.col("url")), redirects.path_of(F.col("url"))).collect()] == [(h, p) for _, h, p in urls]


def test_queries_of_all_shards_are_no_broadcast(spark, monkeypatch):
    """F1 of round 4: each block of queries goes to each shard, by a shuffle; as a broadcast all of that would pass through the driver."""
    for name, n in (("SHARD", 40), ("QUERIES", 5), ("SPAN", 2)):
        monkeypatch.setattr(mtree, name, n)
    rnd = np.random.default_rng(6)
    vectors = {i: [float(x) for x in rnd.integers(-2, 3, 4)] for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    found = mtree.top_k(df, df.where("vec_id % 8 = 0"))
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == plain_top(vectors, [i for i in vectors if i % 8 == 0], 5)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size, scale", [(0, 9), (3, 2), (8, 400), (4, 1 << 29)])
def test_a_block_of_queries_finds_what_each_alone_would(size, scale):
    rnd = np.random.default_rng(7)
    exact, ids = rnd.integers(-scale, scale, (1500, size)), rnd.permutation(1500) // 2  # an id stands twice
    tree = mtree.Tree.unpacked(mtree.build(exact, ids).packed())
    asked, own = exact[::30], ids[::30]
    for k in (1, 5, 2000):
        row, scores, found = mtree.search_all(tree, asked, own, k)
        for n, (q, me) in enumerate(zip(asked, own)):
            best = sorted((-sum(int(a) * int(b) for a, b in zip(v, q)), int(i)) for v, i in zip(exact, ids) if i != me)[:k]
            assert list(zip((-scores[row == n]).tolist(), found[row == n].tolist())) == best
