"""Tables with a ledger, Bloom states, folders, documents of differing keys, sweeps, state machines and streams, against plain versions."""

import glob
import hashlib
import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from edutide.functions import scalars
from edutide.operators import aggregate, bloom, facts, joins, ordering, products, recommend, workflow
from edutide.sources import files, layout, variants
from edutide.sources.shared import shared_folder, stored
from edutide.sources.versioned import VersionedTable
from edutide.streaming import windows


def test_running_totals_without_one_task(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, *"abcdef"]), rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, s string, n long")
    got = {r.i: (r._place, r.before) for r in ordering.running(df, [F.col("s").asc_nulls_last(), F.col("i").asc()], {"before": "n"}, 7).collect()}
    total, want = 0, {}
    for place, (i, _, n) in enumerate(sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0])), 1):
        want[i] = (place, total)
        total += n
    assert got == want


def plain_places(value, bits):
    d = hashlib.md5(value.encode()).hexdigest()
    a, b = int(d[:15], 16), int(d[15:30], 16)
    return [(a + i * b) % bits for i in range(bloom.HASHES)]


def test_bloom_states_merge_in_any_order_and_twice(spark):
    rnd = random.Random(2)
    rows = [(k, kind, f"v{rnd.randint(0, 400)}", rnd.randint(0, 2)) for k in ("a", "b") for kind in bloom.SIZES for _ in range(300)] + [("a", "DAY", None, 0)]
    df = spark.createDataFrame(rows, "k string, kind string, v string, batch int")

    def state(order):
        out = None
        for b in order:
            out = stored(bloom.inserted(df.where(F.col("batch") == b), ["k", "kind"], "v", bloom.size_of(F.col("kind")), out, "n"), "state")
        return {(r.k, r.kind): (r.n, {b: bytes(x) for b, x in r.n_bits.items()}, r.bits) for r in out.withColumn("bits", bloom.bits_set(F.col("n_bits"))).collect()}

    one = state([0, 1, 2])
    for other in ([2, 0, 1], [0, 1, 2, 1, 0, 2]):
        assert {k: v[1] for k, v in state(other).items()} == {k: v[1] for k, v in one.items()}
    assert state([0, 1, 2, 1, 0, 2]) == one
    for (k, kind), (n, maps, bits) in one.items():
        size, seen, count = bloom.SIZES[kind], set(), 0
        for b in range(3):
            own = {v for x, y, v, c in rows if (x, y, c) == (k, kind, b) and v}
            count += sum(not set(plain_places(v, size)) <= seen for v in own)
            seen |= {p for v in own for p in plain_places(v, size)}
        assert (n, bits) == (count, len(seen))
        assert {(b - 1) * bloom.BITMAP + i for b, x in maps.items() for i in range(8 * len(x)) if x[i // 8] >> (i % 8) & 1} == seen


def test_tables_rewrite_only_what_a_batch_touches(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["day"])
    add = lambda new, old: (new if old is None else new.unionByName(old)).groupBy("day", "k").agg(F.sum("n").alias("n"))
    rows = lambda *x: spark.createDataFrame(list(x), "day string, k string, n long")
    assert table.read() is None and table.batches() == []
    assert table.apply("a", rows(("1", "x", 1), ("2", "x", 5), (None, "y/=", 2)), add)
    assert table.apply("b/2", rows(("1", "x", 10), ("3", "z", 1)), add)
    assert not table.apply("a", rows(("1", "x", 100)), add)
    want = {("1", "x", 11), ("2", "x", 5), ("3", "z", 1), (None, "y/=", 2)}
    assert {tuple(r) for r in table.read().collect()} == want and table.batches() == ["a", "b/2"]
    assert sorted(table._versions()) == ["_day=1", "_day=2", "_day=3", "_day=__HIVE_DEFAULT_PARTITION__"]
    assert sum("/a/" in v for v in table._versions().values()) == 2  # days 2 and none were not written again
    with pytest.raises(Exception, match="no such thing"):
        table.apply("c", rows(("1", "x", 1)), lambda new, old: new.withColumn("n", F.raise_error(F.lit("no such thing")).cast("long")))
    assert {tuple(r) for r in table.read().collect()} == want
    assert table.vacuum() >= 1 and {tuple(r) for r in table.read().collect()} == want
    assert table.apply("c", rows(("1", "x", 1)), add) and table.read().where("day = '1'").first()["n"] == 12


def test_facts_of_two_batches_are_those_of_one(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(1704067200000 + rnd.randint(0, 40) * 86_400_000, f"c{rnd.randint(0, 3)}", f"u{rnd.randint(0, 30)}", rnd.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "ets long, c string, u string, n long").withColumn("l", F.array("u"))
    kind = facts.Facts(["c"], {"n": "sum", "l": "list"}, {"users": "u"})
    one, two = (facts.fact_table(spark, str(tmp_path / x)) for x in ("one", "two"))
    kind.add(one, "all", df)
    for b, w in (("a", "n < 5"), ("b", "n >= 5"), ("b", "n >= 5")):
        kind.add(two, b, df.where(w))
    shown = lambda t: {(r.kind, r.period, r.c): (r.n, r.l, {b: bytes(x) for b, x in r.users_bits.items()}) for r in t.read().collect()}
    assert shown(one) == shown(two) and len(shown(one)) > 40
    top = {r.c: r.users for r in one.read().where("kind = 'CUMULATIVE'").collect()}
    assert top == {c: len({u for _, x, u, _ in rows if x == c}) for c in top}


def test_facts_spread_rows_late_and_sort_no_bits(spark, tmp_path):
    """A batch is stored with a row a row, and bits meet in a hash aggregate; values and totals are those of rows spread before."""
    rnd = random.Random(5)
    rows = [(1704067200000 + rnd.randint(0, 40) * 86_400_000, rnd.choice(["c0", "c1", None]), rnd.choice([f"u{rnd.randint(0, 40)}", None]), rnd.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "ets long, c string, u string, n long").withColumn("v", F.col("c"))
    plain = facts.Facts(["c"], {"n": "sum"}, {"users": "u", "own": "v"})
    kind = facts.Facts(["c"], {"n": "sum"}, {"users": "u", "own": "c"}, totals={"c": "all"})
    one, two = (facts.fact_table(spark, str(tmp_path / x)) for x in ("one", "two"))
    before = set(glob.glob(f"{shared_folder(spark)}/edutide/batch-*"))
    for b, w in (("a", "n < 5"), ("b", "n >= 5")):
        kind.add(two, b, df.where(w))
    stored_rows = sum(spark.read.parquet(f).count() for f in set(glob.glob(f"{shared_folder(spark)}/edutide/batch-*")) - before)
    for b, w in (("a", "n < 5"), ("b", "n >= 5")):
        plain.add(one, b, df.where(w).withColumn("c", F.explode(F.array("c", F.lit("all")))))
    shown = lambda t: {(r.kind, r.period, r.c): (r.n, r.users, r.own, *({b: bytes(x) for b, x in m.items()} for m in (r.users_bits, r.own_bits))) for r in t.read().collect()}
    assert shown(one) == shown(two) and len(shown(two)) > 100
    assert stored_rows == len(rows)
    values = facts.by_period(df, ["c", "u"])
    made = bloom.inserted(values, ["kind", "period", "c"], "u", bloom.size_of(F.col("kind")), None, "users")
    assert "bitmap_construct_agg" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_dated_scans_open_only_the_files_they_need(spark, small, tmp_path):
    events, path = spark.read.parquet(f"{small}/events.parquet"), str(tmp_path / "dated")
    layout.write_dated(events, path, F.col("ts"), also=("event_type",))
    found = layout.scan_dated(spark, path, events.schema, "2024-01-10", delta_days=2, also=("event_type",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    days = {r[0] for r in found.select(F.regexp_extract(F.input_file_name(), "dt=([0-9-]+)", 1)).distinct().collect()}
    assert days == {"2024-01-08", "2024-01-09", "2024-01-10"}
    assert found.count() == events.where("cast(ts as date) between '2024-01-08' and '2024-01-10'").count()
    scanned = found.select("event_id")
    scanned.collect()
    node = scanned._jdf.queryExecution().executedPlan().toString()
    assert "event_id" in node
    kept = layout.scan_dated(spark, path, events.schema, "2024-01-10", start="2024-01-10", exclude="event_type=view", also=("event_type",))
    assert kept.count() == events.where("cast(ts as date) = '2024-01-10' and event_type != 'view'").count() > 0
    assert layout.scan_dated(spark, path, events.schema, "1999-01-01", also=("event_type",)).count() == 0
    today = str(spark.range(1).select(F.current_date()).first()[0])
    assert layout.scan_dated(spark, path, events.schema, today, created=today, also=("event_type",)).count() in (0, events.count())
    assert layout.scan_dated(spark, path, events.schema, today, created="1999-01-01", also=("event_type",)).count() == 0


def test_named_reports_appear_whole_or_not_at_all(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "a", "z"), (3, "b", "x y"), (4, None, "z")], "k int, s string, t string")
    path = str(tmp_path / "report")
    assert sorted(layout.write_named(df, path, ["s", "t"])) == ["a/x y.csv", "a/z.csv", "b/x y.csv", "null/z.csv"]
    made = layout.manifest(spark, path).collect()
    assert {r.file: r.rows for r in made} == {"a/x y.csv": 1, "a/z.csv": 1, "b/x y.csv": 1, "null/z.csv": 1}
    assert {r.file: r.bytes for r in made} == files.files(spark, path)
    back = spark.read.schema("k int, s string, t string").option("header", True).option("recursiveFileLookup", True).csv(path)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    with pytest.raises(Exception, match="broken"):
        layout.write_named(df.withColumn("k", F.when(F.col("k") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("k"))), path, ["s"])
    assert sorted(files.files(spark, path)) == sorted(r.file for r in made)
    assert layout.write_named(df.where("k < 3"), path, ["s"]) == ["a.csv"] and sorted(files.files(spark, path)) == ["a.csv"]
    layout.write_named(df.limit(0), path, ["s"])
    assert layout.manifest(spark, path).agg(F.sum("rows")).first()[0] in (0, None)


def test_documents_of_differing_keys(spark):
    texts = ['{"a": 1, "b": {"c": "x", "d": [1, 2]}}', '{"a": 2.5, "e f": true}', '{"b": {"c": null, "g": {"h": "y"}}}', "{broken", None, '{"b": 7}']
    df = spark.createDataFrame(list(enumerate(texts[:5])), "i int, t string").select("i", variants.parsed(F.col("t")).alias("v"))
    out = variants.flatten(df, "v", ("i",), hidden=("b.g.h",), renamed={"b.c": "c"}, mapped={"b.c": F.upper})
    assert out.columns == ["i", "a", "c", "b.d", "e f"]
    got = {r[0]: (None if r[1] is None else float(r[1]), *r[2:]) for r in out.collect()}
    assert got == {0: (1.0, "X", "[1,2]", None), 1: (2.5, None, None, True), 2: (None, None, None, None), 3: (None,) * 4, 4: (None,) * 4}
    mixed = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", variants.parsed(F.col("t")).alias("v"))
    assert variants.flatten(mixed, "v", ("i",)).where("i = 5").select("b").first()[0] == "7"
    assert variants.flatten(df.limit(0), "v", ("i",)).columns == ["i"]


@pytest.mark.parametrize("parts, held", [(1, 1 << 16), (9, 50)])
def test_range_join_of_wide_ranges_and_a_hot_point(spark, parts, held):
    rnd = random.Random(4)
    points = [(i, 777 if i % 3 == 0 else rnd.randint(-2000, 2000)) for i in range(400)] + [(1000, None)]
    ranges = [(f"r{i}", (s := rnd.randint(-2100, 2100)), s + rnd.choice([0, 3, 40, 900])) for i in range(60)]
    ranges += [("all", -(1 << 40), 1 << 40), ("hot", 777, 777), ("none", 5, 4), ("null", None, 9)]
    p, r = spark.createDataFrame(points, "i long, x long"), spark.createDataFrame(ranges, "name string, s long, e long")
    got = Counter((a.i, a.name) for a in joins.range_join(p, "x", r, "s", "e", parts, held).collect())
    want = Counter((i, n) for i, x in points for n, s, e in ranges if x is not None and s is not None and s <= x <= e)
    assert got == want
    assert joins.range_join(p.limit(0), "x", r, "s", "e", parts).count() == joins.range_join(p, "x", r.limit(0), "s", "e", parts).count() == 0


def test_wide_ranges_are_not_laid_into_buckets(spark):
    points, ranges = spark.range(2000).select(F.col("id").alias("x")), spark.range(3).select(F.lit(-(1 << 60)).alias("s"), F.lit(1 << 60).alias("e"), "id")
    plan = joins.range_join(points, "x", ranges, "s", "e", 8)
    assert plan.count() == 6000


def plain_workflow(rows):
    out = []
    by = defaultdict(list)
    for r in rows:
        if r[5] not in workflow.SKIPPED:
            by[r[:3]].append(r)
    for key, own in by.items():
        tree = workflow.Tree(600_000, 30 * 60_000)
        for _, _, _, _, ets, eid, type_, mode in sorted(own, key=lambda r: (r[4], r[3])):
            tree.row(eid, ets, type_ or "", mode or "")
        out += [(*key, *x) for x in tree.end()]
    return set(out)


@pytest.mark.parametrize("n, held", [(10_000, 1024), (700, 1)])
def test_workflow_streams_through_long_keys(spark, n, held):
    rnd = random.Random(5)
    rows, at = [], 0
    for i in range(n):
        at += rnd.choice([0, 500, 2000, 30_000, 700_000, 2_000_000]) if rnd.random() < 0.3 else rnd.randint(0, 3000)
        rows.append((f"d{0 if i % 4 else i % 7}", "c", "a", i, at, rnd.choice(["START", "END", "INTERACT", "IMPRESSION", "LOG"]), rnd.choice(["app", "session", "content", "Content", None]), rnd.choice(["", "play", None])))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "did string, channel string, app string, mid long, ets long, eid string, content string, page string")
    got = [tuple(r) for r in workflow.workflow(df, held=held).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_workflow(rows)


def test_the_tree_holds_open_nodes_only():
    tree, most = workflow.Tree(600_000, 1_800_000), 0
    for i in range(20_000):
        tree.row(("START", "INTERACT", "END")[i % 3], i * 1000, f"t{i % 5}", "")
        most = max(most, len(tree.root.below) if tree.root else 0)
        tree.taken()
    assert most <= 5


def plain_murmur(text):
    turn = lambda x, n: (x << n | x >> (32 - n)) & 0xFFFFFFFF
    raw = text.encode("utf-16-be")
    units = [int.from_bytes(raw[i : i + 2], "big") for i in range(0, len(raw), 2)]
    last = lambda h, d: h ^ turn(d * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h = 0xF7CA7FD2
    for i in range(0, len(units) - 1, 2):
        h = (turn(last(h, ((units[i] << 16) + units[i + 1]) & 0xFFFFFFFF), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if len(units) % 2:
        h = last(h, units[-1])
    h ^= len(units)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def test_string_hashes(spark, small):
    rnd = random.Random(6)
    texts = ["", "a", "ab", "abc", "é😀x", "😀"] + ["".join(rnd.choice("abcdefgh0123é") for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = df.select("t", scalars.string_hash(F.col("t")).alias("h"), scalars.in_modulus(F.col("t"), 3).alias("m"), scalars.in_modulus(F.col("t"), 0).alias("z")).collect()
    assert all(r.h == (None if r.t is None else plain_murmur(r.t)) and r.m == (r.t is not None and plain_murmur(r.t) in range(1 << 32) and (plain_murmur(r.t) - (plain_murmur(r.t) >> 31 << 32)) % 3 == 0) and not r.z for r in got)
    from edutide.plans import basics, products as plans

    chosen = basics.QUERIES["c12_modulus"](spark, small).collect()
    signed = lambda t: plain_murmur(t) - (plain_murmur(t) >> 31 << 32)
    assert {r["chosen"] for r in chosen} == {True, False} and all(r["chosen"] == (signed(r["did"]) % 3 == 0) for r in chosen)
    users = {r[0] for r in basics.events(spark, small).select("uid").distinct().collect()}
    assert {r[0] for r in plans.QUERIES["m14_experiment_modulus"](spark, small).collect()} == {u for u in users if signed(u) % 4 == 0}


def test_custom_aggregates(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 99)) for _ in range(500)]
    median = aggregate.Custom(Counter, lambda s, r: s + Counter(r["n"].tolist()), lambda a, b: a + b, lambda s: (float(statistics.median(s.elements())), sum(s.values())), "median double, rows long")
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    for held in (0, 1000):
        got = {r.k: (r.median, r.rows) for r in aggregate.by(df, ["k"], median, held).collect()}
        assert got == {k: (float(statistics.median([n for x, n in rows if x == k])), sum(x == k for x, _ in rows)) for k in ("a", "b", None)}
    assert aggregate.by(df.limit(0), ["k"], median).count() == 0


def test_products_count_while_they_run(spark, tmp_path):
    kept = products.Registry()
    kept.add(products.Product("p", lambda i, c: {"a": i["a"].where(F.col("id") < c["most"])}, lambda i, c: i["a"].where("id % 2 = 0"), lambda df: df.write.parquet(str(tmp_path / "p"))))
    ran = kept.run("p", {"a": spark.range(10)}, {"most": 7})
    assert (ran.rows_in, ran.rows_out) == ({"a": 7}, 4) and spark.read.parquet(str(tmp_path / "p")).count() == 4
    with pytest.raises(ValueError):
        kept.add(kept.products["p"])


def test_similarity_by_one_greatest_distance(spark):
    chain = [(i, i + 1) for i in range(9)]
    for edges in (chain, chain[:3], [(0, 1), (5, 6)]):
        both = spark.createDataFrame(edges + [(b, a) for a, b in edges], "u long, v long")
        nodes = sorted({x for e in edges for x in e})
        far = {(a, b): 0 if a == b else 6 for a in nodes for b in nodes}
        for a in nodes:
            todo, seen = [(a, 0)], {a}
            while todo:
                x, d = todo.pop(0)
                far[a, x] = min(d, 6)
                for u, v in edges + [(b, c) for c, b in edges]:
                    if u == x and v not in seen:
                        seen.add(v)
                        todo.append((v, d + 1))
        most = max(far.values())
        want = {k: 1 - d / most for k, d in far.items()}
        got = {(r.source, r.node): r.similarity for r in recommend.similar_by_distance(both, both.select("u")).collect()}
        assert {k: v for k, v in want.items() if v > 0 or k in got} == pytest.approx(got)


def test_relevance_is_that_of_dense_matrices(spark):
    rnd = np.random.default_rng(8)
    names = [f"c{i}" for i in range(5)]
    sim = {(names[i], names[j]): float(rnd.random()) for i in range(5) for j in range(5) if rnd.random() < 0.4}
    rows = [(u, c, float(rnd.random()) if rnd.random() < 0.6 else None, float(rnd.integers(0, 50)) if rnd.random() < 0.6 else None) for u in ("x", "y") for c in names if rnd.random() < 0.8]
    rows += [("x", "other", 0.9, 3.0)]
    got = {(r.learner, r.concept): r.relevance for r in recommend.relevance(names, spark.createDataFrame([(*k, w) for k, w in sim.items()], "i string, j string, w double"), spark.createDataFrame(rows, "learner string, concept string, proficiency double, time double")).collect()}
    norm = lambda m: m / m.sum(1, keepdims=True)
    w = np.array([0.33, 0.33, 0.33, 1.0]) / 1.99
    for u in ("x", "y"):
        p = {c: q for x, c, q, _ in rows if x == u and q is not None}
        t = {c: q for x, c, _, q in rows if x == u and q is not None}
        pi = np.array([p.get(c, 0.0) for c in names])
        gap = pi[:, None] - pi[None, :]
        s = np.array([[sim.get((a, b), 0.001) for b in names] for a in names])
        time = np.tile([t.get(c, 0.2) for c in names], (5, 1))
        boost = np.tile([1.0 if p.get(c, -1.0) > 0 else 0.01 for c in names], (5, 1))
        m = w[0] * norm(s) + w[1] * norm(np.where(gap <= 0, 0.0001, gap)) + w[2] * norm(time) + w[3] * norm(boost)
        r = np.full(5, 0.2)
        for _ in range(5):
            r = r @ m
        assert [got[u, c] for c in names] == pytest.approx(r.tolist())


def _arrive(spark, rows, path, schema="event_id long, user_id long, ts timestamp, event_type string, value double"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_state_falls_as_the_watermark_passes(spark, tmp_path):
    from datetime import datetime, timedelta

    from edutide.plans import streams

    zero, path = datetime(2024, 1, 1), str(tmp_path / "in")
    rows = lambda day: [(day * 100 + i, i % 3, zero + timedelta(days=day, hours=i % 24), "view", 1.0) for i in range(48)]
    table, states = VersionedTable(spark, str(tmp_path / "t"), ["day"]), []
    for day in range(4):
        _arrive(spark, rows(day), path)
        source = streams.source(spark, spark.createDataFrame([], "event_id long, user_id long, ts timestamp, event_type string, value double"), path)
        counted = windows.by_time(source, "1 hour", late="1 hour", keys=["event_type"]).withColumn("day", F.date_format("start", "yyyyMMdd"))
        ran = streams.run(counted, str(tmp_path / "c"), "update", windows.upsert(table, ["day", "start", "event_type"]))
        states.append(ran.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(states) <= 30 and table.read().agg(F.sum("n")).first()[0] == 4 * 48 and table.read().count() == 96
    touched = {b: {v.rsplit("=", 1)[1] for v in table._versions().values() if f"/{b}/" in v} for b in table.batches()}
    assert all(len(days) <= 1 for days in touched.values())


def test_sessions_of_any_chunks_and_after_a_restart(spark, tmp_path):
    from datetime import datetime, timedelta

    from edutide.plans import streams

    rnd = random.Random(9)
    zero, at, rows = datetime(2024, 1, 1), 0.0, []
    for i in range(600):
        at += rnd.choice([1, 60, 1799, 1800, 1801, 4000]) if rnd.random() < 0.3 else rnd.randint(0, 90)
        rows.append((i, rnd.randint(1, 4), zero + timedelta(seconds=at), rnd.choice(["signup", "view", "click", "purchase"]), 1.0))
    want, open_ = Counter(), {}
    for _, user, ts, kind, _ in rows:
        ms = int((ts - zero).total_seconds() * 1000)
        n, first, last = open_.get(user, (0, 0, 0))
        if n and ms - last > 1_800_000:
            want[user, n, first, last, "pause"] += 1
            n = 0
        if n and kind == "signup":
            want[user, n, first, last, "start"] += 1
            n = 0
        open_[user] = (n + 1, first if n else ms, ms)
        if kind == "purchase":
            want[user, *open_.pop(user), "end"] += 1
    want += Counter((user, *s, "pause") for user, s in open_.items())
    path, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "event_id long, user_id long, ts timestamp, event_type string, value double"
    with streams.state_store(spark, windows.ROCKSDB):
        for part in (rows[:150], rows[150:151], rows[151:400], rows[400:], [(-1, -1, zero + timedelta(days=30), "beat", 0.0)]):
            _arrive(spark, part, path)
            result = windows.start_end_sessions(streams.source(spark, spark.createDataFrame([], schema), path))
            streams.run(result, str(tmp_path / "c"), "append", out)
    base = 1704067200000
    got = Counter((r.user_id, r.n, r.first_ms - base, r.last_ms - base, r.closed_by) for r in spark.read.parquet(out).where("user_id > 0").collect())
    assert got == want


def test_sessions_of_many_keys_in_few_buckets(spark, tmp_path):
    """state is kept, and called for, by bucket and not by key; a key may be null."""
    from datetime import datetime, timedelta

    from edutide.plans import streams

    zero = datetime(2024, 1, 1)
    users = [None, *range(59)]
    rows = [(i, users[i % 60], zero + timedelta(seconds=10 * i), "view", 1.0) for i in range(240)]
    rows += [(1000 + i, u, zero + timedelta(hours=5, seconds=i), "purchase" if i % 2 else "signup", 1.0) for i, u in enumerate(users)]
    path, out, schema, sizes = str(tmp_path / "in"), str(tmp_path / "out"), "event_id long, user_id long, ts timestamp, event_type string, value double", []
    with streams.state_store(spark, windows.ROCKSDB):
        for part in (rows[:130], rows[130:240], rows[240:] + [(-1, -1, zero + timedelta(days=30), "beat", 0.0)]):
            _arrive(spark, part, path)
            result = windows.start_end_sessions(streams.source(spark, spark.createDataFrame([], schema), path), buckets=4)
            ran = streams.run(result, str(tmp_path / "c"), "append", out)
            sizes += [p["stateOperators"][0]["numRowsTotal"] for p in ran.recentProgress if p["stateOperators"]]
    base = 1704067200000
    got = Counter((r.user_id, r.n, r.first_ms - base, r.last_ms - base, r.closed_by) for r in spark.read.parquet(out).where("user_id is null or user_id >= 0").collect())
    late = 5 * 3_600_000
    want = Counter((u, 4, 10_000 * i, 10_000 * (i + 180), "pause") for i, u in enumerate(users))
    want += Counter((u, 1, late + 1000 * i, late + 1000 * i, "end" if i % 2 else "pause") for i, u in enumerate(users))
    assert got == want and 0 < max(sizes) <= 4


def test_parts_arrive_in_many_files_and_one_batch(spark, tmp_path):
    """a part is written by all tasks that read events, and taken as one micro-batch, none of whose rows is late."""
    from datetime import datetime, timedelta

    from edutide.plans import streams

    zero = datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, zero + timedelta(minutes=i * 7 % 4000), 1.0) for i in range(4000)], "event_id long, ts timestamp, value double").repartition(3)
    files = [len(list((tmp_path / "in").glob("*.parquet"))) for _ in streams.arrivals(events, str(tmp_path / "in"), 2)]
    assert files == [3, 6]
    table = VersionedTable(spark, str(tmp_path / "t"), ["day"])
    form = lambda rows: windows.by_time(rows, "1 hour", late="1 hour").withColumn("day", F.date_format("start", "yyyyMMdd"))
    streams.streamed(spark, events, form, "update", windows.upsert(table, ["day", "start"]))
    assert {(r.start, r.n) for r in table.read().collect()} == {(r.s, r.n) for r in events.groupBy(F.date_trunc("hour", "ts").alias("s")).agg(F.count("*").alias("n")).collect()}


def test_spaces_are_those_of_a_small_dense_svd(spark):
    from edutide.operators import vectors

    rnd = random.Random(12)
    groups = [["sun", "moon", "star", "sky"], ["bread", "milk", "salt", "soup"], ["road", "wheel", "car", "bridge"]]
    texts = [" ".join(rnd.choice(groups[i % 3]) for _ in range(12)) for i in range(45)] + [None, "", "unseen"]
    rows = vectors.bags(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "i", "t")
    model = vectors.lsa(rows.rows, 3)
    counts = np.zeros((len(texts), len(rows.model.vocabulary)))
    for i, t in enumerate(texts):
        for w in (t or "").split():
            if w in rows.model.vocabulary:
                counts[i, rows.model.vocabulary.index(w)] += 1
    x = counts * np.log((len(texts) + 1) / ((counts > 0).sum(0) + 1))
    x /= np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-300)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    assert model.values == pytest.approx(s[:3])
    got = {r.id: r.vector for r in model.transform(rows.rows).collect()}
    want = x @ v[:3].T
    for k in range(3):
        own = np.array([got[i][k] for i in range(len(texts))])
        assert abs(own @ want[:, k]) == pytest.approx(np.linalg.norm(own) * np.linalg.norm(want[:, k]))
    spaces = {"lsa": model.transform(rows.rows), "topics": vectors.topic_vectors(vectors.topics(rows.rows, 3, 30), rows.rows, 5), "words": vectors.mean_vectors(vectors.word_means(rows.rows, 8, 1), rows.rows)}
    for name, space in spaces.items():
        kept = {r.id: np.array(r.vector) for r in space.collect()}
        unit = {i: a / np.linalg.norm(a) for i, a in kept.items() if np.linalg.norm(a)}
        best = {q: max((i for i in unit if i != q), key=lambda i: (round(float(unit[q] @ unit[i]), 9), -i)) for q in range(0, 45, 5)}
        found = {r.query: r.id for r in vectors.nearest(space, spark.range(0, 45, 5)).collect()}
        assert set(found) == set(best) and all(float(unit[q] @ unit[found[q]]) == pytest.approx(float(unit[q] @ unit[i]), abs=1e-8) for q, i in best.items()), name
    assert {len(r.vector) for r in spaces["topics"].collect()} == {5}
    assert all(texts[i % 45] and found % 3 == q % 3 for q, found in {r.query: r.id for r in vectors.nearest(spaces["lsa"], spark.range(0, 45, 5)).collect()}.items() for i in (q,))


def test_vocabulary_is_that_of_counts(spark):
    """F2 of round 4: the most frequent words of several documents, in order where they are as frequent; words split once are as before."""
    from collections import Counter

    from edutide.operators import vectors

    rnd = random.Random(16)
    texts = [" ".join(f"w{chr(97 + min(int(rnd.expovariate(0.3)), 25))}" for _ in range(rnd.randrange(12))) for _ in range(60)] + ["only " * 500 + "once", "", None, "It's  a 'test-case', the 2nd; The END.", "\tx  yy\n", "für  über ab", " 12 "]
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)], "i long, t string")  # ids that stand twice are documents of their own
    old = F.filter(F.split(F.regexp_replace("t", "[^A-Za-z]", " "), r"\s+"), lambda w: (F.length(w) > 1) & ~w.isin(recommend.STOP_WORDS))
    old = F.when(F.col("t").rlike(r"^[\x00-\x7F]*$"), F.transform(old, F.lower)).otherwise(F.filter(F.split("t", " "), lambda w: w != ""))
    rows = df.select(recommend.words(F.col("t")).alias("words"), old.alias("old"))
    assert rows.where("NOT words <=> old").count() == 0
    listed = [r.words or [] for r in rows.collect()]
    n, documents = Counter(w for d in listed for w in d), Counter(w for d in listed for w in set(d))
    for least in (1, 2, 3):
        want = sorted((w for w in n if documents[w] >= least), key=lambda w: (-n[w], w))[:9]
        assert vectors.vocabulary_of(rows, 9, least) == want
    with pytest.raises(ValueError):
        vectors.bags(df.where("t = ''"), "i", "t")


def test_similar_pairs_in_shards(spark):
    rnd = np.random.default_rng(13)
    v = rnd.normal(size=(200, 4))
    df = spark.createDataFrame([(i, x[:2].tolist(), x[2:].tolist()) for i, x in enumerate(v)], "id long, text_vec array<double>, tag_vec array<double>")
    got = {(r.query, r["rank"]): r.id for r in joins.similar_pairs(df, df.where("id % 10 = 0"), 0.6, 3, 4, 17).collect()}
    score = 0.6 * v[:, :2] @ v[:, :2].T + 0.4 * v[:, 2:] @ v[:, 2:].T
    want = {(q, k + 1): int(i) for q in range(0, 200, 10) for k, i in enumerate([i for i in np.argsort(-score[q], kind="stable") if i != q][:3])}
    assert got == want


def test_nothing_is_found_again_for_each_component(spark):
    """what is in a lambda over components is found once for each, so a length or a map may not be named there."""
    df = spark.createDataFrame([([3.0, 4.0], [(0, 0.25), (3, 0.5)]), ([0.0, 0.0], []), (None, None)], "v array<double>, t array<struct<topic: int, share: double>>")
    found = df.select(recommend.normalised(F.col("v")).alias("v"), recommend.dense_topics(F.col("t"), 4).alias("t"))
    assert [(r.v, r.t) for r in found.collect()] == [([0.6, 0.8], [0.25, 0.0, 0.0, 0.5]), ([0.0, 0.0], [0.0] * 4), (None, [0.0] * 4)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and plan.count("map_from_entries(") == 1


def test_similar_pairs_with_ties_nulls_and_odd_lengths(spark):
    """products of matrices leave out nothing that a plain score would keep."""
    rnd = np.random.default_rng(14)
    v = [None if i % 17 == 3 else rnd.integers(-2, 3, 4 if i % 13 else 3).astype(float).tolist() for i in range(150)]
    v[20], v[40], v[41] = [1.0, None, 0.0, 2.0], [float("inf"), 0.0, 1.0, 0.0], [1e200, 1e200, -1e200, 0.0]
    df = spark.createDataFrame([(i, x, [0.5, float(i % 2)]) for i, x in enumerate(v)] + [(None, [1.0] * 4, [1.0, 1.0])], "id long, text_vec array<double>, tag_vec array<double>")

    def dot(a, b):
        return None if a is None or b is None or len(a) != len(b) or None in a or None in b else sum((x * y for x, y in zip(a, b)), 0.0)

    want = set()
    for q in range(0, 150, 10):
        scores = {i: dot(v[q], v[i]) for i in range(150) if i != q}
        scores = {i: None if s is None else 0.7 * s + (1 - 0.7) * (0.25 + (q % 2) * (i % 2)) for i, s in scores.items()}
        key = lambda i: (scores[i] is None, not (scores[i] is not None and scores[i] != scores[i]), -scores[i] if scores[i] is not None and scores[i] == scores[i] else 0.0, i)  # noqa: E731, B023
        want |= {(q, i, n + 1) for n, i in enumerate(sorted(scores, key=key)[:4])}
    assert {(r.query, r.id, r["rank"]) for r in joins.similar_pairs(df, df.where("id % 10 = 0"), 0.7, 4, 5, 40, 2).collect()} == want


def test_ranked_others_takes_what_pairs_would(spark):
    """without a pair of every asked row and every row of its group."""
    from pyspark.sql import functions as F

    rnd = random.Random(15)
    rows = [(rnd.randrange(60), rnd.choice("ab"), rnd.randrange(3), rnd.randrange(4)) for _ in range(300)] + [(None, "a", 1, 9), (5, None, 1, 1)]
    df = spark.createDataFrame(rows, "k long, brand string, bin int, x int")
    asked = df.where("k % 5 = 0").select(F.col("k").alias("asked"), "brand", "bin").distinct()
    by = [F.desc("x"), F.col("k")]
    pairs = recommend.ranked(df.join(asked, ["brand", "bin"]).where("k != asked"), "asked", by, 4)
    got = recommend.ranked_others(df, asked, "asked", "k", ["brand", "bin"], by, 4)
    shown = lambda found: sorted((r.asked, r.k, r["rank"]) for r in found.collect())
    assert shown(got) == shown(pairs)


def test_not_root_leaves_out_what_its_sql_does(spark, tmp_path):
    """customers from 1,000,000 on are not listed."""
    from edutide.plans import relations

    spark.createDataFrame([(i, f"c{i}", i % 3) for i in (1, 2, 3, 999_999, 1_000_000, 1_000_001)] + [(4, "c4", None)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(1, 30)] + [(99, None)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    c, s = spark.read.parquet(f"{tmp_path}/customer.parquet").withColumnRenamed("c_nationkey", "n"), spark.read.parquet(f"{tmp_path}/supplier.parquet").withColumnRenamed("s_nationkey", "n")
    kinds = [sorted((r.c_custkey, r.s_suppkey) for r in joins.dealt_join(c, s, "n", "c_custkey", 4, most).collect()) for most in (0, 100)]
    assert kinds[0] == kinds[1] == sorted((a, b) for a in (1, 2, 3, 999_999, 1_000_000, 1_000_001) for b in range(1, 30) if a % 3 == b % 3)
    got = sorted(tuple(r) for r in relations.QUERIES["j5_not_root"](spark, str(tmp_path)).collect())
    assert got == sorted((c, s) for c in (1, 2, 3, 999_999) for s in range(1, 30) if c % 3 == s % 3 and c != s)


def test_not_root_lists_customers_of_any_key(spark, tmp_path):
    """F6 of round 4: no customer is left out, in the query as in its SQL."""
    import duckdb

    from edutide.plans import relations

    spark.createDataFrame([(i, f"c{i}", i % 3) for i in (1, 2, 999_999, 1_000_000, 1_000_001, 5_400_000_000)] + [(4, "c4", None)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, i % 3) for i in (*range(1, 30), 1_000_000)] + [(99, None)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    got = sorted(tuple(r) for r in relations.QUERIES["j5_not_root"](spark, str(tmp_path)).collect())
    assert {c for c, _ in got} == {1, 2, 999_999, 1_000_000, 1_000_001, 5_400_000_000}
    with duckdb.connect() as con:
        for t in ("customer", "supplier"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        assert got == sorted(con.sql(relations.SQL["j5_not_root"]).fetchall())


def test_partitions_grow_with_rows(spark):
    """A task's rows are bounded, whatever number of shuffle partitions the session has."""
    from edutide.sources.shared import parts_of

    assert [parts_of(n, spark) for n in (0, 10, 2_000_000, 2_000_001, 600_000_000)] == [4, 4, 4, 5, 1200]


def test_snapshot_counts_contents_once_in_each_level(spark):
    """no level's contents are brought together to be counted; no row is spread out for each distinct count."""
    from edutide.operators import summaries

    edges = spark.createDataFrame([("a", "x", "p", "Live", 1), ("a", "x", "p", "Draft", 2), ("b", "x", "q", "Live", 4), ("b", "y", "q", "Draft", 8), (None, "y", "q", "Live", 16), ("c", "", "q", "Live", 32), ("c", "all", "q", None, 64)], "content string, author string, partner string, status string, created_ms long")
    found = summaries.snapshot(edges, spark.createDataFrame([("a", 10), ("b", 20), ("z", 40)], "content string, plays long"), 3)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = [("x", "p", 1, 1, 3, 20), ("x", "q", 1, 1, 4, 20), ("y", "q", 1, 0, 24, 20), ("all", "q", 1, 0, 64, 0), ("x", "all", 2, 2, 7, 40), ("y", "all", 1, 0, 24, 20), ("all", "all", 1, 0, 64, 0), ("all", "p", 1, 1, 3, 20), ("all", "q", 2, 1, 92, 40), ("all", "all", 3, 2, 95, 60)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
