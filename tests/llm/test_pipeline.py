"""The pipeline against a plain run of its stages, and the queries against SQL."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from edutide.llm import kneser_ney, pii, queries
from edutide.llm.units import Units

from .test_text_operators import plain_components, plain_words


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = queries.queries()[name](spark, small)
    answer = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, df.select(*columns).collect())) == sorted(str(_row(columns, r)) for r in answer.fetchall())


def _row(columns, values):
    from pyspark.sql import Row

    return Row(**dict(zip(columns, values)))


def test_stages_are_named_functions():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_pipeline_is_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    trusted = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").select("doc_id")
    accepted = {r.doc_id for r in kneser_ney.quality(docs, trusted).where("accepted").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in accepted}
    _, comp = plain_components(texts, 5, 80)
    texts = {i: t for i, t in texts.items() if comp[i] == i}
    passages = set()
    alnum = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = plain_words(r.text, alnum)
        m = min(10, len(w))
        passages |= {tuple(w[k : k + m]) for k in range(len(w) - m + 1 if m else 0)}
    sizes = {len(p) for p in passages}
    clean = {}
    for i, t in texts.items():
        w = plain_words(t, alnum)
        if not any(tuple(w[k : k + m]) in passages for m in sizes for k in range(len(w) - m + 1)):
            clean[i] = pii.redacted(t)
    t = Units(queries.tokenizer_path("word_bpe_49k.json")).tokenizer
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in clean.items()}
    got = {}
    for r in corpus_pipeline.run(spark, small).collect():
        got.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in got.items()} == want


def test_stages_keep_columns_and_survive_edge_cases(spark, small, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, small)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[1][1](spark, edge_docs, small).groupBy("doc_id").count().where("count > 1").count() == 0


def test_all_stages_in_turn_on_clashing_columns_and_empty_tables(spark, small, edge_docs, tmp_path):
    """Columns of names that stages use themselves, in both cases, and every other table empty or not."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    clashing = edge_docs.withColumnsRenamed({"n_shingles": "_row", "score": "_GONE"}).withColumn("__row", edge_docs["doc_id"]).withColumn("row", edge_docs["text"])
    kept = {}
    for folder in (small, str(tmp_path)):
        docs = clashing
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name == "packing":
                kept[folder] = (docs.count(), out.select("doc_id", "start").where("start = 0").count())
            else:
                assert out.columns == clashing.columns, name
                assert {r["_row"] for r in out.select("_row").collect()} <= {7}
                docs = out
        no = clashing.limit(0)
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, no, folder).count() == 0, name
    assert all(n == pieces > 0 for n, pieces in kept.values()) and kept[str(tmp_path)][0] >= kept[small][0]


def test_decisions_belong_to_rows(spark, small):
    bench = max((r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() if r.text), key=len)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = [r.text for r in docs.join(spark.read.parquet(f"{small}/labels.parquet").where("quality = 1"), "doc_id").orderBy("doc_id").limit(40).collect()]
    a, b, c = (t for t in sorted(good, key=len)[-3:])
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    texts = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)

    mixed = frame([(None, bench), (None, a), (1, bench), (1, a), (2, b)])
    assert texts(stages["decontamination"](spark, mixed, small)) == sorted([("None", a), ("1", a), ("2", b)])

    copies = frame([(None, a), (None, a), (7, a), (3, b), (3, c), (3, c)])
    assert texts(stages["near_duplicates"](spark, copies, small)) == sorted([("7", a), ("3", b), ("3", c)])

    junk = "".join(chr(33 + (i * 7919 + i * i) % 90) for i in range(4000))
    raw = docs.select("doc_id", "text", "lang", "source", "n_chars").union(frame([(None, junk), (10**9, junk), (10**9, a), (None, b)]))
    left = stages["quality"](spark, raw, small).where("doc_id is null or doc_id = 1000000000")
    assert texts(left) == sorted([("1000000000", a), ("None", b)])
