"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of documents. Decisions belong to rows, so that null and repeated ids stand for
nothing: where a decision follows from a row's id, language and text, rows are told by a digest of these; where one of several
equal rows stays, rows are numbered and written. Null texts count as empty and stay null. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edutide.llm import kneser_ney, neardup, packing, pii, queries, wu_manber
from edutide.llm.stage import free_name, row_digest, small_side, stored, table


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row, which is written, so that it stays the same, and that column's name, which no other has. Rows
    that repeat an id, or have none, are rows like others: none stands for another."""
    name = free_name(docs, "_row")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def _without(rows: DataFrame, number: str, gone: DataFrame) -> DataFrame:
    """Numbered rows but for those of `gone` (one column of numbers), with all other columns in their order."""
    name = free_name(rows, "_gone")
    gone = small_side(stored(gone.toDF(name), "gone"))
    return rows.join(gone, rows[number] == gone[name], "left_anti").drop(number)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; without trusted text all. Rows that are alike go or stay together."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    told = row_digest("doc_id", "lang", "text")
    row, name = free_name(docs, "_row"), free_name(docs, "_gone")
    gone = kneser_ney.quality(docs.withColumn(row, told), trusted, row_col=row).where("not accepted").select(F.col("doc_id").alias(name))
    return docs.join(small_side(stored(gone.distinct(), "gone"), 100_000), told == F.col(name), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, a null id last. Rows without words all stay."""
    rows, number = _numbered(docs)
    found = stored(neardup.near_duplicates(rows, id_col=number).select(F.col("doc_id").alias("_row"), "component_id", "kept"), "duplicates")
    groups = small_side(found.where("not kept").select("component_id").distinct())
    members = stored(found.join(groups, "component_id").select("_row", "component_id"), "members")
    members = rows.select(F.col(number).alias("_row"), "doc_id").join(small_side(members), "_row").withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    first = members.groupBy("component_id").agg(F.min("place")["_row"].alias("_first"))
    return _without(rows, number, members.join(first, "component_id").where("_row != _first").select("_row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; without a benchmark all."""
    return wu_manber.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars as the text now is; that of a null text stays."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, in sequences of 2048; rows that repeat an id are packed one by one."""
    return packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", pack)]

#: Neither the n-gram model nor the tokenizer has a form in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
