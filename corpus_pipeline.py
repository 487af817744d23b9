"""Corpus pipeline over ``documents``: language, near copies, passages, benchmark leaks, packing.

Each stage calls one operator of ``cinelens.llm`` on all that its predecessor
kept; every stage is written as Parquet into the shared checkpoint folder and
read again. All but the last return the columns of ``documents``, extra and
clashing ones included. Rows with a null doc_id are never taken for copies
and stay, unless their text leaks; null and letterless texts go in the first stage; rows
repeated under one doc_id are one document from the second stage on; very
long texts are worked on whole; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelens.llm import decontaminate, language, near_dedup, packing, passages
from cinelens.llm.common import numbered, staged
from cinelens.sources.tables import read_table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: documents whose language is undetermined (null text, no letter) go, also where there is nothing to learn from."""
    model = language.train(docs)
    plain = numbered(docs)
    if not model.members:
        return language.with_letters(plain, f"c{docs.columns.index('text')}").toDF(*docs.columns)
    told = language.with_language(plain, model, plain.columns, f"c{docs.columns.index('text')}")
    return told.where(F.col("lang_pred") != language.UNKNOWN).select(*plain.columns).toDF(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: of every group of near copies the document with the smallest id stays."""
    gone = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").isEmpty():
        return kept
    # rows repeated under one doc_id are copies of each other too
    return kept.where("doc_id is null").unionAll(kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: passages that stand in an earlier document are cut out of the text."""
    return passages.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: what is left, in packed sequences."""
    return packing.pack(docs)


STAGES = [("language_id", keep_languages), ("near_dedup", keep_one_of_each), ("substring_dedup", cut_passages),
          ("decontamination", drop_leaks), ("packing", pack)]

#: Hashed sketches, trained weights and tokenizers have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
