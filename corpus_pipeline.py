"""The corpus pipeline: quality rules, quality classifier, near duplicates, packing; each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catamill.llm import ngram_join, packing, quality_classifier, quality_rules
from catamill.llm.common import fold, free_name, join_lookup, written
from catamill.session import table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's adaptive thresholds reject go. Null texts are empty and go; equal texts
    of one language and source stay or go together; null languages and sources are groups; an empty table stays empty."""
    into = free_name(docs, "qr")
    return quality_rules.apply_rules(docs, into=into).where(F.col(f"{into}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.3 go. The model learns from the labelled rows of the whole table, held-out ones left out.
    Null texts are empty and judged as such; equal texts stay or go together; an empty table stays empty."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.train(table(spark, sf_dir, "documents"), labels)
    score = free_name(docs, "score")
    return quality_classifier.score(docs, model, score).where(F.col(score) >= 0.3).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays; of repeated rows one. Rows without an
    id are kept unless they are linked with a row that has one."""
    parts = ngram_join.join(docs, n=4, percent=85).select(F.col("doc_id").alias("id"), "component_id")
    kept = written(parts.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("id").count(), "kept")
    id_, n = free_name(docs, "id"), free_name(docs, "count")
    kept = kept.select(F.col("id").alias(id_), F.col("count").alias(n))
    some = docs.withColumn(id_, F.col("doc_id").cast("long"))
    out = join_lookup(some.where(F.col(id_).isNotNull()), kept.where(F.col(id_).isNotNull()), [id_], "left_semi", rows=1_000_000)
    if kept.where(F.col(id_).isNull()).limit(1).count():
        out = out.unionByName(some.where(F.col(id_).isNull()))
    if kept.where(F.col(n) > 1).limit(1).count():  # only where ids repeat
        out = out.dropDuplicates([id_, "text"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences. Null and empty texts have the end id alone; repeated rows are packed as often
    as they stand there; very long texts have as many pieces as they need; an empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality_rules", rules_stage), ("quality_classifier", classifier_stage), ("ngram_join", near_duplicates_stage), ("packing", packing_stage)]

#: The stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
