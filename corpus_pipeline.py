"""A training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Stages but the last return the columns of ``documents``.  Rows may share an id or have none: those that differ in any
column are told apart, and equal rows are one from the second stage on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.llm import bpe, decontaminate, ngram_join, quality_rules, suffix_dedup
from sparklab.llm.common import documents, small_batches, written
from sparklab.llm.queries import fold

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the rule ensemble scores 0.3 or more; four fifths of the labels train it."""
    small_batches(spark)
    labels = documents(spark, sf_dir, "doc_id", "quality", table="labels").where(fold(5) != 0)
    ensemble = quality_rules.fit(docs, labels, "quality")
    return quality_rules.score(docs.select(*COLUMNS), ensemble, out="_score", keep_text=True).where("_score >= 0.3").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of rows linked by 0.8 similar sets of 5-word shingles: that of the smallest id (null is
    the largest), of rows of one id that of the smallest hash."""
    small_batches(spark)
    docs = docs.select(*COLUMNS).withColumn("_row", F.xxhash64(*COLUMNS, *(F.col(c).isNull() for c in COLUMNS)))
    links = ngram_join.linked(docs, "_row", words=5, percent=80).select("_row", "component_id").distinct()
    links = written(links.join(docs.select("_row", "doc_id").distinct(), "_row"), "pipeline-links")
    first = links.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).getField("_row").alias("first"))
    others = links.join(first, "component_id").where("_row <> first").select("_row")
    return docs.join(others, "_row", "left_anti").dropDuplicates(["_row"]).select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the 100-byte strings that start earlier in the corpus; a document of which nothing is left goes."""
    small_batches(spark)
    done = suffix_dedup.dedup(docs, carry=("lang", "source"))
    left = done.where((F.col("n_removed") == 0) | (F.length("kept_text") > 0))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage near a benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs.select(*COLUMNS), documents(spark, sf_dir, "item_id", "text", table="benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document (little-endian 32-bit integers) and a digest of the text decoded from them."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(docs.select(*COLUMNS), path), path)
    return done.select("doc_id", "lang", "source", "n_chars", bpe.n_ids().alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("decontamination", decontamination), ("encoding", encoding)]

#: SQL expresses none of a fitted ensemble, components, suffix order, banded alignment and BPE merges: their operators
#: are tested against brute force instead, the stages that compare rows also with repeated and null ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
