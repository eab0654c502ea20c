"""From raw documents to packed training sequences: five stages, each a filter or a rewrite of what the one before it kept.

Language ID drops texts whose language is not clear, the quality classifier drops texts below its threshold, line dedup takes out lines that
stand earlier in the corpus, SimHash keeps one document of each group of near-duplicates, and packing places the tokens of what is left in
sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.llm import language, line_dedup, packing, quality_net, simhash
from tether.llm.queries import prepared
from tether.session import stored

# Below this score a document goes; the classifier's own threshold for calling a text good is higher.
MIN_QUALITY = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return language.filter_language(docs, language.learn(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_net.filter_quality(docs, quality_net.learn(docs, labels), MIN_QUALITY)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    kept = line_dedup.drop_lines(docs, line_dedup.repeated_lines(docs, **line_dedup.GROWING))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return simhash.drop_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Compression, a trained network and tokens are beyond SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
