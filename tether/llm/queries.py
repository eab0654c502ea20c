"""Queries of this subpackage over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.llm import (
    byte_bpe,
    divergence,
    embedding_dedup,
    exact_dedup,
    language,
    line_dedup,
    merkle,
    packing,
    quality_net,
    quality_rules,
    simhash,
    token_counts,
    warc,
)
from tether.llm.oracles import ORACLES
from tether.session import fresh_path

__all__ = ["ORACLES", "REGISTRY", "prepared"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


# Rows of one Arrow batch: whole texts are large, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep batches of texts small.

    On a cluster the package comes with the job (``--py-files``).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op4_warc(spark, sf_dir):
    path = fresh_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.payloads(warc.reassembled(warc.read_records(spark, path))))


@query
def op5_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_net.score(docs, quality_net.learn(docs, table(spark, sf_dir, "labels")))


@query
def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_dedup.line_counts(docs, line_dedup.repeated_lines(docs, **line_dedup.GROWING))


@query
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"))


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.detect(docs, language.learn(docs))


@query
def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.divergence_audit(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
