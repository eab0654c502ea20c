"""Knowledge-graph lookups as joins of a triple table ``(s, p, o)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.functions.keys import ABSTRACT, KB_NAMESPACE, SAME_AS, kb_iri

# How an English literal ends. With QUOTED_ENGLISH the store prints a quote after the language tag too.
ENGLISH = '"@en'
QUOTED_ENGLISH = '"@en"'


def _wanted(ids: DataFrame, namespace: str) -> DataFrame:
    return ids.select("kb_id").distinct().withColumn("iri", kb_iri(F.col("kb_id"), namespace))


def is_english(abstract: Column, suffix: str = ENGLISH) -> Column:
    return abstract.endswith(suffix)


def kb_abstracts(
    triples: DataFrame,
    ids: DataFrame,
    suffix: str | None = None,
    namespace: str = KB_NAMESPACE,
    same_as: str = SAME_AS,
    abstract: str = ABSTRACT,
) -> DataFrame:
    """Distinct ``(kb_id, abstract)`` of all wanted ids at once.

    Pattern: some subject is the same as the id, the subject is the same as a page, the page has an abstract. ``suffix`` keeps one
    language and is applied to the triples before any join.
    """
    same = triples.where(F.col("p") == same_as)
    texts = triples.where(F.col("p") == abstract)
    if suffix is not None:
        texts = texts.where(is_english(F.col("o"), suffix))
    subjects = (
        same.where(F.col("o").startswith(namespace))
        .select("s", F.col("o").alias("iri"))
        .join(_wanted(ids, namespace), "iri")
        .select("s", "kb_id")
        .distinct()
    )
    pages = subjects.join(same.select("s", F.col("o").alias("page")), "s").select("kb_id", "page").distinct()
    return (
        pages.join(texts.select(F.col("s").alias("page"), F.col("o").alias("abstract")), "page")
        .select("kb_id", "abstract")
        .distinct()
    )


def kb_properties(triples: DataFrame, ids: DataFrame, limit: int = 10, namespace: str = KB_NAMESPACE) -> DataFrame:
    """First ``limit`` properties ``(kb_id, p, o)`` of each wanted id, ordered by property and value."""
    order = W.partitionBy("kb_id").orderBy("p", "o")
    return (
        triples.join(_wanted(ids, namespace).select("kb_id", F.col("iri").alias("s")), "s")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= limit)
        .select("kb_id", "p", "o")
    )


def english_abstracts(abstracts: DataFrame, suffix: str = ENGLISH) -> DataFrame:
    """Rows whose ``abstract`` ends in ``suffix``; quotes and tag stay in the text."""
    return abstracts.where(is_english(F.col("abstract"), suffix))


def candidates_with_abstract(candidates: DataFrame, abstracts: DataFrame) -> DataFrame:
    """Candidates that have at least one of the given abstracts."""
    return candidates.join(abstracts.select("kb_id").distinct(), "kb_id", "left_semi")


def concat_abstracts(abstracts: DataFrame) -> DataFrame:
    """``(kb_id, body)``: the distinct abstracts of each id in text order, joined by a space."""
    return abstracts.groupBy("kb_id").agg(F.array_join(F.array_sort(F.collect_set("abstract")), " ").alias("body"))
