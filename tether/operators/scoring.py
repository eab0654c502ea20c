"""Scores of (record, candidate) pairs and the best candidate of each mention.

The score compares the whole mention bag of a record with the nouns of a candidate's description, so it is one number per (record,
candidate), whatever mention proposed the candidate. Everything here works on distinct words with counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.operators.similarity import similar_words
from tether.session import stored


def similarity_scores(
    pairs: DataFrame,
    counts: DataFrame,
    nouns: DataFrame,
    threshold: float = 0.8,
    normalize: str = "document",
    similar: DataFrame | None = None,
    min_score: float | None = None,
) -> DataFrame:
    """``(warc_id, kb_id, score)`` for each of the distinct ``pairs (warc_id, kb_id, n_mentions)``.

    ``n_mentions`` is the size of the record's whole bag. ``counts`` is ``(warc_id, mention, n)`` and ``nouns`` the same for descriptions,
    ``(kb_id, mention, n, n_mentions)``.
    Score: number of similar (mention, noun) pairs, duplicates counted on both sides, over the number of mentions of the record
    (``normalize="document"``) or of nouns of the description (``"abstract"``). No similar pair: 0.0. ``min_score`` leaves out pairs below
    it; pairs without any similar words then never come back to be given a zero.

    A description's nouns are put beside the wanted pairs only, never beside every record, and meet the record's similar words on
    (record, noun), so no group grows with the number of records that share a word. Both joins by record have one row per key on the
    smaller side, which is hashed, as the larger one is not worth sorting.
    """
    if normalize not in ("document", "abstract"):
        raise ValueError("normalize must be 'document' or 'abstract'")
    if similar is None:
        similar = similar_words(counts.select("mention"), nouns.select("mention"), threshold)
    wanted = pairs.groupBy("warc_id", "kb_id").agg(F.max("n_mentions").alias("total"))
    all_pairs = min_score is None or min_score <= 0
    if all_pairs:
        wanted = stored(wanted, "pairs")
    matched = similar.select("word_b").distinct()
    kb_nouns = nouns.select("kb_id", F.col("mention").alias("noun"), F.col("n").alias("n_noun")).join(
        matched.withColumnRenamed("word_b", "noun"), "noun", "left_semi"
    )
    record_hits = (
        counts.select("warc_id", F.col("mention").alias("word_a"), "n")
        .join(similar, "word_a")
        .groupBy("warc_id", F.col("word_b").alias("noun"))
        .agg(F.sum("n").alias("n_record"))
    )
    scored = (
        wanted.join(kb_nouns, "kb_id")
        .join(record_hits.hint("shuffle_hash"), ["warc_id", "noun"])
        .groupBy("warc_id", "kb_id")
        .agg(F.sum(F.col("n_record") * F.col("n_noun")).alias("matches"), F.max("total").alias("total"))
    )
    if all_pairs:
        scored = wanted.join(scored.drop("total").hint("shuffle_hash"), ["warc_id", "kb_id"], "left")
    if normalize == "abstract":
        sizes = nouns.groupBy("kb_id").agg(F.max("n_mentions").alias("total"))
        scored = scored.drop("total").join(sizes, "kb_id", "left")
    scores = scored.select("warc_id", "kb_id", F.coalesce(F.col("matches") / F.col("total"), F.lit(0.0)).alias("score"))
    return scores if min_score is None else link_threshold(scores, min_score)


def best_candidate(scored: DataFrame) -> DataFrame:
    """Best row per ``(warc_id, mention)``: highest score, then highest relevance, then smallest id."""
    order = W.partitionBy("warc_id", "mention").orderBy(F.desc("score"), F.desc("search_score"), F.col("kb_id"))
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).drop("place")


def link_threshold(best: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Rows whose score reaches ``threshold``; the others are unlinkable."""
    return best.where(F.col("score") >= threshold)
