"""Precision, recall and F1 of links against a gold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def link_eval(links: DataFrame, gold: DataFrame, keys: Sequence[str] = ("warc_id", "mention", "kb_id")) -> DataFrame:
    """One row ``(gold, linked, correct, precision, recall, f1)``; rows equal on ``keys`` count once, ratios of nothing are 0."""
    both = links.select(*keys, F.lit(1).alias("is_link"), F.lit(0).alias("is_gold")).unionByName(
        gold.select(*keys, F.lit(0).alias("is_link"), F.lit(1).alias("is_gold"))
    )
    counts = (
        both.groupBy(*keys)
        .agg(F.max("is_link").alias("is_link"), F.max("is_gold").alias("is_gold"))
        .agg(
            F.coalesce(F.sum("is_gold"), F.lit(0)).alias("gold"),
            F.coalesce(F.sum("is_link"), F.lit(0)).alias("linked"),
            F.coalesce(F.sum(F.col("is_link") * F.col("is_gold")), F.lit(0)).alias("correct"),
        )
    )

    def ratio(part, whole):
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    scored = counts.withColumn("precision", ratio(F.col("correct"), F.col("linked"))).withColumn(
        "recall", ratio(F.col("correct"), F.col("gold"))
    )
    return scored.withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
