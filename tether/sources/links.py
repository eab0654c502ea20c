"""Links as tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("warc_id", "mention", "kb_id")


def write_links(links: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line ``warc_id, mention, kb_id`` per link, no header, values as they are; duplicates stay."""
    links.select(F.concat_ws("\t", *COLUMNS).alias("value")).write.mode(mode).text(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t", -1)
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(COLUMNS)])
