"""Web archives as tables of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.functions import markup

# Fixed value: the line that starts a record.
MARKER = "WARC/1.0"


def line_separator(line_end: str = "\r\n") -> str:
    """What ends a record for the text reader: a line break and the next marker line."""
    return f"\n{MARKER}{line_end}"


def record_texts(value: Column) -> Column:
    """Records in a piece of an archive, as an array: a marker may have blanks around it, and its line may end in either way."""
    pieces = F.split(value, rf"(?md)^[ \t\x0B\f\r]*\Q{MARKER}\E[ \t\x0B\f\r]*$\n?", -1)
    return F.transform(pieces, lambda piece: F.rtrim(piece, F.lit("\r\n")))


def warc_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    line_end: str = "\r\n",
    drop_trailing: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``(path, record)``: the text after each marker line, up to the next one.

    The usual marker line is the reader's separator, so records stream out of each file (gzip included) and no file is held whole; what
    it gives is split once more at marker lines of any other form. A marker inside a line splits nothing. ``line_end`` is what ends most of
    the archive's header lines and only bounds memory. Line breaks at the end of a record are not part of it, and records without text
    are skipped.

    A gzip file is read by one task. Archives come as many files, so that is no limit; for few large ones ``partitions`` spreads the
    records before the costly steps. ``drop_trailing`` leaves out the last record of each file, as a reader that emits a record
    only on meeting the next marker would.
    """
    files = spark.read.option("lineSep", line_separator(line_end)).text([paths] if isinstance(paths, str) else list(paths))
    path, start = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    # Within a split ids grow in reading order, and splits of a file are ordered by where they start.
    ordered = files.select(path, start, F.monotonically_increasing_id().alias("id"), record_texts(F.col("value")).alias("texts"))
    raw = ordered.select("path", "start", "id", F.posexplode_outer("texts").alias("place", "record")).where("record <> ''")
    if drop_trailing:
        raw = raw.withColumn("turn", F.struct("start", "id", "place"))
        last = raw.groupBy("path").agg(F.max("turn").alias("last"))
        raw = raw.join(last, "path").where(F.col("turn") < F.col("last"))
    records = raw.select("path", "record")
    return records if partitions is None else records.repartition(partitions)


def read_records(records: DataFrame, sep: str = " ", strip_scripts: bool = True) -> DataFrame:
    """``records`` with ``(warc_id, body, reason)`` added; ``reason`` is null for usable records.

    Reasons: ``empty``, ``no content type``, ``many content types``, ``no id``.
    """
    others = records.columns
    text = records.select(*others, markup.tag_free(F.col("record"), sep, strip_scripts).alias("text"))
    text = text.select(*others, markup.unescape(F.col("text")).alias("text"))
    parts = text.select(*others, markup.header_parts(F.col("text")).alias("parts"))
    warc_id = markup.record_id(F.get("parts", F.lit(0)))
    reason = (
        F.when(F.trim("record", F.lit(" \t\r\n")) == "", "empty")
        .when(F.size("parts") < 2, "no content type")
        .when(F.size("parts") > 2, "many content types")
        .when(warc_id.isNull(), "no id")
    )
    body = markup.strip_code_blocks(F.get("parts", F.lit(1)))
    # A filter on the outcome stays above the explode; below it, the whole text work would be done a second time at the scan.
    found = F.explode_outer(F.array(F.struct(warc_id.alias("warc_id"), body.alias("body"), reason.alias("reason")))).alias("found")
    return parts.select(*others, found).select(*others, "found.*")


def documents(read: DataFrame) -> DataFrame:
    """Usable records as ``(warc_id, body)``."""
    return read.where(F.col("reason").isNull()).select("warc_id", "body")


def rejects(read: DataFrame) -> DataFrame:
    """Unusable records as ``(record, reason)``."""
    return read.where(F.col("reason").isNotNull()).select("record", "reason")


def corpus_counts(read: DataFrame) -> DataFrame:
    """``(reason, n)``: records by outcome, ``ok`` for usable ones."""
    return read.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))
