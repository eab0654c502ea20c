"""Array columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, keep: list[str | Column], array: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """``keep`` and one row per element of ``array`` as ``name``, with its index as ``pos`` if wanted. Elements must not be null.

    An inner explode makes the optimiser add a filter on the array's size next to the scan, which would compute an array derived from
    text once for the filter and again for the rows. The outer form computes it once; the rows it adds for empty arrays go here.
    """
    if pos is None:
        rows = df.select(*keep, F.explode_outer(array).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(array).alias(pos, name))
    return rows.where(F.col(name).isNotNull())


def keyed(docs: DataFrame) -> DataFrame:
    """``(warc_id, body)`` with the id made a key of the record: the id and 128 bits of its text.

    Ids may repeat, and each record is judged alone. The key follows from the record itself, so it is the same whenever and wherever the
    record is read; records equal in id and text are copies, for which all results are equal.
    """
    key = F.struct(F.col("warc_id").alias("id"), F.xxhash64("body").alias("a"), F.xxhash64(F.lit("record"), "body").alias("b"))
    return docs.select(key.alias("warc_id"), "body")


def unkeyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the record's id in place of its key."""
    return rows.withColumn("warc_id", F.col("warc_id.id"))


def short_key(text: Column) -> Column:
    """``text`` to join or group by, digested where it is long."""
    return F.when(F.length(text) > 64, F.sha2(text, 256)).otherwise(text)


# Shares of a document's words by hash.
SHARES = 64


def _share(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SHARES)).cast("int")


def word_maps(pairs: DataFrame, word: str, value: str, name: str) -> DataFrame:
    """``(warc_id, name)`` of ``pairs (warc_id, word, value)``: what each document has for its words, to be read by ``looked_up``.

    A map's keys are read one after the other, which for a document of many words makes their square. So it is cut into ``SHARES`` maps.
    Equal rows count once; a document has one value for a word.
    """
    # Dealt by document, so both groupings need one shuffle.
    shares = pairs.select("warc_id", _share(F.col(word)).alias("share"), word, value).repartition("warc_id")
    maps = shares.groupBy("warc_id", "share").agg(F.map_from_entries(F.collect_set(F.struct(word, value))).alias("map"))
    by_doc = maps.groupBy("warc_id").agg(F.map_from_entries(F.collect_list(F.struct("share", "map"))).alias("maps"))
    every = F.sequence(F.lit(0), F.lit(SHARES - 1))
    return by_doc.select("warc_id", F.transform(every, lambda i: F.try_element_at("maps", i)).alias(name))


def looked_up(maps: Column | str, word: Column) -> Column:
    """What ``maps``, a column of ``word_maps``, has for ``word``, or null."""
    return F.try_element_at(F.get(maps, _share(word)), word)
