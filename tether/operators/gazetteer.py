"""Names of a gazetteer inside proper-noun chunks: leftmost, longest, not overlapping.

Comparing every stretch of every chunk with the names would make the square of a chunk's words. Here a word is looked at only if some
name begins with it, and only at the lengths such names have: an index of first words gives these, the stretches are cut out in the
chunk's row, joined with the names, and what is found is swept from left to right in the row again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.operators.rows import exploded, short_key
from tether.session import stored


def _words(text: Column) -> Column:
    return F.split(text, " ", -1)


def first_words(names: DataFrame) -> DataFrame:
    """``(word, lengths)``: words that begin a name of ``names (entity)``, with the numbers of words of such names."""
    cut = names.select(_words(F.col("entity")).alias("words")).select(F.get("words", F.lit(0)).alias("word"), F.size("words").alias("n"))
    return cut.groupBy("word").agg(F.collect_set("n").alias("lengths"))


def leftmost_longest(found: Column) -> Column:
    """Of ``found``, an array of ``(at, less, entity)`` with ``less`` the number of words below zero, the ``(at, entity)`` that are taken."""
    taken = F.array().cast("array<struct<at: int, entity: string>>")

    def sweep(state: Column, span: Column) -> Column:
        one = F.struct(span["at"].alias("at"), span["entity"].alias("entity"))
        return F.when(
            span["at"] >= state["end"],
            F.struct((span["at"] - span["less"]).alias("end"), F.array_append(state["taken"], one).alias("taken")),
        ).otherwise(state)

    return F.aggregate(F.array_sort(found), F.struct(F.lit(0).alias("end"), taken.alias("taken")), sweep, lambda state: state["taken"])


def chunk_entities(chunks: DataFrame, names: DataFrame) -> DataFrame:
    """``(chunk, at, entity)``: the names of ``names (entity)`` in each of the distinct ``chunks (chunk)``, words counted from 0."""
    chunks = stored(chunks.select("chunk", short_key(F.col("chunk")).alias("key")), "chunks")
    at = exploded(chunks, ["key"], _words(F.col("chunk")), "word", "at")
    asked = at.join(first_words(names), "word").groupBy("key").agg(F.collect_list(F.struct("at", "lengths")).alias("asked"))
    cut = chunks.join(asked, "key").select("key", _words(F.col("chunk")).alias("words"), "asked")

    def stretches(start: Column) -> Column:
        fitting = F.filter(start["lengths"], lambda n: start["at"] + n <= F.size("words"))
        return F.transform(fitting, lambda n: F.struct(start["at"].alias("at"), (-n).alias("less"), F.array_join(F.slice("words", start["at"] + 1, n), " ").alias("entity")))

    spans = exploded(cut, ["key"], F.flatten(F.transform("asked", stretches)), "span").select("key", "span.*")
    found = spans.join(names, "entity").groupBy("key").agg(F.collect_list(F.struct("at", "less", "entity")).alias("found"))
    taken = exploded(found, ["key"], leftmost_longest(F.col("found")), "one").select("key", "one.*")
    return chunks.join(taken, "key").select("chunk", "at", "entity")
