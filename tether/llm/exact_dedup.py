"""Exact duplicates by content-defined chunk recipes, in DataFrame operations only.

A text is cut into pieces that end at white space, and a chunk ends after a piece whose own hash says so. So chunks depend on nearby text
alone, and texts that share a passage share its chunks. A chunk's identifier is 128 bits of hash, and identifiers are verified: wherever
one stands twice in the corpus, the chunks behind it are compared as texts. Should two chunks share one, all are given anew with the next
seed. Documents are then compared by their recipes, the ordered lists of verified identifiers, so texts equal in recipe are equal. Of a
text only those chunks are ever shuffled that stand more than once, once each for a task; long documents are never moved whole.

Texts are equal when they are after lower-casing A-Z. Null counts as empty, and all empty texts are equal. Of equal texts the row with the
largest key stays, a null key being smaller than any other; of rows that repeat key and text, one stays. Very long texts are many
chunks; one without white space is cut after each ``PIECE + TAIL`` characters. Other columns play no part, whatever their names. Of an
empty table nothing remains.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.session import stored

# Characters a piece has at least, and those that may follow up to the end of the word.
PIECE, TAIL = 48, 208
# One of so many pieces ends a chunk; chunks without such a piece end after so many characters.
PIECES_A_CHUNK, LONGEST = 8, 8192
# Marks put into a text whose own first marks are escaped, so no text holds ``END``.
MARK, ESCAPED, END = "\x01", "\x01\x02", "\x01\x03"
# Identifiers up to this number are sent to every task, 16 bytes each; beyond it both sides are shuffled.
BROADCAST_IDS = 1_000_000


def normalised(text: Column) -> Column:
    """``text`` with A-Z in lower case, null as empty.

    Lower case in Spark changes other letters too, so a text that has any is cut into ASCII stretches and others, and only the first are
    changed. That takes a third of the time of a translation letter by letter.
    """
    text = F.coalesce(text, F.lit(""))
    stretches = F.regexp_extract_all(text, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]+"), F.lit(0))
    lowered = F.transform(stretches, lambda s: F.when(s < "\x80", F.lower(s)).otherwise(s))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.array_join(lowered, ""))


def chunks(text: Column) -> Column:
    """Content-defined chunks of ``text`` in order, as an array; together they are the text with its marks escaped."""
    pieces = F.regexp_extract_all(F.replace(text, F.lit(MARK), F.lit(ESCAPED)), F.lit(rf"(?s).{{1,{PIECE}}}\S{{0,{TAIL}}}+\s?"), F.lit(0))
    ends = lambda piece: F.pmod(F.xxhash64(piece), F.lit(PIECES_A_CHUNK)) == 0
    ended = F.transform(pieces, lambda piece: F.when(ends(piece), F.concat(piece, F.lit(END))).otherwise(piece))
    cut = F.split(F.array_join(ended, ""), END, -1)
    bounded = F.transform(cut, lambda c: F.when(F.octet_length(c) <= LONGEST, F.array(c)).otherwise(F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{LONGEST}}}"), F.lit(0))))
    return F.filter(F.flatten(bounded), lambda c: c != "")


def chunk_id(chunk: Column, seed: int) -> Column:
    """128 bits for a chunk."""
    return F.struct(F.xxhash64(F.lit(2 * seed), chunk).alias("a"), F.xxhash64(F.lit(2 * seed + 1), chunk).alias("b"))


def recipes(docs: DataFrame, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, row, text_sha256, recipe)``, a stored table; ``row`` is a number of its own for each row."""
    texts = docs.select(F.col(key).alias("key"), normalised(F.col(text)).alias("text"))
    # What an explode gives is computed once; a chain of selects would be merged and the text work done for each use.
    cut = texts.select("key", F.explode(F.array(F.struct(F.sha2("text", 256).alias("sha"), chunks(F.col("text")).alias("chunks")))).alias("of"))
    listed = F.transform("of.chunks", lambda c: chunk_id(c, seed))
    return stored(cut.select("key", F.monotonically_increasing_id().alias("row"), F.col("of.sha").alias("text_sha256"), listed.alias("recipe")), "recipes")


def repeated_ids(listed: DataFrame) -> DataFrame:
    """``(a, b)``: identifiers that stand more than once in the recipes, a stored table."""
    every = listed.select(F.explode("recipe").alias("id")).select("id.a", "id.b")
    return stored(every.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "repeated-ids")


def unsound_ids(docs: DataFrame, repeated: DataFrame, seed: int, text: str = "text") -> DataFrame:
    """``(a, b)``: those of the ``repeated`` identifiers that stand for two chunks or more."""
    every = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk")).select("chunk", chunk_id(F.col("chunk"), seed).alias("id"))
    wanted = F.broadcast(repeated) if repeated.count() <= BROADCAST_IDS else repeated
    met = every.select("chunk", "id.a", "id.b").join(wanted, ["a", "b"])
    return met.groupBy("a", "b", "chunk").agg(F.count("*").alias("n")).groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")


def verified_recipes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``recipes`` in which equal identifiers stand for equal chunks throughout the corpus."""
    for seed in count():
        listed = recipes(docs, seed, key, text)
        if unsound_ids(docs, repeated_ids(listed), seed, text).isEmpty():
            return listed


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``. Runs jobs and stores tables."""
    listed = verified_recipes(docs, key, text)
    # Counted in every task first, so a recipe that a third of all rows share is a few rows here; stored, so its join can be split.
    groups = listed.groupBy("recipe").agg(F.max(F.struct("key", "row")).alias("best"), F.count("*").alias("n")).where("n > 1")
    joined = listed.join(stored(groups, "equal-texts"), "recipe", "left")
    alone = F.col("n").isNull()
    return joined.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        "text_sha256",
    )
