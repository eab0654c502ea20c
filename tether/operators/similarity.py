"""Similarity join on words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.functions.hamming import allowed_differences, hamming_similarity
from tether.operators.joins import balanced_join
from tether.session import stored


def _int(column: Column) -> Column:
    return F.floor(column).cast("int")


def _longer_lengths(lengths: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``lengths`` with each length ``n`` that a similar word of ``others``, no shorter than ``length``, can have."""
    # A longer word of n positions needs length/n > threshold, so the list ends soon after length/threshold. For low thresholds
    # that is far, and the longest word there is ends it earlier.
    last = F.floor(F.col("length") / F.lit(max(threshold, 1e-9))) + 1
    if threshold < 0.5:
        last = F.least(last, others.agg(F.coalesce(F.max("length"), F.lit(0))).scalar())
    return (
        lengths.withColumn("last", last.cast("int"))
        .where(F.col("last") >= F.col("length"))
        .select("length", F.explode(F.sequence("length", "last")).alias("n"))
        .where(F.col("n") - F.col("length") <= allowed_differences(F.col("n"), threshold))
    )


def _with_lengths(words: DataFrame, lengths: DataFrame, other_lengths: DataFrame, threshold: float) -> DataFrame:
    """``(word, n, is_longer)``: each word under its own length and, as the shorter one, under lengths of the other side.

    Only lengths at which the other side has a possible partner are kept, so a few words of extreme length cost nothing.
    """
    sized = words.withColumn("length", F.length("word"))
    as_longer = _longer_lengths(other_lengths, lengths, threshold).select(F.col("n").alias("length")).distinct()
    as_shorter = (
        _longer_lengths(lengths, other_lengths, threshold)
        .where("n > length")
        .join(other_lengths.select(F.col("length").alias("n")), "n", "left_semi")
    )
    return (
        sized.join(as_longer, "length", "left_semi")
        .select("word", F.col("length").alias("n"), F.lit(True).alias("is_longer"))
        .unionByName(sized.join(as_shorter, "length").select("word", "n", F.lit(False).alias("is_longer")))
    )


def part_keys(words: DataFrame, threshold: float) -> DataFrame:
    """Rows ``(word, is_longer, key)`` for ``words (word, n, is_longer)``: keys of a word seen as one of ``n`` positions.

    Any two words similar over ``n`` positions share at least one key. With ``k`` differences allowed, the positions are cut into
    blocks and a budget of ``k + 1`` differences is dealt out among them, two or three to a block. In at least one block the two words
    then differ in fewer places than its share ``u``, so of its ``u + 1`` even parts at least two are equal: each two parts make a
    key. Parts beyond the end of a shorter word differ anyway and give no key. A key reads about two thirds of a block, which keeps
    groups of equal keys small.
    """
    # Below one half a block could have more parts than positions; one block with a part for each unit is complete there.
    paired = threshold >= 0.5
    budget = words.withColumn("budget", allowed_differences(F.col("n"), threshold) + 1)
    blocks = F.greatest(F.lit(1), _int(F.col("budget") / 2)) if paired else F.lit(1)

    def share(total: str, j: Column) -> Column:
        return _int(j * F.col(total) / F.col("blocks"))

    j = F.col("j")
    block = (
        budget.withColumn("blocks", blocks)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "word",
            "n",
            "is_longer",
            "j",
            share("n", j).alias("start"),
            (share("n", j + 1) - share("n", j)).alias("width"),
            (share("budget", j + 1) - share("budget", j)).alias("units"),
        )
    )

    def begin(part: Column, parts: Column) -> Column:
        return F.col("start") + _int(part * F.col("width") / parts)

    def text(part: Column, parts: Column) -> Column:
        return F.substr("word", begin(part, parts) + 1, begin(part + 1, parts) - begin(part, parts))

    a, b, units = F.col("a"), F.col("b"), F.col("units")
    first = block.withColumn("a", F.explode(F.sequence(F.lit(0), units - 1)))
    if paired:
        parts = first.withColumn("b", F.explode(F.sequence(a + 1, units))).where(begin(b + 1, units + 1) <= F.length("word"))
        key = F.xxhash64("n", "j", "a", "b", text(a, units + 1), text(b, units + 1))
    else:
        parts = first.where(begin(a + 1, units) <= F.length("word"))
        key = F.xxhash64("n", "j", "a", text(a, units))
    return parts.select("word", "is_longer", key.alias("key"))


def similar_words(left: DataFrame, right: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All pairs ``(word_a, word_b)`` of the distinct, non-empty words of two one-column tables with similarity above ``threshold``.

    Candidates meet by equi-join on part keys and are then checked with the similarity itself, so the result is exact for every
    threshold from 0 up to 1.
    """
    if not 0 <= threshold < 1:
        raise ValueError("threshold must be at least 0 and less than 1")
    # Each side is computed once: its words are read for their lengths and their keys, its keys for their counts and the join.
    a = stored(left.select(F.col(left.columns[0]).alias("word")).where("word <> ''").distinct(), "words")
    b = stored(right.select(F.col(right.columns[0]).alias("word")).where("word <> ''").distinct(), "words")
    a_lengths = a.select(F.length("word").alias("length")).distinct()
    b_lengths = b.select(F.length("word").alias("length")).distinct()
    ka = part_keys(_with_lengths(a, a_lengths, b_lengths, threshold), threshold)
    kb = part_keys(_with_lengths(b, b_lengths, a_lengths, threshold), threshold)
    right_keys = stored(kb.select("key", F.col("word").alias("word_b"), F.col("is_longer").alias("b_longer")), "keys")
    # Most keys of the larger side have no partner, and are left out before anything is counted.
    partners = right_keys.select("key").distinct()
    left_keys = ka.select("key", F.col("word").alias("word_a"), F.col("is_longer").alias("a_longer")).join(partners, "key", "left_semi")
    met = balanced_join(stored(left_keys, "keys"), right_keys, "key")
    close: Column = hamming_similarity(F.col("word_a"), F.col("word_b")) > threshold
    return met.where((F.col("a_longer") | F.col("b_longer")) & close).select("word_a", "word_b").distinct()
