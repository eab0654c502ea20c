"""Tokens, tags and mentions of document tables ``(warc_id, body)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.functions import words as fw
from tether.operators.gazetteer import chunk_entities
from tether.operators.lemmas import capitals_decide, changing_endings, swap_maps, swaps
from tether.operators.rows import exploded, looked_up
from tether.session import stored


def word_arrays(docs: DataFrame, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None, unicode: bool = False) -> DataFrame:
    """``(warc_id, words)``: cleaned words in order; letters of all scripts stay with ``unicode=True``.

    With a ``lexicon`` of known words the noun lemma is taken between the hexadecimal and the non-word step, which needs joins;
    without one the document never leaves its row.
    """
    if lexicon is None:
        return docs.select("warc_id", fw.clean_words(F.col("body"), unicode).alias("words"))
    cleaned = _lemma_text(docs, lexicon, exceptions, unicode=unicode)
    return cleaned.select("warc_id", fw.text_words(F.col("cleaned"), unicode).alias("words"))


def _lemma_text(docs: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None, capitalised: bool = False, unicode: bool = False) -> DataFrame:
    """``(warc_id, cleaned)``: clean texts with lemmas in place of the words, or of words that begin with a capital only.

    Only tokens with an ending that can change leave the text, and only those whose lemma is another word come back to it. If capitals
    matter alone, all other words are cut down to gaps first; that is a small part of the text, is stored, and the text is read once.
    """
    pattern = fw.token_pattern(changing_endings(exceptions), capitalised)
    if capitalised:
        names = docs.select("warc_id", fw.name_text(fw.ready_text(F.col("body"))).alias("body"))
        docs = stored(names.select("warc_id", "body", fw.chosen_tokens(F.col("body"), pattern).alias("words")), "names")
        ready, listed = F.col("body"), docs.select("warc_id", "words")
    else:
        ready = fw.ready_text(F.col("body"))
        asked = docs.select("warc_id", F.explode_outer(F.array(fw.chosen_tokens(ready, pattern))).alias("words"))
        listed = stored(asked.where(F.size("words") > 0), "words-asked")
    joined = docs.select("warc_id", "body").join(swaps(listed, lexicon, exceptions, lambda lemma: fw.clean(lemma, unicode)), "warc_id", "left")
    changed = fw.swapped_text(ready, lambda w: looked_up("swaps", w), pattern, unicode)
    plain = fw.only_letters(ready, unicode)
    return joined.select("warc_id", F.when(F.col("swaps").isNull(), plain).otherwise(changed).alias("cleaned"))


def token_rows(words: DataFrame, column: str = "words") -> DataFrame:
    """Long form ``(warc_id, pos, word)`` of a word array column."""
    return exploded(words, ["warc_id"], column, "word", "pos")


def remove_stop_words(rows: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Rows whose ``word`` is no stop word; case counts, so ``The`` stays."""
    return rows.where(~fw.is_stop_word(F.col("word"), stop_words))


def long_or_acronyms(rows: DataFrame) -> DataFrame:
    return rows.where(fw.long_or_acronym(F.col("word")))


def proper_nouns(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("tag") == fw.NOUN)


def tag_tokens(words: DataFrame, lexicon: DataFrame | None = None, unicode: bool = False) -> DataFrame:
    """``(warc_id, tagged)``: each word with its tag.

    ``lexicon`` is ``(word, tag)`` with lower-case words; words it does not list fall back on capitalisation. Any table with a
    ``tagged`` array of ``(word, tag)`` can take this one's place, for instance one filled by a tagging model. With a ``lexicon``, ``words``
    is read three times, so it should be a stored table.
    """
    if lexicon is None:
        return words.select("warc_id", fw.tag_by_rule(F.col("words"), unicode).alias("tagged"))
    # Only words whose tag is not the rule's are gathered, so the document stays in its row. Each distinct word is looked up once.
    listed = words.select("warc_id", F.array_distinct("words").alias("words"))
    known = lexicon.select(F.col("word").alias("known"), F.col("tag").alias("new"))
    spelled = exploded(listed, [], "words", "word").distinct().join(known, F.lower("word") == F.col("known"))
    changed = spelled.where(F.col("new") != fw.rule_tag(F.col("word"), unicode)).groupBy("word").agg(F.min("new").alias("new"))
    by_doc = swap_maps(listed, changed)
    joined = words.join(by_doc, "warc_id", "left")
    tag = lambda w: F.coalesce(looked_up("swaps", w), fw.rule_tag(w, unicode))
    swapped = F.transform("words", lambda w: F.struct(w.alias("word"), tag(w).alias("tag")))
    by_rule = fw.tag_by_rule(F.col("words"), unicode)
    return joined.select("warc_id", F.when(F.col("swaps").isNull(), by_rule).otherwise(swapped).alias("tagged"))


def tag_lexicon(words: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Tag of each lower-cased word by use: a proper noun if at least ``min_share`` of its uses are capitalised."""
    spelled = exploded(words, [], "words", "word").groupBy("word").agg(F.count("*").alias("n"))
    capital = F.when(F.col("word").rlike("^[A-Z]"), F.col("n")).otherwise(F.lit(0))
    return (
        spelled.groupBy(F.lower("word").alias("word"))
        .agg(F.sum("n").alias("n"), F.sum(capital).alias("n_capital"))
        .select(
            "word",
            "n",
            "n_capital",
            F.when(F.col("n_capital") >= F.col("n") * min_share, F.lit(fw.NOUN)).otherwise(F.lit(fw.OTHER)).alias("tag"),
        )
    )


def mention_arrays(tagged: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """``(warc_id, mentions)``: single nouns in text order, then runs of two or more."""
    return tagged.select("warc_id", fw.mentions(F.col("tagged"), stop_words).alias("mentions"))


def _by_rule(docs: DataFrame, name: str, from_text: Callable, from_tagged: Callable, lexicon: DataFrame | None, exceptions: DataFrame | None) -> DataFrame:
    """``(warc_id, name)`` of documents under the capitalisation rule.

    A fixed number of passes over each text gives it. With lemmas only capitalised words leave their rows, as no others can matter.
    """
    if lexicon is not None and not capitals_decide(lexicon, exceptions):
        return tag_tokens(word_arrays(docs, lexicon, exceptions)).select("warc_id", from_tagged(F.col("tagged")).alias(name))
    if lexicon is None:
        cleaned = docs.select("warc_id", fw.only_letters(fw.name_text(fw.ready_text(F.col("body")))).alias("cleaned"))
    else:
        cleaned = _lemma_text(docs, lexicon, exceptions, capitalised=True)
    return cleaned.select("warc_id", from_text(F.col("cleaned")).alias(name))


def text_mention_arrays(docs: DataFrame, stop_words: list[str] | None = None, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None) -> DataFrame:
    """``mention_arrays`` of documents under the capitalisation rule, after noun lemmas if a ``lexicon`` is given."""
    return _by_rule(docs, "mentions", lambda c: fw.rule_mentions(c, stop_words), lambda t: fw.mentions(t, stop_words), lexicon, exceptions)


def text_chunk_arrays(docs: DataFrame, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None) -> DataFrame:
    """``chunk_arrays`` of documents under the capitalisation rule, after noun lemmas if a ``lexicon`` is given."""
    return _by_rule(docs, "chunks", fw.rule_chunks, fw.noun_chunks, lexicon, exceptions)


def chunk_arrays(tagged: DataFrame) -> DataFrame:
    """``(warc_id, chunks)``: stretches of proper nouns in text order, single ones too."""
    return tagged.select("warc_id", fw.noun_chunks(F.col("tagged")).alias("chunks"))


def mention_rows(arrays: DataFrame) -> DataFrame:
    """Long form ``(warc_id, ord, kind, mention)`` of a mention bag."""
    kind = F.when(F.contains("mention", F.lit(" ")), F.lit("run")).otherwise(F.lit("word"))
    return exploded(arrays, ["warc_id"], "mentions", "mention", "ord").withColumn("kind", kind)


def mention_counts(arrays: DataFrame) -> DataFrame:
    """``(warc_id, mention, n, n_mentions)``: distinct mentions with their count and the size of the record's whole bag.

    ``warc_id`` is the record's key (see ``keyed``). Copies of a record count as one record with as many times its mentions.
    """
    # Dealt by record, so counts and sums need one shuffle.
    rows = exploded(arrays, ["warc_id"], "mentions", "mention").repartition("warc_id")
    counts = rows.groupBy("warc_id", "mention").agg(F.count("*").alias("n"))
    return counts.withColumn("n_mentions", F.sum("n").over(W.partitionBy("warc_id")))


def typed_entities(chunks: DataFrame, gazetteer: DataFrame, types: list[str] | None = None) -> DataFrame:
    """``(warc_id, pos, word_at, entity, type)``: names of ``gazetteer (name, type)`` in the proper-noun ``chunks (warc_id, chunks)``.

    A chunk may hold several names, between other words: the leftmost ones, the longest from where they start, and none that begins inside
    another. ``pos`` is the chunk's place in the record, ``word_at`` the name's first word in the chunk. ``types`` keeps the entities
    of some types only; a name of another type still takes its words. Each distinct chunk is searched once, and ``chunks`` is read twice.
    """
    occurrences = exploded(chunks, ["warc_id"], "chunks", "chunk", "pos")
    named = gazetteer.select(F.col("name").alias("entity"), "type").distinct()
    found = chunk_entities(occurrences.select("chunk").distinct(), named.select("entity").distinct())
    typed = found.join(named if types is None else named.where(F.col("type").isin(types)), "entity")
    return occurrences.join(typed, "chunk").select("warc_id", "pos", F.col("at").alias("word_at"), "entity", "type")


def entity_types(entities: DataFrame) -> DataFrame:
    """``(warc_id, entity, type)``: one type per entity text, the last occurrence wins (the greater type where a name has several)."""
    return entities.groupBy("warc_id", "entity").agg(F.max(F.struct("pos", "word_at", "type"))["type"].alias("type"))


def entity_mentions(entities: DataFrame, records: DataFrame) -> DataFrame:
    """``(warc_id, mentions)``: the distinct typed entities of each record, as the second way to find mentions.

    Every row of ``records (warc_id)`` has a bag; without typed entities it is empty.
    """
    found = entities.groupBy("warc_id").agg(F.array_sort(F.collect_set("entity")).alias("mentions"))
    empty = F.array().cast("array<string>")
    return records.select("warc_id").join(found, "warc_id", "left").select("warc_id", F.coalesce("mentions", empty).alias("mentions"))
