"""From archive to documents with mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tether.operators import context
from tether.operators import mentions as m
from tether.operators.rows import keyed, unkeyed
from tether.session import stored
from tether.sources import archive


def archive_documents(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Usable records of an archive as ``(warc_id, body)``; ``options`` are those of ``warc_records``."""
    return archive.documents(archive.read_records(archive.warc_records(spark, paths, **options)))


def record_mentions(
    docs: DataFrame,
    tag_lexicon: DataFrame | None = None,
    lemma_lexicon: DataFrame | None = None,
    lemma_exceptions: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    types: list[str] | None = None,
    stop_words: list[str] | None = None,
    unicode: bool = False,
    tag_uses: DataFrame | None = None,
    tag_moves: DataFrame | None = None,
    words: DataFrame | None = None,
) -> DataFrame:
    """``document_mentions`` of documents whose ``warc_id`` is the record's key.

    ``words``, the stored ``word_arrays`` of ``docs`` with the same options, are not made again where all words are needed.
    """
    by_rule = tag_lexicon is None and tag_uses is None and not unicode
    if gazetteer is None and by_rule:
        return m.text_mention_arrays(docs, stop_words, lemma_lexicon, lemma_exceptions)
    if by_rule:
        chunks = m.text_chunk_arrays(docs, lemma_lexicon, lemma_exceptions)
    else:
        if words is None:
            words = m.word_arrays(docs, lemma_lexicon, lemma_exceptions, unicode)
            if tag_uses is not None or tag_lexicon is not None:
                words = stored(words, "words")
        if tag_uses is not None:
            tagged = context.tag_in_context(words, tag_uses, tag_moves)
        else:
            tagged = m.tag_tokens(words, tag_lexicon, unicode)
        if gazetteer is None:
            return m.mention_arrays(tagged, stop_words)
        chunks = m.chunk_arrays(tagged)
    chunks = stored(chunks, "chunks")
    return m.entity_mentions(m.typed_entities(chunks, gazetteer, types), chunks)


def document_mentions(docs: DataFrame, **options) -> DataFrame:
    """``(warc_id, mentions)`` of documents ``(warc_id, body)``, one row per document; ids may repeat.

    Mentions are proper nouns and their runs. With a ``gazetteer (name, type)`` they are the distinct typed entities instead, of the given
    ``types`` or of all. With a ``lemma_lexicon (word)`` of known words, and irregular forms in ``lemma_exceptions (word, form)``, words are
    replaced by their noun lemmas first. ``tag_lexicon (word, tag)`` has tags other than by capitalisation; ``tag_uses (word, tag, n)`` and
    ``tag_moves (before, tag, n)`` let the words around decide instead (see ``tag_in_context``). ``unicode=True`` keeps letters of all scripts in words, and takes a capital of any script for one. ``stop_words`` replaces the list of words that are no mentions.
    """
    return unkeyed(record_mentions(keyed(docs), **options))
