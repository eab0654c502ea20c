"""Entity linking end to end: documents, labels and triples in, links out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.operators import graph, scoring, search
from tether.operators.mentions import mention_counts
from tether.operators.similarity import similar_words
from tether.operators.rows import keyed, unkeyed
from tether.plans.documents import document_mentions, record_mentions
from tether.session import stored


def description_nouns(abstracts: DataFrame, **mention_options) -> DataFrame:
    """``(kb_id, mention, n, n_mentions)`` of the joined abstracts, found the same way as mentions of records."""
    bodies = graph.concat_abstracts(abstracts).select(F.col("kb_id").alias("warc_id"), "body")
    return mention_counts(record_mentions(bodies, **mention_options)).withColumnRenamed("warc_id", "kb_id")


def _proposals_and_scores(
    counts: DataFrame,
    labels: DataFrame | None,
    triples: DataFrame | None,
    word_threshold: float = 0.8,
    size: int = 100,
    results: int = 10,
    english: str = graph.ENGLISH,
    normalize: str = "document",
    min_score: float | None = None,
    candidates: DataFrame | None = None,
    descriptions: DataFrame | None = None,
    **mention_options,
) -> tuple[DataFrame, DataFrame]:
    """``counts`` with their usable candidates, and the score of each (record, candidate) among them."""
    # Tables below are read more than once: kept rather than computed again.
    if candidates is None:
        candidates = search.best_candidates(counts, labels, size, results)
    candidates = stored(candidates, "candidates")
    if descriptions is None:
        descriptions = graph.kb_abstracts(triples, candidates, suffix=english)
    else:
        descriptions = graph.english_abstracts(descriptions, english).join(candidates.select("kb_id").distinct(), "kb_id", "left_semi")
    abstracts = stored(descriptions, "abstracts")
    usable = graph.candidates_with_abstract(candidates, abstracts).select("mention", "kb_id", "search_score")
    nouns = stored(description_nouns(abstracts, **mention_options), "nouns")
    similar = stored(similar_words(counts.select("mention"), nouns.select("mention"), word_threshold), "similar")

    proposed = counts.join(usable, "mention")
    return proposed, scoring.similarity_scores(proposed, counts, nouns, word_threshold, normalize, similar, min_score)


def scored_candidates(counts: DataFrame, labels: DataFrame | None, triples: DataFrame | None, **options) -> DataFrame:
    """``(warc_id, mention, n, kb_id, search_score, score)`` for every candidate with an English abstract.

    ``candidates (mention, kb_id, search_score)`` and ``descriptions (kb_id, abstract)``, for instance from stored responses, take the
    place of the search in ``labels`` and of the look-up in ``triples``.

    ``counts`` is ``mention_counts`` of the documents. Each distinct mention is searched once, each candidate's abstract is read once.
    ``min_score`` drops candidates below it; given to a job that keeps only links of that score, it changes no link and spares the
    ranking of all the others.
    """
    proposed, scores = _proposals_and_scores(counts, labels, triples, **options)
    met = proposed.join(scores.hint("shuffle_hash"), ["warc_id", "kb_id"])
    return met.select("warc_id", "mention", "n", "kb_id", "search_score", "score")


def record_scores(counts: DataFrame, labels: DataFrame | None, triples: DataFrame | None, **options) -> DataFrame:
    """``(warc_id, kb_id, score)``: ``scored_candidates`` without the mentions, one row per record and candidate."""
    return _proposals_and_scores(counts, labels, triples, **options)[1]


def links_of(counts: DataFrame, labels: DataFrame | None = None, triples: DataFrame | None = None, threshold: float = 0.2, **options) -> DataFrame:
    """``best_links`` of records whose mentions are counted: ``counts`` is ``mention_counts`` with the record's key as ``warc_id``."""
    scored = scored_candidates(counts, labels, triples, min_score=threshold, **options)
    return unkeyed(scoring.best_candidate(scored).select("warc_id", "mention", "n", "kb_id", "score"))


def record_counts(docs: DataFrame, **mention_options) -> DataFrame:
    """``mention_counts`` of ``keyed`` documents."""
    return mention_counts(record_mentions(docs, **mention_options))


LINK_OPTIONS = ("threshold", "word_threshold", "size", "results", "english", "normalize", "candidates", "descriptions")


def best_links(
    docs: DataFrame, labels: DataFrame | None = None, triples: DataFrame | None = None, counts: DataFrame | None = None, **options
) -> DataFrame:
    """``(warc_id, mention, n, kb_id, score)``: the link of each distinct mention and how often the record has it.

    Ids may repeat; each record is scored alone, with its own bag. ``options`` are ``threshold``, those of ``scored_candidates`` and those of
    ``document_mentions``, which hold for records and descriptions alike. ``counts``, the stored ``record_counts`` of ``docs`` with the same
    options, spare a second reading of the texts.
    """
    if counts is None:
        mention_options = {k: v for k, v in options.items() if k not in LINK_OPTIONS}
        counts = stored(record_counts(keyed(docs), **mention_options), "mentions")
    return links_of(counts, labels, triples, **options)


def occurrences(links: DataFrame) -> DataFrame:
    """``(warc_id, mention, kb_id)`` of ``best_links``: one row per occurrence of a linked mention."""
    return links.select("warc_id", "mention", "kb_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("turn")).drop("turn")


def link_entities(docs: DataFrame, labels: DataFrame | None = None, triples: DataFrame | None = None, **options) -> DataFrame:
    """``(warc_id, mention, kb_id)``: one row per occurrence of a linked mention. ``options`` are those of ``best_links``.

    ``docs`` is ``(warc_id, body)``, ``labels`` is ``(kb_id, label)`` and ``triples`` is ``(s, p, o)``.
    """
    return occurrences(best_links(docs, labels, triples, **options))


def entities(
    links: DataFrame,
    labels: DataFrame,
    triples: DataFrame,
    size: int = 100,
    results: int = 10,
    english: str = graph.ENGLISH,
    candidates: DataFrame | None = None,
    **mention_options,
) -> DataFrame:
    """All that is known of each linked entity: ``(name, kb_id, labels, abstract, nouns, score)`` per ``(warc_id, name)``.

    ``links`` comes from ``best_links`` with the same tables and options. ``candidates (mention, kb_id, labels)`` spares a second search.
    """
    if candidates is None:
        candidates = search.best_candidates(links.select("mention"), labels, size, results)
    abstracts = stored(graph.kb_abstracts(triples, links, suffix=english), "abstracts")
    bodies = graph.concat_abstracts(abstracts)
    nouns = document_mentions(bodies.select(F.col("kb_id").alias("warc_id"), "body"), **mention_options).select(
        F.col("warc_id").alias("kb_id"), F.col("mentions").alias("nouns")
    )
    return (
        links.join(candidates.select("mention", "kb_id", "labels"), ["mention", "kb_id"])
        .join(bodies.withColumnRenamed("body", "abstract"), "kb_id")
        .join(nouns, "kb_id")
        .select("warc_id", F.col("mention").alias("name"), "kb_id", "labels", "abstract", "nouns", "score")
    )


def linked_entities(docs: DataFrame, labels: DataFrame, triples: DataFrame, size: int = 100, results: int = 10, **options) -> DataFrame:
    """``entities`` of the links of ``docs``, with one search for both; ``options`` are those of ``best_links``."""
    mention_options = {k: v for k, v in options.items() if k not in LINK_OPTIONS}
    counts = stored(record_counts(keyed(docs), **mention_options), "mentions")
    candidates = stored(search.best_candidates(counts, labels, size, results), "candidates")
    links = stored(links_of(counts, triples=triples, candidates=candidates, **options), "links")
    return entities(links, labels, triples, english=options.get("english", graph.ENGLISH), candidates=candidates, **mention_options)
