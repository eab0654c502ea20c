"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.functions import hamming, keys, markup
from tether.functions import words as fw
from tether.operators import context, dictionary, evaluation, graph, lemmas, scoring, search, similarity
from tether.operators import mentions as m
from tether.operators.rows import exploded, keyed, unkeyed
from tether.plans import documents as pd
from tether.plans import linking
from tether.session import fresh_path, stored
from tether.sources import archive, links, responses
from tether.streaming import linking as streamed
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Shared inputs -------------------------------------------------------------------------------------------------------------------


def _lemma_options(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Known words and irregular forms as stored tables, as dictionaries would come."""
    known = stored(t.known_words(spark, sf_dir), "known-words")
    return {"lemma_lexicon": known, "lemma_exceptions": stored(_irregular(known), "irregular")}


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words after all cleaning steps, lemmas included."""
    return m.word_arrays(t.docs(spark, sf_dir), *_lemma_options(spark, sf_dir).values())


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.tag_tokens(_words(spark, sf_dir))


def _tagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exploded(_tagged(spark, sf_dir), ["warc_id"], "tagged", "t", "pos")
    return rows.select("warc_id", "pos", "t.word", "t.tag")


def _arrays(spark: SparkSession, sf_dir: str, options: dict[str, DataFrame] | None = None) -> DataFrame:
    return pd.document_mentions(t.docs(spark, sf_dir), **(options or _lemma_options(spark, sf_dir)))


def _mentions(spark: SparkSession, sf_dir: str, options: dict[str, DataFrame] | None = None) -> DataFrame:
    """Distinct mentions of the corpus."""
    return stored(exploded(_arrays(spark, sf_dir, options), [], "mentions", "mention").distinct(), "mentions")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(m.text_chunk_arrays(t.docs(spark, sf_dir), *_lemma_options(spark, sf_dir).values()), "chunks")


def _raw_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tokens with their number of uses."""
    tokens = exploded(t.docs(spark, sf_dir), [], fw.tokens(F.col("body")), "token")
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def _irregular(known: DataFrame) -> DataFrame:
    """Irregular forms: known words in ``-ae`` go with the form in ``-a``."""
    ae = known.where(F.col("word").endswith("ae"))
    return ae.select("word", F.expr("substring(word, 1, length(word) - 1)").alias("form"))


def _word_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.count("*").alias("n"))


def _abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.kb_abstracts(t.kb_triples(spark, sf_dir), t.items(spark, sf_dir))


def _nouns(spark: SparkSession, sf_dir: str, options: dict[str, DataFrame]) -> DataFrame:
    abstracts = graph.english_abstracts(_abstracts(spark, sf_dir))
    return stored(linking.description_nouns(abstracts, **options), "nouns")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(t.kb_labels(spark, sf_dir), "labels")


def _knowledge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labels and triples as stored tables, as a knowledge base would come."""
    labels = _labels(spark, sf_dir)
    return labels, stored(t.kb_triples(spark, sf_dir, labels), "triples")


def _scored(spark: SparkSession, sf_dir: str, normalize: str = "document", scored: Callable[..., DataFrame] = linking.scored_candidates) -> DataFrame:
    options = _lemma_options(spark, sf_dir)
    counts = stored(linking.record_counts(keyed(t.docs(spark, sf_dir)), **options), "mentions")
    return unkeyed(scored(counts, *_knowledge(spark, sf_dir), normalize=normalize, **options))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a whole passage, with the passage's entity."""
    passages = t.items(spark, sf_dir).select(F.col("text").alias("label"), "kb_id")
    return dictionary.dictionary_labels(t.docs(spark, sf_dir), passages).select("warc_id", "kb_id")


# Records -------------------------------------------------------------------------------------------------------------------------


@query
def warc_records(spark, sf_dir):
    records = archive.warc_records(spark, t.page_archive(spark, sf_dir))
    return records.select("record", F.length("record").alias("n_chars"))


@query
def html_text(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", markup.html_text(F.col("html")).alias("text"))


@query
def split_headers(spark, sf_dir):
    parts = t.page_records(spark, sf_dir).withColumn("parts", markup.header_parts(F.col("record")))
    usable = F.size("parts") == 2
    return parts.select(
        "page_id",
        F.size("parts").alias("n_parts"),
        F.when(usable, F.col("parts")[0]).alias("headers"),
        F.when(usable, F.get("parts", F.lit(1))).alias("body"),
    )


@query
def record_id(spark, sf_dir):
    return t.page_records(spark, sf_dir).select("page_id", markup.record_id(F.col("record")).alias("warc_id"))


@query
def strip_code_blocks(spark, sf_dir):
    blocks = F.replace(F.replace("html", F.lit("<!--"), F.lit("\n<!--")), F.lit("-->"), F.lit("\n//-->\n"))
    return t.table(spark, sf_dir, "pages").select("page_id", markup.strip_code_blocks(blocks).alias("body"))


@query
def corpus_counts(spark, sf_dir):
    return archive.corpus_counts(archive.read_records(t.page_records(spark, sf_dir)))


@query
def document_mentions(spark, sf_dir):
    docs = pd.archive_documents(spark, t.page_archive(spark, sf_dir))
    return pd.document_mentions(docs, **_lemma_options(spark, sf_dir)).select(
        "warc_id", F.size("mentions").alias("n_mentions"), F.array_join("mentions", "|").alias("mentions")
    )


# Tokens --------------------------------------------------------------------------------------------------------------------------


@query
def tokens(spark, sf_dir):
    return exploded(t.docs(spark, sf_dir), ["warc_id"], fw.tokens(F.col("body")), "token", "pos")


@query
def strip_hex(spark, sf_dir):
    return _raw_tokens(spark, sf_dir).select("token", fw.strip_hex(F.col("token")).alias("word"), "n")


@query
def strip_nonword(spark, sf_dir):
    token = F.col("token")
    return _raw_tokens(spark, sf_dir).select(
        "token", fw.strip_nonword(token).alias("word"), fw.strip_nonword(token, unicode=True).alias("unicode_word"), "n"
    )


@query
def strip_digits(spark, sf_dir):
    return _raw_tokens(spark, sf_dir).select("token", fw.strip_digits(F.col("token")).alias("word"), "n")


@query
def lemmas_of_words(spark, sf_dir):
    words = _raw_tokens(spark, sf_dir).select(fw.strip_hex(F.col("token")).alias("word"))
    return lemmas.lemmas(words, *_lemma_options(spark, sf_dir).values())


@query
def clean_tokens(spark, sf_dir):
    return m.token_rows(_words(spark, sf_dir))


@query
def stopword_filter(spark, sf_dir):
    return _word_counts(m.remove_stop_words(m.token_rows(_words(spark, sf_dir))))


@query
def length_or_acronym(spark, sf_dir):
    return _word_counts(m.long_or_acronyms(m.token_rows(_words(spark, sf_dir))))


@query
def proper_nouns(spark, sf_dir):
    return m.proper_nouns(_tagged_rows(spark, sf_dir)).groupBy("warc_id", "word").agg(F.count("*").alias("n"))


@query
def tag_lexicon(spark, sf_dir):
    return m.tag_lexicon(_words(spark, sf_dir))


@query
def tag_tokens(spark, sf_dir):
    words = stored(_words(spark, sf_dir), "words")
    tagged = m.tag_tokens(words, m.tag_lexicon(words))
    rows = exploded(tagged, [], "tagged", "t").select("t.word", "t.tag")
    return rows.groupBy("word", "tag").agg(F.count("*").alias("n"))


@query
def tag_moves(spark, sf_dir):
    return context.tag_moves(_tagged(spark, sf_dir))


@query
def tag_in_context(spark, sf_dir):
    """Tags by the best sequence, from uses and moves of the corpus itself."""
    words = stored(_words(spark, sf_dir), "words")
    tagged = context.tag_in_context(words, context.tag_uses(words), context.tag_moves(m.tag_tokens(words)))
    rows = exploded(tagged, ["warc_id"], "tagged", "t", "pos")
    return rows.select("warc_id", "pos", "t.word", "t.tag")


# Mentions ------------------------------------------------------------------------------------------------------------------------


@query
def noun_runs(spark, sf_dir):
    return exploded(_tagged(spark, sf_dir), ["warc_id"], fw.noun_runs(F.col("tagged")), "run", "pos")


@query
def mentions(spark, sf_dir):
    return m.mention_rows(_arrays(spark, sf_dir))


@query
def context_mentions(spark, sf_dir):
    """Mentions by tags in context."""
    options = _lemma_options(spark, sf_dir)
    words = stored(m.word_arrays(t.docs(spark, sf_dir), *options.values()), "words")
    model = {"tag_uses": context.tag_uses(words), "tag_moves": context.tag_moves(m.tag_tokens(words))}
    found = pd.document_mentions(t.docs(spark, sf_dir), **options, **model)
    return found.select("warc_id", F.array_join("mentions", "|").alias("mentions"))


@query
def unicode_mentions(spark, sf_dir):
    """Mentions whose words keep the letters of all scripts."""
    found = pd.document_mentions(t.docs(spark, sf_dir), unicode=True)
    return found.select("warc_id", F.array_join("mentions", "|").alias("mentions"))


@query
def typed_entities(spark, sf_dir):
    return m.typed_entities(_chunks(spark, sf_dir), t.gazetteer(spark, sf_dir))


@query
def typed_places(spark, sf_dir):
    """Mentions by typed entities of chosen types; documents without any keep an empty bag."""
    options = _lemma_options(spark, sf_dir)
    found = pd.document_mentions(t.docs(spark, sf_dir), gazetteer=t.gazetteer(spark, sf_dir), types=["GPE", "ORGANIZATION"], **options)
    return found.select("warc_id", F.array_join("mentions", "|").alias("mentions"))


@query
def entity_types(spark, sf_dir):
    return m.entity_types(m.typed_entities(_chunks(spark, sf_dir), t.gazetteer(spark, sf_dir)))


@query
def entity_mentions(spark, sf_dir):
    found = pd.document_mentions(t.docs(spark, sf_dir), gazetteer=t.gazetteer(spark, sf_dir), **_lemma_options(spark, sf_dir))
    return found.select("warc_id", F.array_join("mentions", "|").alias("mentions"))


# Candidates ----------------------------------------------------------------------------------------------------------------------


@query
def candidate_search(spark, sf_dir):
    return search.search_hits(_mentions(spark, sf_dir), _labels(spark, sf_dir))


@query
def top_hits(spark, sf_dir):
    return search.top_hits(search.search_hits(_mentions(spark, sf_dir), _labels(spark, sf_dir))).select(
        "mention", "rank", "kb_id", "label", "search_score"
    )


def _flat_sets(sets: DataFrame) -> DataFrame:
    return sets.select("mention", "kb_id", F.array_join("labels", "|").alias("labels"), "search_score")


@query
def label_sets(spark, sf_dir):
    return _flat_sets(search.search(_mentions(spark, sf_dir), _labels(spark, sf_dir)))


@query
def best_candidates(spark, sf_dir):
    return _flat_sets(search.best_candidates(_mentions(spark, sf_dir), _labels(spark, sf_dir)))


def _hits_json(spark: SparkSession, sf_dir: str, mentions: DataFrame) -> DataFrame:
    """``(mention, json)``: the first twenty hits of each mention, as a search service would answer."""
    hits = search.search_hits(mentions, _labels(spark, sf_dir), 20)
    source = F.struct("label", F.col("kb_id").alias("resource")).alias("_source")
    one = F.struct(F.col("search_score").alias("_score"), source).alias("hit")
    ranked = hits.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("rank", one))).alias("found"))
    body = F.struct(F.struct(F.transform("found", lambda h: h["hit"]).alias("hits")).alias("hits"))
    return ranked.select("mention", F.to_json(body).alias("json"))


@query
def flatten_hits(spark, sf_dir):
    return responses.flatten_hits(_hits_json(spark, sf_dir, _mentions(spark, sf_dir)))


@query
def dictionary_labels(spark, sf_dir):
    return dictionary.dictionary_labels(t.docs(spark, sf_dir), _labels(spark, sf_dir))


# Knowledge base ------------------------------------------------------------------------------------------------------------------


@query
def kb_key(spark, sf_dir):
    kb_id = F.col("kb_id")
    return t.items(spark, sf_dir).select("kb_id", keys.kb_key(kb_id).alias("key"), keys.kb_iri(kb_id).alias("iri"))


@query
def kb_abstracts(spark, sf_dir):
    return _abstracts(spark, sf_dir)


@query
def kb_properties(spark, sf_dir):
    return graph.kb_properties(t.kb_triples(spark, sf_dir), t.items(spark, sf_dir))


@query
def english_abstracts(spark, sf_dir):
    return graph.english_abstracts(_abstracts(spark, sf_dir))


@query
def candidates_with_abstract(spark, sf_dir):
    candidates = search.best_candidates(_mentions(spark, sf_dir), _labels(spark, sf_dir))
    kept = graph.candidates_with_abstract(candidates, graph.english_abstracts(_abstracts(spark, sf_dir)))
    return kept.select("mention", "kb_id", "search_score")


@query
def concat_abstracts(spark, sf_dir):
    return graph.concat_abstracts(graph.english_abstracts(_abstracts(spark, sf_dir)))


def _bindings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(kb_id, json)``: the abstracts of each entity, few of them, as a graph service would answer."""
    value = F.struct(F.struct(F.col("abstract").alias("value")).alias("abstract"))
    grouped = _abstracts(spark, sf_dir).groupBy("kb_id").agg(F.collect_list(value).alias("bindings"))
    body = F.struct(F.struct("bindings").alias("results"))
    return grouped.select("kb_id", F.to_json(body).alias("json"))


@query
def flatten_bindings(spark, sf_dir):
    return responses.flatten_bindings(_bindings_json(spark, sf_dir))


# Scores and links ----------------------------------------------------------------------------------------------------------------


@query
def hamming_similarity(spark, sf_dir):
    """Each word against the next one of its document."""
    words = F.col("words")
    zipped = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))
    pairs = exploded(_words(spark, sf_dir), [], zipped, "p")
    distinct = pairs.select("p.a", "p.b").where("b is not null").distinct()
    return distinct.select("a", "b", F.round(hamming.hamming_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


@query
def similar_words(spark, sf_dir):
    options = _lemma_options(spark, sf_dir)
    return similarity.similar_words(_mentions(spark, sf_dir, options), _nouns(spark, sf_dir, options).select("mention"))


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", F.round("score", 6))


@query
def similarity_score(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir, scored=linking.record_scores).distinct())


@query
def similarity_score_by_abstract(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir, "abstract", linking.record_scores).distinct())


@query
def best_candidate(spark, sf_dir):
    return _rounded(scoring.best_candidate(_scored(spark, sf_dir)))


@query
def link_threshold(spark, sf_dir):
    best = scoring.link_threshold(scoring.best_candidate(_scored(spark, sf_dir)))
    return _rounded(best.select("warc_id", "mention", "kb_id", "score"))


@query
def link_entities(spark, sf_dir):
    return linking.link_entities(t.docs(spark, sf_dir), *_knowledge(spark, sf_dir), **_lemma_options(spark, sf_dir))


@query
def link_entities_shared_ids(spark, sf_dir):
    """Links of documents that go by the name of their source, so each id stands for many records, scored one by one."""
    rows = t.table(spark, sf_dir, "documents").select(F.col("source").alias("warc_id"), F.col("text").alias("body"))
    return linking.link_entities(rows, *_knowledge(spark, sf_dir), **_lemma_options(spark, sf_dir))


@query
def link_entities_from_responses(spark, sf_dir):
    """Links whose candidates and abstracts come from stored answers of the two services."""
    options = _lemma_options(spark, sf_dir)
    docs = t.docs(spark, sf_dir)
    counts = stored(linking.record_counts(keyed(docs), **options), "mentions")
    names = stored(counts.select("mention").distinct(), "names")
    hits = responses.flatten_hits(_hits_json(spark, sf_dir, names))
    candidates = search.label_sets(search.top_hits(hits))
    descriptions = responses.flatten_bindings(_bindings_json(spark, sf_dir))
    return linking.link_entities(docs, counts=counts, candidates=candidates, descriptions=descriptions, **options)


@query
def link_entities_by_type(spark, sf_dir):
    """Links of typed entities only, in records and descriptions alike."""
    gazetteer = stored(t.gazetteer(spark, sf_dir), "gazetteer")
    return linking.link_entities(t.docs(spark, sf_dir), *_knowledge(spark, sf_dir), gazetteer=gazetteer, **_lemma_options(spark, sf_dir))


@query
def linked_entities(spark, sf_dir):
    labels, triples = _knowledge(spark, sf_dir)
    options = _lemma_options(spark, sf_dir)
    rows = linking.linked_entities(t.docs(spark, sf_dir), labels, triples, **options)
    flat = [F.array_join(c, "|").alias(c) for c in ("labels", "nouns")]
    return _rounded(rows.select("warc_id", "name", "kb_id", "abstract", "score", *flat))


@query
def link_entities_with_lexicon(spark, sf_dir):
    """Links with tags learned from the corpus: words mostly in lower case are no proper nouns."""
    options = _lemma_options(spark, sf_dir)
    docs = t.docs(spark, sf_dir)
    words = stored(m.word_arrays(keyed(docs), *options.values()), "words")
    lexicon = stored(m.tag_lexicon(words).select("word", "tag"), "lexicon")
    counts = stored(linking.record_counts(keyed(docs), words=words, tag_lexicon=lexicon, **options), "mentions")
    return linking.link_entities(docs, *_knowledge(spark, sf_dir), counts=counts, tag_lexicon=lexicon, **options)


@query
def link_entities_streamed(spark, sf_dir):
    """Links of page records that arrive in two batches or more."""
    folder = t.page_archive(spark, sf_dir)
    n_files = spark.read.format("binaryFile").load(folder).select("path").count()
    path, checkpoint = fresh_path(spark, "links"), fresh_path(spark, "checkpoint")
    stream = streamed.link_stream(
        spark, folder, *_knowledge(spark, sf_dir), path, checkpoint, max_files=max(1, n_files // 2), available_now=True, **_lemma_options(spark, sf_dir)
    )
    stream.awaitTermination()
    return streamed.read_links(spark, path)


@query
def links_tsv(spark, sf_dir):
    path = fresh_path(spark, "links")
    links.write_links(link_entities(spark, sf_dir), path)
    return links.read_links(spark, path)


@query
def link_eval(spark, sf_dir):
    """The fixed tag rule takes sentence starts for names, so these figures say nothing about a trained tagger."""
    scores = evaluation.link_eval(link_entities(spark, sf_dir), _gold(spark, sf_dir), keys=("warc_id", "kb_id"))
    return scores.select(
        "gold", "linked", "correct", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    )


REGISTRY["lemmas"] = REGISTRY.pop("lemmas_of_words")
