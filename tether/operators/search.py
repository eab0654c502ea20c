"""Candidate search: free-text label lookup with exact top-k, and the label sets built from its hits.

Relevance of a label for a mention is the summed inverse document frequency of their shared lower-case words over the square root of
the label's word count, rounded to six digits. Hits rank by relevance, then shorter label, then id, then label text.

A plain inverted-index join would pair every mention holding a common word with every label holding it. Instead both sides are cut
down without losing a hit. Words are ordered from common to rare; the *prefix* of a text at one of its words is that word plus the
text's more common words. A hit is found at the rarest word it shares with the mention, and there its relevance depends only on the
two prefixes and the label's length. So

* labels with the same prefix differ in length alone, and only the first ``size`` of them can ever be hits there;
* mentions with the same prefix have the same hits there, so each distinct prefix is searched once.

The more common a word is, the fewer distinct prefixes end in it, so the hottest words have the shortest lists.

The prefixes of a mention together grow with the square of its words. So a mention of very many label words is not cut into prefixes: its
words stay rows, meet the same lists, and what a label shares with it is added up over a join with those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.operators.joins import balanced_join
from tether.operators.rows import exploded, short_key
from tether.session import stored


# Distinct label words up to which a mention is cut into prefixes.
LONG_MENTION = 64


def label_words(text: Column) -> Column:
    """Lower-case words of a label or mention."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _by_commonness(rows: DataFrame, keys: list[str], weights: DataFrame) -> DataFrame:
    """Regroup ``(keys, word)`` rows into ``feats``: the words with their weight, common to rare. Words no label has are dropped."""
    return (
        rows.join(weights, "word")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("rarity", "word", "idf"))).alias("feats"))
    )


def _short_key(words: Column) -> Column:
    """Words as one string to group by."""
    return short_key(F.array_join(words, " "))


def _words_of(feats: Column) -> Column:
    return F.transform(feats, lambda f: f["word"])


def _prefixes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per word of ``feats``: the word, a key of its prefix and the prefix itself."""
    at = exploded(rows, [*keys, "feats"], "feats", "feat", "at")
    prefix = F.slice("feats", F.lit(1), F.col("at") + 1)
    return at.select(*keys, F.col("feat.word").alias("word"), _short_key(_words_of(prefix)).alias("prefix_key"), prefix.alias("prefix"))


def _relevance(shared: Column, n_words: Column) -> Column:
    total = F.aggregate(shared, F.lit(0.0), lambda acc, f: acc + f["idf"])
    return F.round(total / F.sqrt(n_words), 6)


def _hit_order() -> list[Column]:
    return [F.desc("search_score"), F.col("n_words"), F.col("kb_id"), F.col("label")]


def word_weights(labels: DataFrame) -> DataFrame:
    """``(word, rarity, idf)`` over the distinct labels; ``rarity`` sorts common words first."""
    rows = labels.select("kb_id", "label").distinct()
    n_labels = rows.agg(F.count("*").alias("n_labels")).scalar()
    return (
        exploded(rows, [], F.array_distinct(label_words(F.col("label"))), "word")
        .groupBy("word")
        .agg(F.count("*").alias("df"))
        .select(
            "word",
            (-F.col("df")).alias("rarity"),
            (1.0 + F.log(n_labels / (F.col("df") + 1))).alias("idf"),
        )
    )


def _prefix_hits(queries: DataFrame, postings: DataFrame, size: int) -> DataFrame:
    """``(query, kb_id, label, n_words, search_score)`` of ``queries (query, feats)``, each distinct prefix of them searched once."""
    query_prefixes = _prefixes(queries, ["query"])
    in_prefix = W.partitionBy("prefix_key").orderBy(*_hit_order())
    shared = F.filter("label_prefix", lambda f: F.array_contains("prefix", f["word"]))
    searched = query_prefixes.select("word", "prefix_key", _words_of(F.col("prefix")).alias("prefix")).distinct()
    prefix_hits = (
        balanced_join(searched, postings, "word")
        .select("prefix_key", "kb_id", "label", "n_words", _relevance(shared, F.col("n_words")).alias("search_score"))
        .withColumn("place", F.row_number().over(in_prefix))
        .where(F.col("place") <= size)
        .drop("place")
    )
    return query_prefixes.select("query", "prefix_key").join(prefix_hits, "prefix_key").drop("prefix_key")


def _word_hits(words: DataFrame, postings: DataFrame) -> DataFrame:
    """``_prefix_hits`` of queries given as rows ``(query, word, idf)``: a row per word, per label met at it, and per word they share."""
    met = words.select("query", "word").join(postings, "word")
    each = exploded(met, ["query", "word", "kb_id", "label", "n_words"], _words_of(F.col("label_prefix")), "other")
    shared = each.join(words.select("query", F.col("word").alias("other"), "idf"), ["query", "other"])
    # Added from common to rare words, as everywhere, so equal relevances are equal to the last digit.
    ordered = shared.groupBy("query", "word", "kb_id", "label", "n_words").agg(F.array_sort(F.collect_list(F.struct("idf", "other"))).alias("feats"))
    return ordered.select("query", "kb_id", "label", "n_words", _relevance(F.col("feats"), F.col("n_words")).alias("search_score"))


def search_hits(mentions: DataFrame, labels: DataFrame, size: int = 100) -> DataFrame:
    """First ``size`` label hits of each distinct mention: ``(mention, kb_id, label, n_words, search_score, rank)``.

    ``mentions`` has a column ``mention``, ``labels`` has ``kb_id`` and ``label``. Any shared word makes a hit.
    """
    weights = word_weights(labels)
    label_rows = labels.select("kb_id", "label").distinct().withColumn("words", label_words(F.col("label")))
    label_feats = _by_commonness(
        exploded(label_rows, ["kb_id", "label", F.size("words").alias("n_words")], F.array_distinct("words"), "word"),
        ["kb_id", "label", "n_words"],
        weights,
    )
    same_prefix = W.partitionBy("prefix_key").orderBy("n_words", "kb_id", "label")
    postings = (
        _prefixes(label_feats, ["kb_id", "label", "n_words"])
        .withColumn("place", F.row_number().over(same_prefix))
        .where(F.col("place") <= size)
        .select("word", F.col("prefix").alias("label_prefix"), "kb_id", "label", "n_words")
    )

    mention_words = F.array_distinct(label_words(F.col("mention")))
    mention_feats = stored(
        _by_commonness(exploded(mentions.select("mention").distinct(), ["mention"], mention_words, "word"), ["mention"], weights).select(
            "mention", "feats", _short_key(_words_of(F.col("feats"))).alias("query")
        ),
        "mention-words",
    )
    queries = mention_feats.select("query", "feats").distinct()
    postings = stored(postings, "postings")
    found = _prefix_hits(queries.where(F.size("feats") <= LONG_MENTION), postings, size)
    long_ones = stored(exploded(queries.where(F.size("feats") > LONG_MENTION), ["query"], "feats", "feat"), "long-mentions")
    if not long_ones.isEmpty():
        found = found.unionByName(_word_hits(long_ones.select("query", "feat.word", "feat.idf"), postings))

    # A label met at several words of a query has its full relevance at the rarest shared one, which is the greatest.
    in_query = W.partitionBy("query").orderBy(*_hit_order())
    query_hits = (
        found.groupBy("query", "kb_id", "label", "n_words")
        .agg(F.max("search_score").alias("search_score"))
        .withColumn("rank", F.row_number().over(in_query))
        .where(F.col("rank") <= size)
    )
    return mention_feats.select("mention", "query").join(query_hits, "query").drop("query")


def top_hits(hits: DataFrame, results: int = 10) -> DataFrame:
    """First ``results`` hits of each mention; ``hits`` may come from ``search_hits`` or from parsed search responses.

    Hits of a response with equal scores keep their order there (``pos``).
    """
    order = [F.desc("search_score")]
    order += [F.col(c) for c in ("pos", "n_words", "kb_id", "label") if c in hits.columns]
    best = W.partitionBy("mention").orderBy(*order)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= results)


def label_sets(hits: DataFrame) -> DataFrame:
    """Hits grouped to ``(mention, kb_id, labels, search_score)``: the label set and the best relevance of each id."""
    return hits.groupBy("mention", "kb_id").agg(
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("search_score").alias("search_score"),
    )


def search(mentions: DataFrame, labels: DataFrame, size: int = 20) -> DataFrame:
    """Label sets of the first ``size`` hits, without a second ranking."""
    return label_sets(search_hits(mentions, labels, size))


def best_candidates(mentions: DataFrame, labels: DataFrame, size: int = 100, results: int = 10) -> DataFrame:
    """Candidates of each mention: the best ``results`` of the first ``size`` hits, then grouped by id.

    Both cuts use one order, so the smaller of the two is taken in the search already.
    """
    return label_sets(search_hits(mentions, labels, min(size, results)))
