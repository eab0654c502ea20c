"""Noun lemmas by suffix rules against a table of known words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.functions import words as fw
from tether.operators.joins import with_few
from tether.operators.rows import exploded, looked_up, word_maps
from tether.session import stored

# Noun endings and what replaces them, in order of preference.
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)
# More endings of irregular words than this are not listed: every token is asked for then.
MOST_ENDINGS = 256


def _shortened(word: Column) -> Column:
    """Forms one rule away from ``word``."""
    forms = [
        F.when(word.endswith(old), F.concat(F.substr(word, F.lit(1), F.length(word) - len(old)), F.lit(new)))
        for old, new in NOUN_ENDINGS
    ]
    return F.filter(F.array_compact(F.array(*forms)), lambda f: f != "")


def lemma_forms(word: Column) -> Column:
    """All forms the rules lead to, as ``(level, form)``; the word itself and its first forms share level 0.

    Each rule leaves a shorter word or one without an ending to take off, so as many rounds as letters reach every form.
    """
    # Rounds work on (level, form) pairs; a round adds the forms one rule away from the last level.
    first = F.array(F.struct(F.lit(0).alias("level"), word.alias("form")))
    one = F.transform(_shortened(word), lambda f: F.struct(F.lit(0).alias("level"), f.alias("form")))

    def add_level(state: Column, level: Column) -> Column:
        nxt = F.flatten(F.transform(state["last"], _shortened))
        rows = F.transform(nxt, lambda f: F.struct(level.alias("level"), f.alias("form")))
        return F.struct(F.concat(state["all"], rows).alias("all"), nxt.alias("last"))

    start = F.struct(F.concat(first, one).alias("all"), _shortened(word).alias("last"))
    rounds = F.when(F.size(_shortened(word)) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, start, add_level, lambda state: state["all"])


def lemmas(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(word, lemma)`` of the distinct words: the shortest known form of the first level that has one, else the word itself.

    Of equally short forms the one reached first wins.

    ``lexicon`` is a table ``word``; ``exceptions`` is ``(word, form)`` and, for a word it lists, replaces the rules.
    """
    distinct = words.select("word").distinct()
    forms = exploded(distinct, ["word"], lemma_forms(F.col("word")), "f", "turn").select("word", "turn", "f.level", "f.form")
    if exceptions is not None:
        listed = exceptions.select("word").distinct()
        forms = forms.join(listed, "word", "left_anti").unionByName(
            distinct.join(exceptions.select("word", "form"), "word")
            .select("word", F.posexplode(F.array("word", "form")).alias("turn", "form"))
            .select("word", "turn", F.lit(0).alias("level"), "form")
        )
    known = forms.join(lexicon.select(F.col("word").alias("form")).distinct(), "form", "left_semi")
    best = known.groupBy("word").agg(F.min(F.struct("level", F.length("form").alias("size"), "turn", "form"))["form"].alias("lemma"))
    return distinct.join(best, "word", "left").select("word", F.coalesce("lemma", "word").alias("lemma"))


def may_change(word: Column) -> Column:
    """Whether some rule applies to ``word``."""
    ends = F.lit(False)
    for old, _ in NOUN_ENDINGS:
        ends |= word.endswith(old)
    return ends


def changing_endings(exceptions: DataFrame | None = None) -> list[str] | None:
    """Endings that every word has whose lemma may be another word; None if irregular words have too many. Collects ``MOST_ENDINGS`` at most."""
    # The shortest ones say it all: most noun endings end in "s" themselves.
    nouns = [old for old, _ in NOUN_ENDINGS]
    endings = [e for e in nouns if not any(e != other and e.endswith(other) for other in nouns)]
    if exceptions is not None:
        last = exceptions.where("word <> ''").select(F.right("word", F.lit(2)).alias("ending")).distinct()
        rows = last.where(~may_change(F.col("ending"))).limit(MOST_ENDINGS + 1).collect()
        if len(rows) > MOST_ENDINGS:
            return None
        endings += sorted(r.ending for r in rows)
    return endings


def changed_words(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(word, new)``: the distinct words of ``words (word)`` whose lemma is another word."""
    distinct = words.select("word").distinct()
    some = distinct.where(may_change(F.col("word")))
    if exceptions is not None:
        some = some.unionByName(distinct.join(exceptions.select("word").distinct(), "word", "left_semi")).distinct()
    return lemmas(some, lexicon, exceptions).where("lemma <> word").select("word", F.col("lemma").alias("new"))


def capitals_decide(lexicon: DataFrame, exceptions: DataFrame | None = None) -> bool:
    """Whether, under tags by capitalisation, no lemma of any but a capitalised word can change a mention.

    Endings never change a word's first letter, so such a word stays what it is, a gap between names, unless its lemma has no letter
    that cleaning leaves, or is listed as irregular with a form of another kind. Word tables of usual make have neither.
    """
    odd = lexicon.where(~F.col("word").rlike("[A-Za-z]")).select("word")
    if exceptions is not None:
        first = lambda c: F.regexp_extract(fw.clean(fw.strip_hex(F.col(c))), "^.", 0)
        other_kind = ~first("word").rlike("[A-Z]") & ((first("form") == "") | first("form").rlike("[A-Z]"))
        odd = odd.unionByName(exceptions.where(other_kind).select("word"))
    return odd.isEmpty()


def swaps(listed: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None, made: Callable[[Column], Column] = lambda lemma: lemma) -> DataFrame:
    """``(warc_id, swaps)``: for each row of ``listed (warc_id, words)`` that has words whose lemma is another word, these as ``word_maps``.

    ``listed`` is read twice, so it should be a stored table. Each distinct word is looked up once; the words of a document in order
    are never shuffled. They hold what ``made`` makes of a lemma.
    """
    changed = changed_words(exploded(listed, [], "words", "word"), lexicon, exceptions).select("word", made(F.col("new")).alias("new"))
    return swap_maps(listed, changed)


def swap_maps(listed: DataFrame, changed: DataFrame) -> DataFrame:
    """``(warc_id, swaps)``: for each row of ``listed (warc_id, words)`` that has words of ``changed (word, new)``, these as ``word_maps``."""
    pairs = exploded(listed, ["warc_id"], "words", "word").join(with_few(stored(changed, "changed")), "word")
    return word_maps(pairs, "word", "new", "swaps")


def swapped(words: Column) -> Column:
    """``words`` with those of the column ``swaps`` in place of them."""
    return F.when(F.col("swaps").isNull(), words).otherwise(F.transform(words, lambda w: F.coalesce(looked_up("swaps", w), w)))


def lemmatise_words(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(warc_id, words)`` with every word replaced by its lemma, in the document's row."""
    listed = F.array_distinct("words")
    if exceptions is None:
        listed = F.filter(listed, may_change)
    asked = stored(words.select("warc_id", listed.alias("words")), "words-asked")
    return words.join(swaps(asked, lexicon, exceptions), "warc_id", "left").select("warc_id", swapped(F.col("words")).alias("words"))
