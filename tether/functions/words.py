"""Tokens, cleaning and proper-noun mentions as expressions over one document.

A document stays one row: its tokens are an array, its runs are found inside the array, so nothing is shuffled to get from text to
mentions.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a token, as a regex class body.
SEPARATORS = r"""\t\n\x0B\f\r ,;:()\[\]{}<>"?!@#$%&"""
# Marks that stand alone between tokens.
BREAKS = ("--", "...", "''", "``")
# English clitics split from the word before them.
CLITICS = r"(n't|N'T|'(?:s|S|m|M|d|D|ll|LL|re|RE|ve|VE))\b"

NOUN = "NNP"
OTHER = "NN"

# English stop words, matched exactly and in lower case.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself she "
    "she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other some such no nor not only "
    "own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# The letters are listed rather than given as a range: the regex engine then tests one table per character.
_LETTERS = string.ascii_letters
_GAP = "\u0001"
# A separator, so no token holds it.
_MARK = "\u000b"


def _split_ready(text: Column) -> Column:
    for mark in BREAKS:
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, CLITICS, " $1")).otherwise(text)


def tokens(text: Column) -> Column:
    """Tokens of ``text`` in order; hyphenated and dotted words stay whole, clitics are split off."""
    return F.regexp_extract_all(_split_ready(text), F.lit(f"[^{SEPARATORS}]+"), F.lit(0))


def strip_hex(token: Column) -> Column:
    """Delete digit plus capital A-F pairs, left to right."""
    return F.regexp_replace(token, "[0-9][A-F]", "")


def strip_nonword(token: Column, unicode: bool = False) -> Column:
    """Delete what is no letter or digit: ASCII only by default, or any script with ``unicode=True``."""
    return F.regexp_replace(token, r"[^\p{L}\p{N}]+" if unicode else r"[\W_]+", "")


def strip_digits(token: Column) -> Column:
    return F.regexp_replace(token, "[0-9]", "")


def clean(token: Column, unicode: bool = False) -> Column:
    """Non-word characters, then digits, out of one token (hexadecimal pairs and lemma come before, see ``clean_words``)."""
    return strip_digits(strip_nonword(token, unicode))


def nonempty(words: Column) -> Column:
    return F.filter(words, lambda w: w != "")


def ready_text(text: Column) -> Column:
    """``text`` with nothing but separators between its tokens, and without hexadecimal pairs. Made once: digits left may form new pairs."""
    return strip_hex(_split_ready(text))


def only_letters(text: Column, unicode: bool = False) -> Column:
    """``clean_text`` of a ``ready_text`` column."""
    others = f"[^{_LETTERS}{SEPARATORS}]+"
    if unicode:
        others = rf"[^\p{{L}}\p{{N}}{SEPARATORS}]+|[0-9]+"
    return F.regexp_replace(text, others, "")


def clean_text(text: Column, unicode: bool = False) -> Column:
    """``text`` with its words cleaned in place: only letters and separators are left.

    None of the deletions can reach over a separator, so they may run on the whole text, before the split. With ``unicode=True`` letters
    of any script stay, and numbers that are no digits too, as in ``clean``.
    """
    return only_letters(ready_text(text), unicode)


def text_words(cleaned: Column, unicode: bool = False) -> Column:
    """Words of a ``clean_text`` column in order."""
    return F.regexp_extract_all(cleaned, F.lit(f"[^{SEPARATORS}]+" if unicode else f"[{_LETTERS}]+"), F.lit(0))


def clean_words(text: Column, unicode: bool = False) -> Column:
    """Cleaned, non-empty words of ``text`` in order; equal to cleaning each of ``tokens`` in turn."""
    return text_words(clean_text(text, unicode), unicode)


def token_pattern(endings: list[str] | None = None, capitalised: bool = False) -> str:
    """Regular expression of whole tokens that have one of ``endings``, if given, and become words with a capital first letter, if wanted."""
    token = f"[^{SEPARATORS}{_LETTERS}]*+[A-Z][^{SEPARATORS}]*+" if capitalised else f"[^{SEPARATORS}]++"
    ends = ""
    if endings is not None:
        # The last letter alone passes over most tokens.
        last = "|".join(sorted({re.escape(e[-1]) for e in endings}))
        ends = f"(?<={last})(?<={'|'.join(map(re.escape, endings))})"
    return f"(?<![^{SEPARATORS}]){token}{ends}"


def name_text(ready: Column) -> Column:
    """A ``ready_text`` with one small word for each stretch of tokens that become words with a small first letter.

    Under ``rule_tag`` such words are but gaps between names, so ``rule_mentions`` and ``rule_chunks`` find the same in what is left.
    """
    # From a small word on, tokens that are small words too, or hold no letter.
    bare, small, gap = f"[^{SEPARATORS}{_LETTERS}]*+", f"[a-z][^{SEPARATORS}]*+", f"[{SEPARATORS}]"
    return F.regexp_replace(ready, f"(?<![^{SEPARATORS}]){bare}{small}{gap}*+(?:{bare}(?:{small})?+{gap}++)*+", "x ")


def chosen_tokens(ready: Column, pattern: str) -> Column:
    """Distinct tokens of a ``ready_text`` that fit a ``token_pattern``; others never become array elements."""
    return F.array_distinct(F.regexp_extract_all(ready, F.lit(pattern), F.lit(0)))


def swapped_text(ready: Column, look_up: Callable[[Column], Column], pattern: str, unicode: bool = False) -> Column:
    """``only_letters`` of a ``ready_text`` with some tokens replaced by what ``look_up`` has for them, a cleaned word, unless it is null.

    Only tokens that fit ``pattern``, a ``token_pattern``, are looked up; the text between them stays in one piece.
    """
    # A separator no longer in the text sets them apart, so every second part is such a token.
    apart = F.replace(ready, F.lit(_MARK), F.lit(" "))
    parts = F.split(F.regexp_replace(apart, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    put = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.coalesce(look_up(p), p)).otherwise(p))
    return only_letters(F.array_join(put, ""), unicode)


def rule_tag(word: Column, unicode: bool = False) -> Column:
    """Tag of a word no lexicon knows: capitalised words are proper nouns."""
    # Words from "A" up to the character after "Z" are those that begin with a capital.
    capital = word.rlike(r"^\p{Lu}") if unicode else (word >= "A") & (word < "[")
    return F.when(capital, F.lit(NOUN)).otherwise(F.lit(OTHER))


def tag_by_rule(words: Column, unicode: bool = False) -> Column:
    """Array of words to array of ``(word, tag)``."""
    return F.transform(words, lambda w: F.struct(w.alias("word"), rule_tag(w, unicode).alias("tag")))


def is_stop_word(word: Column, stop_words: list[str] | None = None) -> Column:
    return word.isin(STOP_WORDS if stop_words is None else stop_words)


def long_or_acronym(word: Column) -> Column:
    """More than two characters, or all capitals."""
    return (F.length(word) > 2) | word.rlike("^[A-Z]+$")


def noun_words(tagged: Column, stop_words: list[str] | None = None) -> Column:
    """Single proper nouns of a tagged array in text order, without stop words and short words."""
    kept = F.filter(
        tagged,
        lambda t: (t["tag"] == NOUN) & long_or_acronym(t["word"]) & ~is_stop_word(t["word"], stop_words),
    )
    return F.transform(kept, lambda t: t["word"])


def noun_chunks(tagged: Column) -> Column:
    """Maximal stretches of proper nouns, each joined by a space, in text order."""
    marked = F.transform(tagged, lambda t: F.when(t["tag"] == NOUN, t["word"]).otherwise(F.lit(_GAP)))
    chunks = F.transform(F.split(F.array_join(marked, " "), _GAP, -1), lambda c: F.trim(c))
    return nonempty(chunks)


def noun_runs(tagged: Column) -> Column:
    """Stretches of two or more proper nouns, of any length."""
    return F.filter(noun_chunks(tagged), lambda c: F.contains(c, F.lit(" ")))


def mentions(tagged: Column, stop_words: list[str] | None = None) -> Column:
    """Mention bag of one document: single nouns in text order, then runs; duplicates kept."""
    return F.concat(noun_words(tagged, stop_words), noun_runs(tagged))


def rule_chunks(cleaned: Column) -> Column:
    """``noun_chunks`` under ``rule_tag``, taken straight from a ``clean_text`` column."""
    # A full stop takes the place of every other word; between full stops only proper nouns are left.
    gaps = F.regexp_replace(cleaned, f"[a-z](?<![{_LETTERS}].)[{_LETTERS}]*+", ".")
    return nonempty(F.transform(F.split(gaps, rf"\.[.{SEPARATORS}]*+", -1), lambda c: F.trim(F.regexp_replace(c, f"[{SEPARATORS}]+", " "))))


def rule_mentions(cleaned: Column, stop_words: list[str] | None = None) -> Column:
    """``mentions`` under ``rule_tag``, taken straight from a ``clean_text`` column.

    Words that are no proper nouns never become array elements, which is most of the work on ordinary text.
    """
    listed = STOP_WORDS if stop_words is None else stop_words
    capital_stops = [w for w in listed if w[:1].isupper()]
    words = F.filter(F.regexp_extract_all(cleaned, F.lit(f"[A-Z](?<![{_LETTERS}].)[{_LETTERS}]*+"), F.lit(0)), long_or_acronym)
    if capital_stops:
        words = F.filter(words, lambda w: ~w.isin(capital_stops))
    return F.concat(words, F.filter(rule_chunks(cleaned), lambda c: F.contains(c, F.lit(" "))))
