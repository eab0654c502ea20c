"""Repetition rules: characters inside duplicated n-grams and lines of a text, by rolling hashes in numpy.

All texts of a slice lie in one byte array. Word hashes are weighted sums of byte values, n-gram hashes roll from one length to the next,
and sorting them finds the n-grams a text holds more than once. A character counts once, however many duplicated n-grams cover it.

Words are runs of bytes other than 0x20 and 0x09-0x0D. Null and empty texts have no word and fail the base rules. Repeated rows get equal
results. One row per input row; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.llm.texts import map_texts

BASE = 3  # words in the windows of the base rule
# Percent of a text's word characters that n-grams of each length may hold, and that repeated lines may hold.
GRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_PERCENT = 20
MIN_WORDS = 50
REPEAT_PERCENT = 50

SEPARATOR = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that start a character

_draw = np.random.default_rng(20240601)
VALUES = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP, ROLL, SALT = (int(v) | 1 for v in _draw.integers(2**61, 2**63, 3))


def _hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each stretch of ``values`` from one start to the next; zeros in ``values`` do not count."""
    sizes = np.diff(np.append(starts, len(values)))
    weights = np.full(int(sizes.max()), STEP, dtype=np.uint64)
    weights[0] = 1
    weights = np.multiply.accumulate(weights)
    places = np.arange(starts[0], len(values)) - np.repeat(starts, sizes)
    return np.add.reduceat(values[starts[0] :] * weights[places], starts - starts[0])


def _repeated(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Which keys occur more than once, with or without the first occurrence."""
    order = np.argsort(keys, kind=None if first_too else "stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), dtype=bool)
    found[order[1:]] = same
    if first_too:
        found[order[:-1][same]] = True
    return found


def measure(texts: list[bytes], grams: Sequence[int] = tuple(GRAM_PERCENT)) -> dict[str, np.ndarray]:
    """Counts per text: words, their characters, symbols, repeated lines and n-grams. ``grams`` ascend."""
    n = len(texts)
    data = np.frombuffer(b"".join([t + b"\n" for t in texts]), dtype=np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    apart = SEPARATOR[data]
    opens = ~apart
    opens[1:] &= apart[:-1]
    starts = np.flatnonzero(opens)
    owner = np.searchsorted(text_ends, starts, side="right")
    characters = np.concatenate(([0], np.cumsum(LEAD[data] & ~apart)))
    word_ends = np.append(starts[1:], len(data))
    chars = characters[word_ends] - characters[starts]  # nothing but separators follows the word

    def per_text(owners: np.ndarray, amounts: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owners, amounts, minlength=n).astype(np.int64)

    symbols = np.flatnonzero(SYMBOL[data])
    out = {
        "n_words": per_text(owner),
        "word_chars": per_text(owner, chars),
        "n_symbols": per_text(np.searchsorted(text_ends, symbols, side="right")),
    }
    salts = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(SALT)

    # Lines, each with its line break.
    line_ends = np.flatnonzero(data == 0x0A)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    words_before = np.searchsorted(starts, np.append(line_starts, len(data)))
    line_owner = np.searchsorted(text_ends, line_starts, side="right")
    with_word = np.diff(words_before) > 0
    repeats = np.zeros(len(line_starts), dtype=bool)
    if with_word.any():
        keys = _hashes(VALUES[data], line_starts) + salts[line_owner]
        repeats[with_word] = _repeated(keys[with_word], first_too=False)
    line_chars = characters[np.append(line_starts[1:], len(data))] - characters[line_starts]
    out["n_dup_lines"] = per_text(line_owner[repeats])
    out["dup_line_chars"] = per_text(line_owner[repeats], line_chars[repeats])

    words = _hashes(np.where(apart, np.uint64(0), VALUES[data]), starts) if len(starts) else np.zeros(0, dtype=np.uint64)
    rolled, length = words, 1
    for gram in (BASE, *grams):
        while length < gram:
            rolled = rolled[:-1] * np.uint64(ROLL) + words[length:]
            length += 1
        count = max(0, len(words) - gram + 1)
        rolled = rolled[:count]
        inside = np.flatnonzero(owner[:count] == owner[gram - 1 : gram - 1 + count])
        found = inside[_repeated(rolled[inside] + salts[owner[inside]], first_too=True)]
        cover = np.zeros(len(words) + 1, dtype=np.int32)
        cover[found] = 1
        cover[found + gram] -= 1
        covered = np.cumsum(cover[:-1]) > 0
        if gram == BASE:
            out["n_repeat_words"] = per_text(owner[covered])
        else:
            out[f"dup_chars_{gram}"] = per_text(owner[covered], chars[covered])
    return out


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, dup_line_chars, dup_chars_…)``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words", *[f"dup_chars_{g}" for g in GRAM_PERCENT]]

    def work(texts: list[bytes]) -> dict:
        return {name: values.tolist() for name, values in measure(texts).items()}

    found = map_texts(docs, key, text, work, ", ".join(f"{name} long" for name in names), binary=True)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    limits = {"dup_line_chars": LINE_PERCENT} | {f"dup_chars_{g}": p for g, p in GRAM_PERCENT.items()}
    within = reduce(lambda a, b: a & b, [100 * F.col(c) <= p * F.col("word_chars") for c, p in limits.items()])
    judged = found.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & within)
    return judged.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *limits)
