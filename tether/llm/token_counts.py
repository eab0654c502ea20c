"""Exact BPE token counts at every prefix, by dynamic programming over prefixes.

The encoding of a prefix is that of a shorter prefix plus one last token, where the last token and the one before it form a pair the
merges leave alone. So one pass over a piece gives the count at each of its bytes, and counts of whole texts, of cut texts and of
budgets are sums and look-ups: nothing is encoded again.

Null and empty texts have no token. Special strings of the file count as one token. Other columns of the input are left out.
"""

from __future__ import annotations

import functools
from array import array
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.llm import vocabularies
from tether.llm.pieces import Stretches, Uncut, cut, splitter
from tether.llm.texts import map_texts

# The pieces of three characters whose first two characters alone would be cut after the apostrophe.
CONTRACTIONS = (b"'re", b"'ve", b"'ll")
# Known pairs and known pieces kept in a Python process.
PAIRS, PIECES = 1_000_000, 100_000
# Turn of a merge that does not take place.
NEVER = 1 << 62


def packed(counts: list[int]) -> Sequence[int]:
    """Counts in little memory; they never exceed their number."""
    return bytes(counts) if len(counts) < 256 else array("I", counts)


class PrefixCounts:
    """Counts for one vocabulary with listed merges."""

    def __init__(self, vocabulary: vocabularies.Vocabulary, pattern: str = vocabularies.PATTERN):
        self.ids, self.merges = vocabulary.ids, vocabulary.merges
        self.places = {pair: place for pair, (place, _) in self.merges.items()}
        self.split = splitter(list(vocabulary.specials))
        self.find = regex.compile(pattern).findall
        self.endings = ahocorasick.Automaton()
        for name, token in self.ids.items():
            self.endings.add_word(name.decode("latin-1"), (token, len(name)))
        self.endings.make_automaton()
        self._spines()
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[bytes, Sequence[int]] = {}
        self.stretches = Stretches(self.stretch)

    def _spines(self) -> None:
        """Of each token, what stands at its left and right edge while it is built, and when that is merged into something larger."""
        self.left_edge: dict[int, tuple[tuple[int, int], ...]] = {}
        self.right_edge: dict[int, tuple[tuple[int, int], ...]] = {}
        parts = {made: (pair, place) for pair, (place, made) in self.merges.items()}
        for token in sorted(self.ids.values(), key=lambda t: parts[t][1] if t in parts else -1):
            if token in parts:
                (a, b), place = parts[token]
                left, right = self.left_edge[a], self.right_edge[b]
                self.left_edge[token] = (*left[:-1], (left[-1][0], place), (token, NEVER))
                self.right_edge[token] = (*right[:-1], (right[-1][0], place), (token, NEVER))
            else:
                self.left_edge[token] = self.right_edge[token] = ((token, NEVER),)

    def stands(self, left: int, right: int) -> bool:
        """Whether the merges keep ``left`` and ``right`` as neighbours.

        While both are built, what stands on the two sides of the border changes; a merge across the border whose turn comes before
        the next of these changes would join them. At equal turns the pair further left goes first.
        """
        kept, i, j = True, 0, 0
        a, b = self.right_edge[left], self.left_edge[right]
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            place = self.places.get((x, y), NEVER)
            if place < x_ends and place <= y_ends and place != NEVER:
                kept = False
                break
            if x_ends == y_ends == NEVER:
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = kept
        return kept

    def piece(self, piece: bytes) -> Sequence[int]:
        """Counts after 1, 2, … bytes of a piece."""
        counts = self.pieces.get(piece)
        if counts is not None:
            return counts
        # The automaton gives all tokens that end at each byte, from long to short.
        pairs, last, found, end = self.pairs, [0], [0], -1
        for at, (token, size) in self.endings.iter(piece.decode("latin-1")):
            if at == end:
                continue
            start = at + 1 - size
            if start:
                kept = pairs.get(last[start] << 32 | token)
                if not (self.stands(last[start], token) if kept is None else kept):
                    continue
            last.append(token)
            found.append(found[start] + 1)
            end = at
        if piece in CONTRACTIONS:
            found[2] = 2
        counts = packed(found[1:])
        if len(piece) < 100:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            self.pieces[piece] = counts
        return counts

    def stretch(self, text: str) -> Sequence[int]:
        """Counts after each byte of a text that is cut by the pattern alone."""
        pieces = self.find(text)
        if len(pieces) == 1:
            return self.piece(text.encode())
        counts: list[int] = []
        for piece in pieces:
            so_far = counts[-1] if counts else 0
            counts.extend([so_far + n for n in self.piece(piece.encode())])
        return packed(counts)

    def parts(self, text: str) -> list[tuple[str, Sequence[int]]]:
        """``text`` cut into parts, each with its own counts after each byte."""
        out: list[tuple[str, Sequence[int]]] = []
        for place, run in enumerate(self.split(text)):
            if place % 2:
                n = len(run.encode())
                out.append((run, (*[n + 1] * (n - 1), 1)))  # cannot be cut inside
            elif run:
                first, rest = cut(run)
                try:
                    counts = list(map(self.stretches.__getitem__, rest))
                    if first:
                        out.append((first, self.stretch(first)))
                    out.extend(zip(map(" ".__add__, rest), counts))
                except Uncut:
                    out.extend((p, self.piece(p.encode())) for p in self.find(run))
        return out

    def at_prefixes(self, text: str) -> list[int]:
        """Count after each byte of ``text``, exact where a prefix ends with a whole character that is no white space."""
        counts: list[int] = []
        for _, part in self.parts(text):
            so_far = counts[-1] if counts else 0
            counts.extend(so_far + n for n in part)
        return counts

    def measure(self, text: str, budget: int) -> tuple[int, int]:
        """``(tokens, bytes)``: tokens of ``text``, and bytes of its longest prefix of at most ``budget`` tokens.

        A prefix that ends in white space or inside a character is not considered; a text within the budget fits whole.
        """
        parts = self.parts(text)
        totals = list(accumulate([counts[-1] for _, counts in parts], initial=0))
        if totals[-1] <= budget:
            return totals[-1], len(text.encode())
        for i in range(bisect_right(totals, budget) - 1, -1, -1):
            part, counts = parts[i]
            size = len(counts)
            for char in reversed(part):
                if not char.isspace() and totals[i] + counts[size - 1] <= budget:
                    return totals[-1], sum(len(c) for _, c in parts[:i]) + size
                size -= len(char.encode())
        return totals[-1], 0


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounts:
    return PrefixCounts(vocabularies.load_json(path))


def token_counts(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit, fit_bytes)``: ``fit_bytes`` is the longest prefix within ``limit`` tokens, see ``measure``.

    One row per input row, repeated and null keys too.
    """

    def work(texts: list[str]) -> dict:
        found = [_counter(path).measure(t, limit) for t in texts]
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": [n for n, _ in found], "fit_bytes": [b for _, b in found]}

    counted = map_texts(docs, key, text, work, "n_bytes long, n_tokens long, fit_bytes long")
    return counted.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_bytes")
