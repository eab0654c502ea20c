"""Cutting text for byte-level BPE: at spaces first, so that equal stretches are encoded once, then by the vocabulary's pattern.

The pattern puts one space before the run it belongs to. A cut before a space therefore falls between two pieces, unless white space
stands on both sides of it; a text with such a place is cut by the pattern as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import regex


class Uncut(Exception):
    """The text must not be cut at single spaces."""


class Stretches(dict):
    """Values of stretches (a space and what follows up to the next one), computed on first use and kept up to ``limit`` of them.

    A full store keeps its entries, which are mostly the frequent stretches, and starts anew after many further misses, so that it
    follows a change of language. What it holds never changes a result.
    """

    def __init__(self, value: Callable[[str], object], limit: int = 400_000):
        super().__init__()
        self.value, self.limit, self.misses = value, limit, 0

    def __missing__(self, stretch: str):
        if not stretch or stretch[0].isspace():
            raise Uncut
        value = self.value(" " + stretch)
        if len(self) < self.limit:
            self[stretch] = value
        else:
            self.misses += 1
            if self.misses > 8 * self.limit:
                self.clear()
                self.misses = 0
        return value


def cut(text: str) -> tuple[str, list[str]]:
    """The start of ``text`` up to its first space, and the stretches after each space without that space."""
    first, *rest = text.split(" ")
    return first, rest


def splitter(specials: list[str]) -> Callable[[str], list[str]]:
    """Splits a text at special strings: ordinary text at even places, special strings at odd ones."""
    if not specials:
        return lambda text: [text]
    found = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")")
    return lambda text: found.split(text) if any(s in text for s in specials) else [text]
