"""Files of public tokenizers as tables, loaded once in each Python process."""

from __future__ import annotations

import base64
import functools
import json
from dataclasses import dataclass

# Fixed value: the pattern that cuts text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Vocabulary:
    """``ids``: bytes of each token to its id. ``specials``: strings that are a token of their own. ``merges``: pairs of ids to the
    id they form, for files that list their merges."""

    ids: dict[bytes, int]
    specials: dict[str, int]
    merges: dict[tuple[int, int], tuple[int, int]]


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in JSON vocabularies: itself, or the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> Vocabulary:
    """A file of lines ``base64-token rank``."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, {}, {})


@functools.lru_cache(maxsize=4)
def load_json(path: str) -> Vocabulary:
    """A byte-level BPE file of the tokenizers library. ``merges`` maps a pair to its place in the list and the id it forms."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    letters = byte_letters()
    names = whole["model"]["vocab"]
    specials = {t["content"]: t["id"] for t in whole["added_tokens"]}
    ids = {bytes(letters[c] for c in name): i for name, i in names.items() if name not in specials}
    merges = {}
    for place, pair in enumerate(whole["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[names[left], names[right]] = (place, names[left + right])
    return Vocabulary(ids, specials, merges)
