"""Byte-level BPE by merge replay over the distinct pieces of many texts at once, and decoding.

All distinct pieces of a batch of texts lie in one array of symbols. An index from pair to positions is kept as the rank of the pair that
starts at each position; ranks are replayed in order, each merge is applied at all its positions in one step, and only the pairs with
the neighbours of a merged symbol are looked up again.

Null and empty texts encode to no token. Special strings are ordinary text. Other columns of the input are left out.
"""

from __future__ import annotations

import functools
import hashlib
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame

from tether.llm import vocabularies
from tether.llm.pieces import cut
from tether.llm.texts import map_texts

# Ranks that share one scan of the index.
WINDOW = 512
NO_RANK = np.int32(2**31 - 1)
# Stretches of text kept with their ids in a Python process.
KNOWN = 300_000


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


class Strings:
    """Byte strings by number."""

    def __init__(self, strings: list[bytes]):
        self.bytes = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def join(self, numbers: np.ndarray) -> bytes:
        lengths = self.lengths[numbers]
        places = np.cumsum(lengths) - lengths
        at = np.repeat(self.starts[numbers] - places, lengths)
        return self.bytes[at + np.arange(len(at))].tobytes()


class MergeReplay:
    """Encodes and decodes with the ranks of ``vocabulary``."""

    def __init__(self, vocabulary: vocabularies.Vocabulary, pattern: str = vocabularies.PATTERN):
        ids = vocabulary.ids
        self.ids = ids
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([ids[bytes((b,))] for b in range(256)], dtype=np.int32)
        pairs = [
            (ids[name[:i]] << 32 | ids[name[i:]], rank)
            for name, rank in ids.items()
            for i in range(1, len(name))
            if name[:i] in ids and name[i:] in ids
        ]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], dtype=np.int32)
        self.top = max(ids.values()) + 1
        names = {i: name for name, i in ids.items()}
        self.digits = Strings([b"%d," % i for i in range(self.top)])
        self.decoded = Strings([names.get(i, b"") for i in range(self.top)])
        self.known: dict[str, bytes] = {}
        self.missed = 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two symbols; ``NO_RANK`` where there is none (a symbol of -1 has none)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (right >= 0), self.pair_ranks[at], NO_RANK)

    def one(self, piece: bytes) -> list[int]:
        """Tokens of a piece, merging the leftmost pair of lowest rank each time."""
        parts = [bytes((b,)) for b in piece]
        while len(parts) > 1:
            rank, i = min((self.ids.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NO_RANK:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts]

    def replay(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit numbers."""
        if not pieces:
            return []
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        starts = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        symbols = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)], np.int32(-1)).astype(np.int32)
        # Position n stands for "none": its symbol is -1, so it takes part in no merge.
        following = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        following[starts + lengths - 1] = n
        before[starts] = n
        following[n] = before[n] = n
        rank_at = self.ranks(symbols, symbols[following])
        rank_at[n] = NO_RANK
        alive = np.ones(n + 1, dtype=bool)
        redo: set[int] = set()
        for low in range(0, self.top, WINDOW):
            high = low + WINDOW
            found = np.flatnonzero((rank_at >= low) & (rank_at < high))
            if len(found):
                self._window(high, found, symbols, following, before, rank_at, alive, starts, redo)
        kept = np.flatnonzero(alive[:n])
        ends = np.searchsorted(kept, starts + lengths) * 4
        ids = symbols[kept].astype("<u4").tobytes()
        out, a = [], 0
        for b in ends.tolist():
            out.append(ids[a:b])
            a = b
        for i in redo:
            out[i] = np.array(self.one(pieces[i]), dtype="<u4").tobytes()
        return out

    def _window(self, high, found, symbols, following, before, rank_at, alive, starts, redo) -> None:
        """Replay the merges below rank ``high`` that are in the index, and those which they bring about."""
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def add(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            bounds = [*_runs(ranks).tolist(), len(ranks)]
            for a, b in zip(bounds, bounds[1:]):
                rank = int(ranks[a])
                if rank not in index:
                    index[rank] = []
                    heappush(waiting, rank)
                index[rank].append(positions[a:b])

        add(found, rank_at[found])
        while waiting:
            rank = heappop(waiting)
            lists = index.pop(rank)
            left = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left = left[rank_at[left] == rank]
            if not len(left):
                continue
            right = following[left]
            if len(left) > 1:
                # In a row of equal symbols a merge takes away the start of the next one: every other one is left.
                chained = right[:-1] == left[1:]
                if chained.any():
                    place = np.arange(len(left))
                    opens = np.concatenate(([True], ~chained))
                    keep = (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
                    left, right = left[keep], right[keep]
            after = following[right]
            symbols[left] = rank
            following[left] = after
            before[after] = left
            before[-1] = len(symbols) - 1
            alive[right] = False
            rank_at[right] = NO_RANK
            lead = before[left]
            touched = np.concatenate((left, lead[lead < len(symbols) - 1]))
            ranks = self.ranks(symbols[touched], symbols[following[touched]])
            rank_at[touched] = ranks
            early = ranks < rank
            if early.any():
                # A merge of lower rank has come up: the order of this piece's merges is settled on its own.
                redo.update((np.searchsorted(starts, touched[early], side="right") - 1).tolist())
                rank_at[touched[early]] = NO_RANK
            soon = ~early & (ranks < high)
            if soon.any():
                add(touched[soon], ranks[soon])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. All pieces of ``texts`` that are not known yet are replayed together."""
        known = self.known
        cuts = []  # of each text: pieces at its start (or all of it), ids of its stretches after spaces, which of them are missing
        unknown: set[str] = set()
        for text in texts:
            first, rest = cut(text)
            ids = list(map(known.get, rest))
            missing = [(i, s) for i, (s, v) in enumerate(zip(rest, ids)) if v is None] if None in ids else []
            if any(not s or s[0].isspace() for _, s in missing):
                cuts.append((self.find(text), [], []))
            else:
                unknown.update([s for _, s in missing])
                cuts.append((self.find(first), ids, missing))
        pieces_of = {s: self.find(" " + s) for s in unknown}
        distinct = {p for pieces in pieces_of.values() for p in pieces}
        distinct.update(p for pieces, _, _ in cuts for p in pieces)
        ids_of = {p: known[p[1:]] for p in distinct if p[0] == " " and p[1:] in known}
        listed = [p for p in distinct if p not in ids_of]
        ids_of.update(zip(listed, self.replay([p.encode() for p in listed])))
        fresh = {s: b"".join([ids_of[p] for p in pieces]) for s, pieces in pieces_of.items()}
        out = []
        for pieces, ids, missing in cuts:
            for i, s in missing:
                ids[i] = fresh[s]
            out.append(b"".join([ids_of[p] for p in pieces] + ids))
        known.update(fresh)
        self._forget(fresh)
        return out

    def _forget(self, fresh: dict[str, bytes]) -> None:
        """Hold the store at ``KNOWN`` stretches: the newest go, and once many have gone everything does, to follow other text."""
        over = len(self.known) - KNOWN
        if over > 0:
            for s in islice(fresh, over):
                del self.known[s]
            self.missed += over
            if self.missed > 4 * KNOWN:
                self.known, self.missed = {}, 0

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decoded.join(ids)

    def decimal(self, ids: np.ndarray) -> bytes:
        """``ids`` as decimal numbers joined by commas."""
        return self.digits.join(ids)[:-1]


@functools.lru_cache(maxsize=2)
def _replay(path: str) -> MergeReplay:
    return MergeReplay(vocabularies.load_ranks(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids binary)``: little-endian unsigned 32-bit ids of each text by the rank file at ``path``."""
    return map_texts(docs, key, text, lambda texts: {"ids": _replay(path).encode(texts)}, "ids binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: digests of the decimal ids joined by commas and of the decoded ids."""

    def work(texts: list[str]) -> dict:
        replay = _replay(path)
        listed = [np.frombuffer(ids, dtype="<u4") for ids in replay.encode(texts)]
        return {
            "n_tokens": [len(ids) for ids in listed],
            "ids_sha256": [hashlib.sha256(replay.decimal(ids)).hexdigest() for ids in listed],
            "decoded_sha256": [hashlib.sha256(replay.decode(ids)).hexdigest() for ids in listed],
        }

    return map_texts(docs, key, text, work, "n_tokens long, ids_sha256 string, decoded_sha256 string")
