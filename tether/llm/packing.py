"""Best-fit packing of token sequences under several capacities.

Only lengths decide where a piece fits, so the plan is made for classes of equal length: a few thousand classes with counts, whatever
the size of the corpus. Classes are placed from long to short; among the kinds of open sequences with room for a piece in every
capacity, those are filled first that the piece leaves with the smallest weighted residual (or, as an option, those whose residual has
the largest weighted dot product with the piece). Spark counts the classes, numbers the pieces inside each class and looks up each
number's place in the plan.

Null and empty texts are documents of the end token alone. Ties between pieces go by id, piece and checksum. Repeated rows are packed each
on their own. Other columns of the input are left out.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tether.llm import vocabularies
from tether.llm.pieces import Stretches, Uncut, cut, splitter
from tether.llm.texts import map_texts
from tether.session import stored

# Pieces of one class numbered by one task.
NUMBERED_TOGETHER = 1_000_000


class Encoder:
    """Ids of the tokenizers library for a byte-level BPE file; stretches of text between spaces are encoded once."""

    def __init__(self, path: str):
        vocabulary = vocabularies.load_json(path)
        self.specials = vocabulary.specials
        self.bpe = tiktoken.Encoding("file", pat_str=vocabularies.PATTERN, mergeable_ranks=_by_rank(vocabulary), special_tokens={})
        self.renamed = _renamed(vocabulary)
        self.split = splitter(list(self.specials))
        self.stretches = Stretches(self.plain)

    def plain(self, text: str) -> bytes:
        ids = self.bpe.encode_ordinary(text)
        return array("I", ids if self.renamed is None else [self.renamed[i] for i in ids]).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        out = []
        for place, run in enumerate(self.split(text)):
            if place % 2:
                out.append(array("I", [self.specials[run]]).tobytes())
                continue
            first, rest = cut(run)
            try:
                ids = b"".join(map(self.stretches.__getitem__, rest))
                out += [self.plain(first), ids]
            except Uncut:
                out.append(self.plain(run))
        return b"".join(out)


def _by_rank(vocabulary: vocabularies.Vocabulary) -> dict[bytes, int]:
    """Tokens by the order in which they are formed: single bytes, then the results of the merges."""
    made = {i: place for place, i in reversed(vocabulary.merges.values())}
    ordered = sorted(vocabulary.ids.items(), key=lambda item: made.get(item[1], item[1] - len(vocabulary.ids)))
    return {name: rank for rank, (name, _) in enumerate(ordered)}


def _renamed(vocabulary: vocabularies.Vocabulary) -> list[int] | None:
    """Id of each rank, or None if they are the same."""
    ids = [vocabulary.ids[name] for name in _by_rank(vocabulary)]
    return None if ids == list(range(len(ids))) else ids


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, keep_ids: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32[, ids])``: each document's ids and the end id, cut if there are more than ``size``.

    All pieces but the first of a cut document have ``size`` ids.
    """
    end = array("I", [end_id]).tobytes()

    def work(texts: list[str]) -> dict:
        encoder = _encoder(path)
        out = []
        for whole in texts:
            ids = encoder.encode(whole) + end
            n = len(ids) // 4
            first = n % size or size
            bounds = [0, *range(first, n + 1, size)]
            row = []
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                part = ids[4 * a : 4 * b]
                row.append({"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(part)})
                if keep_ids:
                    row[-1]["ids"] = np.frombuffer(part, dtype="<u4").astype(np.int64).tolist()
            out.append(row)
        return {"pieces": pa.array(out, type=kind)}

    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kind = pa.list_(pa.struct(fields + ([("ids", pa.list_(pa.int64()))] if keep_ids else [])))
    inner = "piece: int, start: bigint, length: bigint, ids_crc32: bigint" + (", ids: array<bigint>" if keep_ids else "")
    return map_texts(docs, key, text, work, f"pieces array<struct<{inner}>>").select(key, F.inline("pieces"))


@dataclass(frozen=True)
class Capacities:
    """What a sequence may hold: tokens, documents, and attention cost, which is the sum of squared piece lengths.

    ``weights`` say how much each residual counts when a sequence is chosen, ``rule`` how: ``residual`` or ``dot``. The default
    limits on documents and cost are the largest that ``tokens`` alone allow, so they never cost a sequence.
    """

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "residual"


@dataclass
class Plan:
    """Places of the pieces of each class by their number in it, ordered by length and first number.

    Piece ``from + j`` of a class goes to sequence ``sequence + j // each`` at ``offset + (j % each) * length``.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int


def plan(counts: dict[int, int], limits: Capacities) -> Plan:
    """Best fit, longest pieces first, over classes ``length -> count``."""
    most = np.array([limits.tokens, limits.documents, limits.cost], dtype=np.float64)
    weights = np.array(limits.weights)
    # Kinds of open sequences: residual capacities, how many there are, and what each of them holds as (length, pieces).
    room, number, held = np.empty((0, 3)), np.empty(0, dtype=np.int64), []
    for length in sorted(counts, reverse=True):
        need, left = np.array([length, 1, length * length], dtype=np.float64), counts[length]
        if (need > most).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        fits = np.flatnonzero((room >= need).all(axis=1) & (number > 0))
        if limits.rule == "dot":
            order = fits[np.argsort(-((room[fits] / most) * (need / most) * weights).sum(axis=1), kind="stable")]
        else:
            order = fits[np.argsort(((((room[fits] - need) / most) ** 2) * weights).sum(axis=1), kind="stable")]
        added_room, added_number, added_held = [], [], []
        for i in [*order.tolist(), -1]:
            if not left:
                break
            before = room[i] if i >= 0 else most
            # As many as fit go into the same sequence: after the first piece it is the fullest that still has room.
            each = int((before // need).min())
            open_ = int(number[i]) if i >= 0 else left // each
            content = held[i] if i >= 0 else ()
            full = min(open_, left // each)
            rest = left - full * each if full < open_ or i < 0 else 0
            for sequences, n in ((full, each), (1 if rest else 0, rest)):
                if sequences:
                    added_room.append(before - n * need)
                    added_number.append(sequences)
                    added_held.append((*content, (length, n)))
                    left -= sequences * n
                    if i >= 0:
                        number[i] -= sequences
        if added_room:
            room, number = np.vstack((room, added_room)), np.append(number, np.array(added_number, dtype=np.int64))
            held += added_held
            used = number > 0
            room, number, held = room[used], number[used], [h for h, u in zip(held, used) if u]
    rows, next_number, sequence = [], dict.fromkeys(counts, 0), 0
    for content, sequences in zip(held, number.tolist()):
        offset = 0
        for length, n in content:
            rows.append((length, next_number[length], n, sequence, offset))
            next_number[length] += n * sequences
            offset += n * length
        sequence += sequences
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, n_sequences=sequence)


def numbered(rows: DataFrame, counts: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``number`` (from 0) inside their ``length``, dealt to tasks by shares of bounded size."""
    shares = counts.select("length", F.ceil(F.col("n") / NUMBERED_TOGETHER).alias("shares"))
    dealt = rows.join(F.broadcast(shares), "length").withColumn("share", F.pmod(F.xxhash64(*order), "shares"))
    share_sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    bases = share_sizes.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "share").orderBy(*order)
    return (
        dealt.withColumn("place", F.row_number().over(inside))
        .join(bases, ["length", "share"])
        .withColumn("number", F.col("base") + F.col("place") - 1)
        .drop("shares", "share", "base", "place")
    )


def place(found: DataFrame, limits: Capacities | None = None, key: str = "doc_id") -> DataFrame:
    """``found`` (from ``pieces``) with ``sequence_id`` and ``offset``. Runs a job for the counts of lengths.

    ``found`` is read several times and should be stored. At most ``limits.tokens`` rows of counts reach the driver.
    """
    limits = limits or Capacities()
    counts = found.groupBy("length").agg(F.count("*").alias("n"))
    made = plan({r.length: r.n for r in counts.collect()}, limits)
    ordered = numbered(found, counts, [key, "piece", "start", "ids_crc32"])
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}

    def run(batches):
        for batch in batches:
            length, number = (np.asarray(batch.column(c)) for c in ("length", "number"))
            at = _last_at_most(made, length, number)
            j = number - made.first[at]
            sequence = made.sequence[at] + j // made.each[at]
            offset = made.offset[at] + j % made.each[at] * length
            columns = [batch.column(c) for c in kinds]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*kinds, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", sequence_id bigint, offset bigint"
    return ordered.mapInArrow(run, schema)


def _last_at_most(made: Plan, length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Row of the plan each ``(length, number)`` falls under."""
    width = int(max(made.first.max(initial=0), number.max(initial=0))) + 1
    return np.searchsorted(made.length * width + made.first, length * width + number, side="right") - 1


def pack(docs: DataFrame, path: str, limits: Capacities | None = None, keep_ids: bool = False, key: str = "doc_id", text: str = "text"):
    """Documents to placed pieces; stores the pieces in the shared folder, as counting and placing both read them."""
    limits = limits or Capacities()
    found = stored(pieces(docs, path, limits.tokens, keep_ids=keep_ids, key=key, text=text), "pieces")
    return place(found, limits, key)
