"""SimHash near-duplicates: fingerprints of word shingles, linked at a small number of differing bits by bit-sliced comparison.

Fingerprints that differ in ``radius`` bits or fewer agree wholly in all but ``radius`` of some blocks of bits; each choice of blocks is a
key, so every link is found. Fingerprints that share a key are compared with bit planes: plane i holds bit i of all of them, differing
bits are added to all distances at once by carry-save counters, and a slab of 64 lanes is given up for a query once all its distances exceed
the radius. Planes in which the fingerprints differ most are read first, as those that share a key agree in most of their bits. A group of
one slab is read to the end, since each of its lanes is a query at distance 0 from itself.

Equal fingerprints are compared once. Null and empty texts have fingerprint zero, linked as any other; texts of any length are hashed
shingle by shingle. Repeated rows and repeated ids keep a row each; a null id never names a component unless all ids of the component are
null. Other columns are left out, or kept as they are whatever their names (``drop_near_duplicates``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.llm.groups import components, dealt_in_blocks, map_groups
from tether.llm.texts import free_name, map_texts
from tether.session import stored

SEED = 42
SHINGLE, RADIUS = 3, 2
BITS = 64
# Fingerprints of one key compared in one task: two blocks at most.
BLOCK = 2048
SHINGLES_AT_ONCE = 1 << 15
# Planes read between two looks at which slabs go on.
CHECKED = 4
CLASSES = (2, 4, 8, 16, 32, 64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, unsigned: each is set if it is set in over half of the hashes of all word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashed = [xxhash.xxh64_digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_digest
        hashed = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashed), SHINGLES_AT_ONCE):
        part = np.frombuffer(b"".join(hashed[i : i + SHINGLES_AT_ONCE]), dtype=np.uint8)
        counts += np.unpackbits(part).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashed)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)``; ``fp`` is the fingerprint as a signed 64-bit number."""

    def work(texts: list[bytes]) -> dict:
        return {"fp": pa.array(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))}

    return map_texts(docs, key, text, work, "fp long", binary=True)


def block_masks(radius: int) -> list[int]:
    """Bits of each key: all choices of 3 out of ``radius + 3`` blocks, as signed numbers."""
    bounds = [BITS * i // (radius + 3) for i in range(radius + 4)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in map(sum, combinations(blocks, 3))]


def planes_of(prints: np.ndarray) -> np.ndarray:
    """``(groups, lanes)`` fingerprints, lanes a multiple of 64, to ``(bit, groups, lanes / 64)`` planes; lane i is bit i % 64 of its word."""
    groups, lanes = prints.shape
    out = np.empty((BITS, groups, lanes // 64), dtype=np.uint64)
    for bit in range(BITS):
        set_ = ((prints >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out[bit] = np.packbits(set_, axis=1, bitorder="little").view("<u8")
    return out


def telling_bits(planes: np.ndarray) -> list[int]:
    """Bits in which most lanes differ from their group first, bits that are the same throughout last."""
    lanes = planes.shape[2] * 64
    ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64)
    return np.argsort(-np.minimum(ones, lanes - ones).sum(axis=1), kind="stable").tolist()


def within(planes: np.ndarray, queries: np.ndarray, radius: int, left: list[int] | None = None) -> np.ndarray:
    """``(groups, queries, words)``: lanes at ``radius`` bits or fewer from each query of their group.

    Counters are kept bit-sliced, just wide enough for ``radius + 1``, and stay above the radius once they have passed it. Every few planes
    the (query, slab) entries whose lanes have all passed it are taken out; ``left`` gets the number of those that go on.
    """
    near = np.zeros((*queries.shape, planes.shape[2]), dtype=np.uint64)
    group, query, slab = (x.ravel() for x in np.indices(near.shape))
    width, full = (radius + 1).bit_length(), ~np.uint64(0)
    counters = [np.zeros(near.size, dtype=np.uint64) for _ in range(width)]
    over = np.zeros(near.size, dtype=np.uint64)
    for read, bit in enumerate(telling_bits(planes), 1):
        wanted = np.where(queries >> np.uint64(bit) & np.uint64(1), full, np.uint64(0))
        carry = planes[bit][group, slab] ^ wanted[group, query]
        for counter in counters:
            counter ^= carry
            carry &= ~counter
        over |= carry
        if read % CHECKED == 0 and planes.shape[2] > 1:
            over |= _exceeds(counters, radius)
            stays = over != full
            if left is not None:
                left.append(int(stays.sum()))
            if not stays.all():
                group, query, slab, over = group[stays], query[stays], slab[stays], over[stays]
                counters = [counter[stays] for counter in counters]
            if not len(over):
                break
    near[group, query, slab] = ~(over | _exceeds(counters, radius))
    return near


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above ``radius``, compared bit by bit from the top."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            above |= equal & counters[i]
            equal &= ~counters[i]
    return above


def roots_of_small(prints: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    """``(groups, lanes)`` fingerprints of groups of at most 64 to the first lane each lane is linked with."""
    groups, lanes = prints.shape
    padded = np.zeros((groups, 64), dtype=np.uint64)
    padded[:, :lanes] = prints
    used = (np.uint64(1) << (sizes.astype(np.uint64) - np.uint64(1))) | ((np.uint64(1) << (sizes.astype(np.uint64) - np.uint64(1))) - np.uint64(1))
    reach = within(planes_of(padded), prints, radius)[:, :, 0] & used[:, None]
    for lane in range(lanes):
        through = np.where(reach >> np.uint64(lane) & np.uint64(1), reach[:, lane : lane + 1], np.uint64(0))
        reach |= through
    lowest = reach & (~reach + np.uint64(1))
    return np.where(reach == 0, 0, np.frexp(lowest.astype(np.float64))[1] - 1)


def roots_of_large(prints: np.ndarray, radius: int, at_once: int = 128) -> np.ndarray:
    """Fingerprints of one group to the first of them each is linked with."""
    n = len(prints)
    padded = np.zeros(-(-n // 64) * 64, dtype=np.uint64)
    padded[:n] = prints
    planes = planes_of(padded[None])
    near = np.concatenate([within(planes, prints[None, i : i + at_once], radius)[0] for i in range(0, n, at_once)])
    roots = np.full(n, -1)
    for first in range(n):
        if roots[first] < 0:
            frontier = np.array([first])
            while len(frontier):
                roots[frontier] = first
                met = np.bitwise_or.reduce(near[frontier], axis=0)
                lanes = np.flatnonzero(np.unpackbits(met.view(np.uint8), bitorder="little")[:n])
                frontier = lanes[roots[lanes] < 0]
    return roots


def links_in_groups(prints: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``(a, b)`` places that connect what is linked inside each group; fewer than there are places."""
    sizes = np.diff(np.append(starts, len(prints)))
    root = np.arange(len(prints))
    smaller = 1
    for size in CLASSES:
        these = np.flatnonzero((sizes > smaller) & (sizes <= size))
        smaller = size
        for i in range(0, len(these), 4096):
            part = these[i : i + 4096]
            at = np.minimum(starts[part][:, None] + np.arange(size), (starts + sizes)[part][:, None] - 1)
            roots = roots_of_small(prints[at], sizes[part], radius)
            inside = np.arange(size) < sizes[part][:, None]
            root[at[inside]] = (starts[part][:, None] + roots)[inside]
    for g in np.flatnonzero(sizes > CLASSES[-1]):
        span = slice(starts[g], starts[g] + sizes[g])
        root[span] = starts[g] + roots_of_large(prints[span], radius)
    linked = np.flatnonzero(root != np.arange(len(prints)))
    return linked, root[linked]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints ``fp`` that connect all that are within ``radius`` bits, over any number of links."""
    masks = F.array(*[F.lit(m).cast("long") for m in block_masks(radius)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("slot", "mask")).select(F.col("slot").cast("long").alias("slot"), (F.col("fp").bitwiseAND(F.col("mask"))).alias("part"), "fp")
    dealt = dealt_in_blocks(keyed, ["slot", "part"], "fp", BLOCK)

    def work(table: pa.Table, starts: np.ndarray) -> dict:
        signed = table.column("fp").to_numpy()
        a, b = links_in_groups(signed.view(np.uint64), starts, radius)
        return {"a": signed[a], "b": signed[b]}

    return map_groups(dealt, ["slot", "part", "p", "q"], work, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)``: 16 hex digits, and the smallest key reachable by links. Runs jobs and stores tables."""
    found = stored(fingerprints(docs, shingle, key, text).withColumnRenamed(key, "key"), "fingerprints")
    distinct = stored(found.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    roots = components(links(distinct, radius))
    member = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(named, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.join(named, "fp").select(F.col("key").alias(key), digits, "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key; all columns as they were.

    Keys need not tell rows apart: rows are numbered in a stored table first. Of rows that repeat the smallest key one stays, and a null
    key comes after all others. Runs jobs and stores tables.
    """
    row, order = free_name(docs, "row"), free_name(docs, "order")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    place = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col(row).alias("row"))
    found = simhash_components(numbered.withColumn(order, place).select(order, text), shingle, radius, order, text)
    gone = free_name(docs, "gone")
    others = found.where(F.col(order) != F.col("component_id")).select(F.col(f"{order}.row").alias(gone))
    return numbered.join(others, F.col(row) == F.col(gone), "left_anti").drop(row)
