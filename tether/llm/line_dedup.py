"""Line dedup: repeated lines and lines within a few edits of an earlier one, by a segment-partition edit join.

If two lines differ by at most ``edits`` edits, one of ``edits + 1`` segments of the shorter one stands unchanged in the other, near the same
place. So each line is indexed under its segments and probes, for every length it may be linked with, the substrings that such a segment
could be; lines that meet under a segment are verified with a banded bit-parallel edit distance.

A line is a stretch between line feeds, and lines are ordered by document key and place. A line goes if it equals an earlier one, or is
linked to an earlier one, whether that one stays or not. Lines under ``min_chars`` characters always stay: they say too little to be a copy.
Lines under ``edit_chars`` are only compared for equality. With ``share``, the edits grow with the line: one for each ``share`` characters of
the shorter of the two, ``edits`` at least and ``most`` at most. Null and empty texts have no such line; a null key comes
before all others. Rows that repeat both key and text are not told apart: their lines go or stay together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.llm.groups import dealt_in_blocks, map_groups
from tether.llm.texts import free_name, slices
from tether.session import stored

EDITS, MIN_CHARS, EDIT_CHARS = 2, 20, 40
# Characters for each edit where edits grow with the line, and the edits that no line goes beyond: it has 140 characters then. What a line
# probes grows with the square of its edits. The edit distance allows for up to 31.
SHARE, MOST_EDITS = 20, 7
# As the queries use it: edits that grow, from the shortest lines on that are compared at all.
GROWING = {"edit_chars": MIN_CHARS, "share": SHARE}
# Lines of one length class are cut alike; a class ends where the edits grow, or at so many times its first length.
CLASS_GROWTH = 1.25
# Lines under one segment compared in one task: two blocks at most.
BLOCK = 512
PAIRS_AT_ONCE = 1 << 16
# Lines verified in one call, in bytes: many pairs side by side cost little more than few.
LINES_AT_ONCE = 4 << 20
SLICE_BYTES = 1 << 20
# Text whose parts go to one bucket; the number of buckets follows from all of it. Bounds on its bits.
BUCKET_TEXT, BUCKET_BITS = 16 << 20, (8, 24)
# Parts of one bucket held before those that can only be shared are let go.
HELD_PARTS = 1 << 22
# Pairs verified side by side, and code points they may be padded to together.
PAIRS_TOGETHER, CHARS_TOGETHER = 2048, 1 << 21
TOP = np.uint64(1 << 63)
ONE = np.uint64(1)
BASE = 0x2545F4914F6CDD1D
# Keys up to this number are sent to every task, eight bytes each; beyond it both sides are shuffled.
BROADCAST_KEYS = 1_000_000


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, pos, line)`` of all lines of all texts."""
    return docs.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def _digest(line: Column | str) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def segment_keys(lines: list[str], edits: int, edit_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(part, line, index)``: hashes of each line's own segments (``index``) and of the other substrings it probes.

    ``line`` is the place in ``lines``. Sums of weighted code points from a line's start give the hash of any substring in one step.
    """
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    starts = np.cumsum(sizes) - sizes
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    longest = int(sizes.max(initial=0)) + 1
    places = np.arange(len(points)) - np.repeat(starts, sizes)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(points + np.uint64(1)) * _powers(BASE, longest)[places])))
    back = _powers(pow(BASE, -1, 1 << 64), longest)
    parts, found, own = edits + 1, [], []
    for shorter in range(edits + 1):
        length = sizes - shorter
        short, n_short = length // parts, parts - length % parts  # the first segments are the shorter ones
        usable = np.flatnonzero(length >= edit_chars)
        for i in range(parts):
            start = short * i + np.maximum(0, i - n_short)
            width = short + (i >= n_short)
            # At most i edits lie before the segment and at most ``edits - i`` after it.
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                at = start[usable] + shift
                begin = starts[usable] + at
                hashed = (sums[begin + width[usable]] - sums[begin]) * back[at]
                found.append(_mixed(_mixed(hashed) + (length[usable] * 64 + i).astype(np.uint64)).view(np.int64))
                own.append((usable, np.full(len(usable), shorter == shift == 0)))
    return np.concatenate(found), np.concatenate([u for u, _ in own]), np.concatenate([x for _, x in own])


def allowed(sizes: np.ndarray, edits: int, share: int | None, most: int) -> np.ndarray:
    """Edits at which a line may be linked with one that is not shorter."""
    return np.full(len(sizes), edits) if share is None else np.clip(sizes // share, edits, max(edits, most))


def class_bounds(longest: int, edits: int, edit_chars: int, share: int, most: int) -> list[int]:
    """First lengths of the classes up to ``longest``, and the one after them; a class has one number of edits."""
    bounds = [edit_chars]
    while bounds[-1] <= longest:
        here = bounds[-1]
        later = np.arange(here + 1, max(here + 2, int(here * CLASS_GROWTH) + 1))
        grown = later[allowed(later, edits, share, most) > allowed(np.array([here]), edits, share, most)]
        bounds.append(int(grown[0] if len(grown) else later[-1]))
    return bounds


def class_keys(lines: list[str], edits: int, edit_chars: int, share: int, limit: int = MOST_EDITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``segment_keys``, with edits that grow: ``(part, line, index)``.

    As many characters of a class's lines as its shortest line has are cut into one segment more than it has edits: the first half of the
    segments from the line's beginning on, the others up to its end. For some i, segment i is whole, i edits lie before it and at most the
    rest of the edits after it. So in the other line it stands at most i places from its own, counted from the beginning, and at most the
    rest, counted from the end.
    """
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    starts = np.cumsum(sizes) - sizes
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    longest = int(sizes.max(initial=0)) + 1
    places = np.arange(len(points)) - np.repeat(starts, sizes)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(points + np.uint64(1)) * _powers(BASE, longest)[places])))
    back = _powers(pow(BASE, -1, 1 << 64), longest)
    found, line, own = [], [], []
    bounds = class_bounds(longest, edits, edit_chars, share, limit)
    for low, high in zip(bounds, bounds[1:]):
        most = int(allowed(np.array([low]), edits, share, limit)[0])
        usable = np.flatnonzero((sizes >= low) & (sizes < high + most))
        if not len(usable):
            continue
        cuts = low * np.arange(most + 2) // (most + 1)
        segment, shift = np.array([(i, d) for i in range(most + 1) for d in range(-min(i, most - i), min(i, most - i) + 1)]).T
        width = np.diff(cuts)[segment]
        at = cuts[segment] + shift + np.where(2 * segment > most, sizes[usable][:, None] - low, 0)
        which, probe = np.nonzero((at >= 0) & (at + width <= sizes[usable][:, None]))
        at = at[which, probe]
        begin = starts[usable][which] + at
        hashed = (sums[begin + width[probe]] - sums[begin]) * back[at]
        found.append(_mixed(_mixed(hashed) + (low * 64 + segment[probe]).astype(np.uint64)).view(np.int64))
        line.append(usable[which])
        own.append((shift[probe] == 0) & (sizes[usable][which] < high))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return np.concatenate(found), np.concatenate(line), np.concatenate(own)


def edit_distances(first: np.ndarray, first_sizes: np.ndarray, second: np.ndarray, second_sizes: np.ndarray, most: int) -> np.ndarray:
    """Edit distance of each pair of rows of code points, ``most + 1`` where it is more than ``most``.

    One 64-bit word a pair holds the vertical differences of one column inside the band of ``most`` places around the diagonal; the top
    bit is the band's lowest row, and places outside a row hold -1, which no letter equals. Up to the last ``most`` columns the band slides down, then its lowest row is walked to the corner. Pairs
    that can no longer come back under ``most`` are left out on the way. Needs ``most < 32``, and first sizes of at least ``most``.
    """
    n = len(first)
    result = np.full(n, most + 1, dtype=np.int64)
    active = np.flatnonzero(np.abs(first_sizes - second_sizes) <= most)
    up = np.full(len(active), ~np.uint64(0) << np.uint64(63 - most), dtype=np.uint64)
    down = np.zeros(len(active), dtype=np.uint64)
    score = np.full(len(active), most, dtype=np.int64)
    band = 2 * most + 1
    padded = np.full((n, first.shape[1] + 3 * most + 1), -1, dtype=np.int32)
    padded[:, most : most + first.shape[1]] = first
    column = 0
    while len(active):
        letter = second[active, column] if column < second.shape[1] else None
        running = column < second_sizes[active]
        if not running.all():
            ended = ~running
            result[active[ended]] = np.minimum(score[ended], most + 1)
            active, up, down, score = active[running], up[running], down[running], score[running]
            if not len(active):
                break
            letter = letter[running]
        bits = np.packbits(padded[active, column : column + band] == letter[:, None], axis=1, bitorder="little")
        word = np.zeros((len(active), 8), dtype=np.uint8)
        word[:, : bits.shape[1]] = bits
        equal = word.view("<u8")[:, 0] << np.uint64(63 - 2 * most)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right_up = down | ~(diagonal | up)
        right_down = diagonal & up
        turn = first_sizes[active] - most
        sliding = column < turn
        mark = TOP >> np.maximum(column - turn + 1, 0).astype(np.uint64)
        walked = ((right_up & mark) != 0).astype(np.int64) - ((right_down & mark) != 0)
        score += np.where(sliding, (diagonal & TOP) == 0, walked)
        shifted = diagonal >> ONE
        up = right_down | ~(shifted | right_up)
        down = shifted & right_up
        column += 1
        if column % 8 == 0:
            hopeful = score <= 2 * most + np.maximum(second_sizes[active] - first_sizes[active], 0)
            if not hopeful.all():
                active, up, down, score = active[hopeful], up[hopeful], down[hopeful], score[hopeful]
    return result


def _code_points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in lines], dtype=np.int64)
    rows = np.full((len(lines), int(sizes.max(initial=1))), -1, dtype=np.int32)
    for row, line in zip(rows, lines):
        row[: len(line)] = np.frombuffer(line.encode("utf-32-le"), dtype=np.int32)
    return rows, sizes


def _without_ends(first: np.ndarray, m: np.ndarray, second: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs without their common beginnings, which no edit distance depends on; ``most`` characters stay of either line."""
    width = min(first.shape[1], second.shape[1])
    differs = first[:, :width] != second[:, :width]
    same = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    skip = np.maximum(np.minimum(same, np.minimum(m, n) - most), 0)

    def rest(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = sizes - skip
        at = skip[:, None] + np.arange(max(1, int(left.max(initial=1))))
        return np.where(at < sizes[:, None], np.take_along_axis(rows, np.minimum(at, rows.shape[1] - 1), axis=1), -1), left

    return *rest(first, m), *rest(second, n)


def _near(first: np.ndarray, m: np.ndarray, second: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are within ``most`` edits; common beginnings, then common ends are left out before they are compared."""
    first, m, second, n = _without_ends(first, m, second, n, most)
    turned = []
    for rows, sizes in ((first, m), (second, n)):
        at = sizes[:, None] - 1 - np.arange(rows.shape[1])
        turned += [np.where(at >= 0, np.take_along_axis(rows, np.maximum(at, 0), axis=1), -1), sizes]
    return edit_distances(*_without_ends(*turned, most), most) <= most


def letter_bins(lines: list[str]) -> np.ndarray:
    """``(lines, 32)``: how many code points of each line fall into each bin."""
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    places = np.repeat(np.arange(len(lines)) * 32, sizes) + (points & 31)
    return np.bincount(places, minlength=32 * len(lines)).reshape(-1, 32).astype(np.int32)


def links_in_groups(table: pa.Table, starts: np.ndarray, edits: int, share: int | None = None, most_edits: int = MOST_EDITS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of linked lines: ``(later, earlier)`` with the earliest such line for each later one and group."""
    ids, index, own, p, q = (table.column(c).to_numpy(zero_copy_only=False) for c in ("id", "index", "own", "p", "q"))
    lines = table.column("line").to_pylist()
    line_sizes = np.array([len(line) for line in lines], dtype=np.int64)
    bins = letter_bins(lines)
    rank = np.asarray(table.column("rank").to_numpy())
    left, right = [], []
    later: list[np.ndarray] = []
    earlier: list[np.ndarray] = []

    def verify() -> None:
        a, b = np.concatenate(left), np.concatenate(right)
        left.clear(), right.clear()
        shorter, longer = np.minimum(line_sizes[a], line_sizes[b]), np.maximum(line_sizes[a], line_sizes[b])
        limit = allowed(shorter, edits, share, most_edits)
        if share is not None:
            # Two lines that share several of their many segments are compared once.
            _, once = np.unique(np.stack((np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]))), axis=1, return_index=True)
            once = once[(longer - shorter)[once] <= limit[once]]
            a, b, longer, limit = a[once], b[once], longer[once], limit[once]
        # Each edit changes one letter of a bin on either side at most, so lines whose letters differ in more are not near. Most lines that
        # meet under a short segment go here.
        apart = bins[a] - bins[b]
        alike = np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1)) <= limit
        a, b, longer, limit = a[alike], b[alike], longer[alike], limit[alike]
        # Pairs of like length together, so that short lines are not padded to long ones.
        order = np.lexsort((longer, limit))
        i = 0
        while i < len(order):
            # Rows are padded to the longest of them, so long lines are taken few at a time.
            some = order[i : i + PAIRS_TOGETHER]
            fit = (np.cumsum(longer[some] > 0) * longer[some] <= CHARS_TOGETHER) & (limit[some] == limit[some[0]])
            some = some[: max(1, int(np.argmin(np.append(fit, False))))]
            i += len(some)
            x, y = a[some], b[some]
            seen, places = np.unique(np.concatenate((x, y)), return_inverse=True)
            rows, sizes = _code_points([lines[j] for j in seen])
            u, v = places[: len(x)], places[len(x) :]
            pairs, most = (rows[u], sizes[u], rows[v], sizes[v]), int(limit[some[0]])
            near = edit_distances(*pairs, most) <= most if share is None else _near(*pairs, most)
            x, y = x[near], y[near]
            swap = rank[x] < rank[y]
            later.append(np.where(swap, y, x))
            earlier.append(np.where(swap, x, y))

    waiting = 0
    for a, b in zip(starts, np.append(starts[1:], len(ids))):
        indexed = np.arange(a, b)[index[a:b]]
        for i in indexed:
            others = np.arange(a, b)
            ok = (ids[a:b] != ids[i]) & ((own[a:b] != own[i]) | (p[i] == q[i]))
            # Two indexed lines meet once.
            ok &= ~index[a:b] | (others > i)
            others = others[ok]
            if len(others):
                left.append(np.full(len(others), i))
                right.append(others)
                waiting += len(others)
                if waiting >= PAIRS_AT_ONCE:
                    verify()
                    waiting = 0
    if waiting:
        verify()
    if not later:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    x, y = np.concatenate(later), np.concatenate(earlier)
    order = np.lexsort((rank[y], ids[x]))
    x, y = x[order], y[order]
    first = np.concatenate(([True], ids[x][1:] != ids[x][:-1])) if len(x) else np.zeros(0, dtype=bool)
    return x[first], y[first]


def in_buckets(part: np.ndarray, own: np.ndarray, ids: np.ndarray, bits: int) -> pa.RecordBatch:
    """``(bucket, parts, ids)``: all parts that begin with the same ``bits`` bits, and their lines' ids, as one row of packed numbers.

    A part's lowest bit makes room for ``own``.
    """
    keys = (part.view(np.uint64) & ~ONE) | own.astype(np.uint64)
    bucket = (keys >> np.uint64(64 - bits)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    offsets = pa.py_buffer((np.append(first, len(bucket)) * 8).astype(np.int32))
    packed = [pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(column[order])]) for column in (keys, ids)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), *packed], names=["bucket", "parts", "ids"])


def parts_of(docs: DataFrame, edits: int, edit_chars: int, text: str, bits: int, share: int | None = None, most: int = MOST_EDITS) -> DataFrame:
    """Parts of the lines of all texts, see ``segment_keys``, ``class_keys`` and ``in_buckets``; a line's id is the first half of its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for a, b in slices(pc.binary_length(column).to_pylist(), SLICE_BYTES):
                lines = list({line for whole in column.slice(a, b - a).to_pylist() for line in whole.split("\n") if len(line) >= edit_chars})
                if lines:
                    part, line, own = segment_keys(lines, edits, edit_chars) if share is None else class_keys(lines, edits, edit_chars, share, most)
                    ids = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in lines], dtype=np.uint64).view(np.int64)
                    if len(part):
                        yield in_buckets(part, own, ids[line], bits)

    return docs.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "bucket int, parts binary, ids binary")


def settled(keys: np.ndarray, ids: np.ndarray, last: bool) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows ``(part, id, index)`` of the parts that two lines have, one of them as its own, and what to hold on to of ``keys`` and ``ids``.

    Before the ``last`` call an owner may still come, so parts of two lines without one are given as well, and of each part the rows with its
    smallest and largest id and its last owner are held, so that lines which come later are known to share it.
    """
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    part = keys >> ONE
    same = part[1:] == part[:-1]
    # Most parts stand once.
    twice = np.append(False, same) | np.append(same, False)
    alone = ~twice
    some, those = keys[twice], ids[twice]
    order = np.lexsort((some & ONE, those, some >> ONE))
    some, those = some[order], those[order]
    part = some >> ONE
    # A line that has a part as its own and as a probe, or stands in several slices, counts once, as its owner.
    ends = np.append((part[1:] != part[:-1]) | (those[1:] != those[:-1]), True) if len(part) else np.zeros(0, dtype=bool)
    some, those, part = some[ends], those[ends], part[ends]
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(begins, len(part)))
    owned = np.where(some & ONE, np.arange(len(part)), -1)
    owner = np.maximum.reduceat(owned, begins) if len(part) else owned
    out = np.repeat((sizes > 1) & ((owner >= 0) | (not last)), sizes)
    rows = {"part": (some[out] & ~ONE).view(np.int64), "id": those[out], "index": (some[out] & ONE).astype(bool)}
    if last:
        return rows, keys[:0], ids[:0]
    kept = np.unique(np.concatenate((begins, begins + sizes - 1, owner[owner >= 0])))
    return rows, np.concatenate((keys[alone], some[kept])), np.concatenate((ids[alone], those[kept]))


def shared_parts(parts: DataFrame, most_held: int = HELD_PARTS) -> DataFrame:
    """``(part, id, index)`` of the parts under which lines meet; a row may come again.

    Of a bucket with more than ``most_held`` parts, those that several lines have are let go of before its end, so what a task holds grows
    with the different parts of a bucket, not with the lines under one of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, keys, ids, held, limit = None, [], [], 0, most_held

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal keys, ids, held, limit
            if keys:
                rows, *rest = settled(np.concatenate(keys), np.concatenate(ids), last)
                keys, ids = [rest[0]], [rest[1]]
                held = len(rest[0])
                limit = max(most_held, 2 * held)
                if len(rows["part"]):
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rows.items()})

        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            changes = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            for a, b in zip(np.append(0, changes), np.append(changes, len(bucket))):
                if a == b:
                    continue
                if bucket[a] != here:
                    yield from settle(True)
                    here, keys, ids, held, limit = bucket[a], [], [], 0, most_held
                for column, into, kind in (("parts", keys, np.uint64), ("ids", ids, np.int64)):
                    into.append(np.frombuffer(b"".join(batch.column(column).slice(a, b - a).to_pylist()), dtype=kind))
                held += len(keys[-1])
                if held > limit:
                    yield from settle(False)
        yield from settle(True)

    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "part long, id long, index boolean")


def bucket_bits(docs: DataFrame, text: str) -> int:
    """Bits of a bucket's number for all of ``docs``."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return int(np.clip(int(size // BUCKET_TEXT).bit_length(), *BUCKET_BITS))


def sent_if_few(keys: DataFrame) -> DataFrame:
    """``keys``, a stored table, marked for sending to every task if it is small enough."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def near_lines(docs: DataFrame, edits: int, edit_chars: int, key: str, text: str, share: int | None = None, most: int = MOST_EDITS) -> DataFrame:
    """``(h1, h2, first, near)``: lines linked with an earlier one, where they and the earliest such line first stand."""
    # Parts move in buckets of packed numbers, and only those under which lines meet become rows.
    parts = shared_parts(parts_of(docs, edits, edit_chars, text, bucket_bits(docs, text), share, most))
    meeting = stored(parts.groupBy("part", "id").agg(F.max("index").alias("index")), "meeting-lines")
    wanted = stored(meeting.select("id").distinct(), "wanted-lines")
    lines = lines_of(docs, key, text).where(F.length("line") >= edit_chars).select("key", "pos", "line", *_digest(F.col("line")))
    lines = lines.join(sent_if_few(wanted), F.col("h1") == F.col("id"))
    lines = stored(lines.groupBy("id", "h2").agg(F.min(F.struct("key", "pos", "line")).alias("first")), "lines")
    lines = lines.select("id", "h2", "first.line", F.struct("first.key", "first.pos").alias("first"))
    met = dealt_in_blocks(meeting, ["part"], "id", BLOCK, also=F.max("index")).join(lines.drop("h2"), "id")
    key_type = lines.schema["first"].dataType["key"].dataType.simpleString()

    def work(table: pa.Table, starts: np.ndarray) -> dict:
        firsts = table.column("first").combine_chunks()
        keys, places = firsts.field("key"), firsts.field("pos")
        # Earlier lines have smaller ranks.
        order = pc.sort_indices(pa.table({"k": keys, "p": places}), sort_keys=[("k", "ascending"), ("p", "ascending")], null_placement="at_start")
        rank = np.empty(len(table), dtype=np.int64)
        rank[order.to_numpy()] = np.arange(len(table))
        later, earlier = links_in_groups(table.append_column("rank", pa.array(rank)), starts, edits, share, most)
        return {
            "id": table.column("id").to_numpy()[later],
            "near_key": keys.take(pa.array(earlier)),
            "near_pos": places.take(pa.array(earlier)),
        }

    links = map_groups(met, ["part", "p", "q"], work, f"id long, near_key {key_type}, near_pos int", LINES_AT_ONCE)
    near = links.groupBy("id").agg(F.min(F.struct(F.col("near_key").alias("key"), F.col("near_pos").alias("pos"))).alias("near"))
    return lines.join(near, "id").select(F.col("id").alias("h1"), "h2", "first", "near")


def repeated_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, edit_chars: int = EDIT_CHARS, key: str = "doc_id", text: str = "text", share: int | None = None, most: int = MOST_EDITS
) -> DataFrame:
    """``(key, pos, reason, first_key, first_pos)`` of each line that goes; ``reason`` is ``exact`` or ``near``. Runs jobs and stores tables.

    ``first_key`` and ``first_pos`` name the earliest line that it equals or is linked with.
    """
    here = F.struct("key", "pos")
    places = lines_of(docs, key, text).where(F.length("line") >= min_chars).select("key", "pos", *_digest(F.col("line")))
    equal = places.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    near = near_lines(docs, edits, edit_chars, key, text, share, most).withColumnRenamed("first", "near_first")
    both = equal.join(near, ["h1", "h2"], "full_outer").withColumn("first", F.coalesce("first", "near_first"))
    earliest = F.when(F.col("near").isNull() | (F.col("first") < F.col("near")), F.col("first")).otherwise(F.col("near"))
    wanted = stored(both.select("h1", "h2", "first", earliest.alias("earliest")), "repeated")
    gone = places.join(wanted, ["h1", "h2"]).where(here > F.col("earliest"))
    return gone.select(
        F.col("key").alias(key),
        "pos",
        F.when(here == F.col("first"), "near").otherwise("exact").alias("reason"),
        F.col("earliest.key").alias("first_key"),
        F.col("earliest.pos").alias("first_pos"),
    )


def line_counts(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_lines, n_exact, n_near)``, one row per input row: all lines, and those that go for either reason."""
    sizes = docs.select(F.col(key).alias("key"), F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).alias("n_lines"))
    sizes = sizes.withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("long"))
    counts = gone.groupBy(F.col(key).alias("gone_key")).agg(F.count_if(F.col("reason") == "exact").alias("n_exact"), F.count_if(F.col("reason") == "near").alias("n_near"))
    joined = sizes.join(counts, F.col("key").eqNullSafe(F.col("gone_key")), "left")
    return joined.select(F.col("key").alias(key), "n_lines", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_exact", "n_near")])


def drop_lines(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines of ``gone``; a document that loses lines and keeps no word goes. Other columns, of any name, stay as they were."""
    mine, theirs, where, rest = (free_name(docs, c) for c in ("own_key", "gone_key", "gone_places", "rest"))
    places = gone.groupBy(F.col(key).alias(theirs)).agg(F.collect_set("pos").alias(where))
    joined = docs.withColumn(mine, F.col(key)).join(places, F.col(mine).eqNullSafe(F.col(theirs)), "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(where))
    shortened = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    whole = F.col(where).isNull()
    left = joined.withColumn(rest, F.when(whole, F.col(text)).otherwise(shortened)).where(whole | F.col(rest).rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*[F.col(rest).alias(c) if c == text else F.col(c) for c in docs.columns])
