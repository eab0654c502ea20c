import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tether.llm import embedding_dedup, groups, line_dedup, simhash
from .conftest import WORDS, components_of, rows_of


def brute_fingerprint(text, shingle=3):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def brute_components(rows, radius=2):
    """``rows``: (id, text); ids may repeat or be null."""
    prints = [brute_fingerprint(t or "") for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= radius]
    roots = components_of(len(rows), links)
    named = {}
    for (key, _), root in zip(rows, roots):
        if key is not None:
            named[root] = min(key, named.get(root, key))
    return Counter((key, f"{p:016x}", named.get(root)) for (key, _), p, root in zip(rows, prints, roots))


def near_copies(seed=3):
    draw = random.Random(seed)
    rows = []
    for family in range(12):
        words = draw.choices(WORDS, k=200)
        for copy in range(draw.choice([1, 2, 5, 40])):
            mine = list(words)
            for _ in range(copy % 3):
                mine[draw.randrange(len(mine))] = draw.choice(WORDS)
            rows.append((len(rows), " ".join(mine)))
    return rows


@pytest.mark.parametrize("block", [2048, 8])
def test_simhash_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = near_copies()
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_components(rows)
    assert Counter(map(tuple, got.collect())) == want and len({c for _, _, c in want}) < len(rows)


def test_simhash_of_odd_texts(odd, documents):
    for docs in (odd, documents):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert Counter(map(tuple, simhash.simhash_components(docs).collect())) == brute_components(rows)
    assert simhash.simhash_components(odd.limit(0)).collect() == []


def test_drop_near_duplicates_keeps_one(odd, spark):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, fp string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == sorted({(c,) for _, _, c in brute_components(rows)}, key=repr)
    # One row of each component stays, whatever keys repeat or are null.
    some = [(r.doc_id, r.text) for r in odd.collect()]
    prints = [brute_fingerprint(t or "") for _, t in some]
    roots = components_of(len(some), [(i, j) for i in range(len(some)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    want = Counter(min((k is None, k or 0) for (k, _), x in zip(some, roots) if x == root) for root in set(roots))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in simhash.drop_near_duplicates(odd).collect()) == want
    assert simhash.drop_near_duplicates(odd.limit(0)).collect() == []


CLASHING = "doc_id long, text string, gone_key string, gone_places int, rest int, row int, ORDER int, gone int, key string, own_key int, found int, fp string, component_id int"


def test_columns_of_any_name_stay(spark):
    line = "a line that is long enough to be compared with others"
    rows = [(1, f"{line}\nfirst"), (1, f"{line}\nfirst"), (2, f"{line}\nsecond text"), (None, f"{line}\nthird"), (None, "alone here"), (None, "alone here")]
    docs = spark.createDataFrame([(*r, "k", 1, 2, i, 3, 4, "x", 5, 6, "y", 7) for i, r in enumerate(rows)], CLASHING)
    gone = line_dedup.repeated_lines(docs)
    kept = line_dedup.drop_lines(docs, gone)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text", "row") == sorted([(1, "first", 0), (1, "first", 1), (2, "second text", 2), (None, rows[3][1], 3), (None, "alone here", 4), (None, "alone here", 5)], key=repr)
    single = simhash.drop_near_duplicates(docs)
    assert single.columns == docs.columns
    assert rows_of(single, "doc_id", "text") == sorted(set(rows), key=repr)


def test_far_slabs_are_left_early():
    draw = np.random.default_rng(5)
    prints = draw.integers(0, 2**63, 2048).astype(np.uint64)
    left = []
    near = simhash.within(simhash.planes_of(prints[None]), prints[None, :64], 2, left)
    entries = 64 * 32
    # After a third of the planes hardly any slab but the query's own goes on.
    assert left[0] <= entries and left[5] < 0.1 * entries and left[-1] == 64
    lanes = np.unpackbits(near.view(np.uint8), axis=2, bitorder="little")[0]
    want = np.bitwise_count(prints[:64, None] ^ prints[None]) <= 2
    assert (lanes == want).all()


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_slices(radius):
    draw = np.random.default_rng(radius)
    prints, starts = [], []
    for size in [1, 2, 3, 1, 5, 17, 40, 64, 65, 130, 2]:
        starts.append(len(prints))
        bases = draw.integers(0, 2**63, 3)
        for _ in range(size):
            x = int(bases[draw.integers(3)])
            for _ in range(draw.integers(0, 4)):
                x ^= 1 << int(draw.integers(64))
            prints.append(x)
    a, b = simhash.links_in_groups(np.array(prints, dtype=np.uint64), np.array(starts), radius)
    root = list(range(len(prints)))
    for x, y in zip(a, b):
        root[x] = y
    spans = list(zip(starts, [*starts[1:], len(prints)]))
    links = [(i, j) for s, e in spans for i in range(s, e) for j in range(s, i) if bin(prints[i] ^ prints[j]).count("1") <= radius]
    assert root == components_of(len(prints), links)


def test_keys_find_all_links_within_the_radius():
    draw = random.Random(1)
    masks = simhash.block_masks(2)
    for _ in range(2000):
        x = draw.getrandbits(64)
        y = x ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        assert any((x & m) == (y & m) for m in masks)


def test_components_of_chains_and_hubs(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(0, i) for i in range(1, 300)] + [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(250)]
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    place = {n: i for i, n in enumerate(nodes)}
    want = components_of(len(nodes), [(place[a], place[b]) for a, b in edges if a != b])
    got = {r.node: r.root for r in groups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: nodes[w] for n, w in zip(nodes, want)}
    assert groups.components(spark.createDataFrame([], "a long, b long")).collect() == []


# Embeddings ----------------------------------------------------------------------------------------------------------------------


def brute_vectors(rows, threshold=0.98):
    sound = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None for (_, v, _), ok in zip(rows, sound)]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links.append((i, j))
    n = Counter(x for link in links for x in link)
    roots = components_of(len(rows), links)
    smallest = {}
    for (key, _, _), root in zip(rows, roots):
        smallest[root] = min(key, smallest.get(root, key))
    return Counter((key, n[i], smallest[root], key == smallest[root]) for i, ((key, _, _), root) in enumerate(zip(rows, roots)))


def vectors(seed=2):
    draw = np.random.default_rng(seed)
    rows = []
    for family in range(25):
        base = draw.normal(size=32)
        for _ in range(int(draw.choice([1, 2, 3, 20]))):
            rows.append((len(rows), (base + draw.normal(size=32) * draw.choice([0, 0.05, 0.12])).astype(np.float32).tolist(), int(family % 4)))
    rows += [(len(rows) + i, v, lab) for i, (v, lab) in enumerate([
        (None, 1), ([], 1), ([0.0] * 32, 1), ([float("nan")] * 32, 1), ([float("inf")] + [1.0] * 31, 1), ([None] + [1.0] * 31, 1), (rows[0][1], None),
        ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([-0.0, 1.0], 1), ([0.0, 1.0], 1), ([1e30, 1e30], 1), ([1e-30, 1e-30], 1),
    ])]
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, class int")
    want = brute_vectors(rows)
    assert Counter(map(tuple, embedding_dedup.embedding_links(df).collect())) == want
    assert sum(n for _, n, _, _ in want) > 500


def test_embeddings_of_empty_table(spark):
    assert embedding_dedup.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_recall_at_the_threshold():
    draw = np.random.default_rng(9)
    a = draw.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = draw.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + (1 - 0.98**2) ** 0.5 * side
    met = (embedding_dedup.buckets(a) == embedding_dedup.buckets(b)).any(axis=1)
    assert met.mean() > 0.99
    assert (embedding_dedup.buckets(a) == embedding_dedup.buckets(np.roll(b, 1, axis=0))).mean() < 1e-3


# Lines ---------------------------------------------------------------------------------------------------------------------------


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def edited(draw, line, n):
    chars = list(line)
    for _ in range(n):
        at, kind = draw.randrange(len(chars) + 1), draw.random()
        if not chars:
            kind = 0.5
        if kind < 0.4:
            chars[at % len(chars)] = draw.choice("abcdé ")
        elif kind < 0.7:
            chars.insert(at, draw.choice("abcdé "))
        else:
            chars.pop(at % len(chars))
    return "".join(chars)


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4])
def test_banded_distance(most):
    draw = random.Random(most)
    first = ["".join(draw.choices("abcé", k=draw.randint(max(1, most), 40))) for _ in range(1500)]
    second = [edited(draw, a, draw.randint(0, 6)) for a in first]
    (a, m), (b, n) = line_dedup._code_points(first), line_dedup._code_points(second)
    assert line_dedup.edit_distances(a, m, b, n, most).tolist() == [min(distance(x, y), most + 1) for x, y in zip(first, second)]


def brute_lines(rows, edits=2, min_chars=20, edit_chars=40):
    places = [(key, pos, line) for key, text in rows if text is not None for pos, line in enumerate(text.split("\n")) if len(line) >= min_chars]
    first = {}
    for key, pos, line in places:
        first[line] = min(first.get(line, (key, pos)), (key, pos))
    near = {}
    for a in first:
        for b in first:
            if first[b] < first[a] and min(len(a), len(b)) >= edit_chars and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                near[a] = min(near.get(a, first[b]), first[b])
    out = Counter()
    for key, pos, line in places:
        earliest = min(first[line], near.get(line, first[line]))
        if (key, pos) > earliest:
            out[key, pos, "near" if (key, pos) == first[line] else "exact", *earliest] += 1
    return out


@pytest.mark.parametrize("held", [1, 40, 1 << 22])
def test_shared_parts(spark, held):
    """Parts of two lines with an owner, whether a bucket is settled once or many times on the way."""
    draw = np.random.default_rng(6)
    rows, tables = [], []
    for _ in range(30):
        part, own, ids = draw.integers(-40, 40, 25) << 57, draw.random(25) < 0.15, draw.integers(-9, 9, 25)
        # One part that very many lines have.
        part[:8], ids[:8] = 5 << 57, draw.integers(-1000, 1000, 8)
        rows += zip(part.tolist(), ids.tolist(), own.tolist())
        tables.append(line_dedup.in_buckets(part, own, ids, 8).to_pandas())
    parts = spark.createDataFrame(pd.concat(tables), "bucket int, parts binary, ids binary").repartition(3)
    found = line_dedup.shared_parts(parts, held).groupBy("part", "id").agg(F.max("index").alias("own")).collect()
    got = {}
    for r in found:
        got.setdefault(r.part, {})[r.id] = r.own
    want = {}
    for part, line, own in rows:
        want.setdefault(part, {})[line] = want.get(part, {}).get(line, False) or own
    # Groups without an owner are left out by the join that follows.
    got = {part: lines for part, lines in got.items() if any(lines.values())}
    assert got == {part: lines for part, lines in want.items() if len(lines) > 1 and any(lines.values())}


def line_documents(seed=4):
    draw = random.Random(seed)
    lines = [" ".join(draw.choices(WORDS, k=draw.randint(1, 14))) for _ in range(30)]
    lines += ["same start of many long lines, then " + edited(draw, "an ending that changes a little", draw.randint(0, 4)) for _ in range(12)]
    rows = []
    for key in range(60):
        some = [draw.choice(lines) if draw.random() < 0.5 else edited(draw, draw.choice(lines), draw.randint(0, 3)) for _ in range(draw.randint(0, 5))]
        rows.append((key, "\n".join(some)))
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_repeated_lines(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 50)
    rows = line_documents()
    got = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_lines(rows)
    assert Counter(map(tuple, got.collect())) == want and {"near", "exact"} <= {k[2] for k in want}


def test_drop_lines(spark):
    long = "a line that is long enough to be compared with others"
    rows = [(1, f"{long}\nEs.\n", "k"), (2, f"Es.\n{long}\nrest of the second text", "k"), (3, long + "!", "k"), (4, "", "k"), (5, None, "k"), (6, f"x\n\n{long}", "k"), (None, "null id", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos string")
    gone = line_dedup.repeated_lines(docs)
    kept = line_dedup.drop_lines(docs, gone)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted([(1, f"{long}\nEs.\n"), (2, "Es.\nrest of the second text"), (4, ""), (5, None), (6, "x\n"), (None, "null id")], key=repr)
    counts = {r.doc_id: (r.n_lines, r.n_exact, r.n_near) for r in line_dedup.line_counts(docs, gone).collect()}
    assert counts == {1: (3, 0, 0), 2: (3, 1, 0), 3: (1, 0, 1), 4: (1, 0, 0), 5: (0, 0, 0), 6: (3, 1, 0), None: (1, 0, 0)}


def test_lines_of_odd_and_empty_tables(odd):
    gone = line_dedup.repeated_lines(odd)
    assert line_dedup.drop_lines(odd, gone).columns == odd.columns
    assert gone.where(F.col("doc_id").isNull()).count() == 0
    assert line_dedup.repeated_lines(odd.limit(0)).collect() == []


def with_words_changed(draw, line, n):
    words = line.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(WORDS)
    return " ".join(words)


def brute_growing(rows, limit):
    first = {}
    for key, text in rows:
        for pos, line in enumerate(text.split("\n")):
            first[line] = min(first.get(line, (key, pos)), (key, pos))
    near = {}
    for a in first:
        for b in first:
            short = min(len(a), len(b))
            most = min(limit, max(2, short // 20))
            if first[b] < first[a] and short >= 20 and abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                near[a] = min(near.get(a, first[b]), first[b])
    return {(*first[a], *earliest) for a, earliest in near.items()}


@pytest.mark.parametrize(("block", "most"), [(512, 15), (3, 15), (512, 7)])
def test_edits_grow_with_the_line(spark, monkeypatch, block, most):
    """Long lines with changed words and lines of 20 to 39 characters, against brute force."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    draw = random.Random(8)
    lines = [" ".join(draw.choices(WORDS, k=n)) for n in (3, 4, 5, 6, 9, 12, 20, 30, 50, 70)]
    lines += [with_words_changed(draw, draw.choice(lines), draw.randint(1, 3)) for _ in range(45)]
    lines += [edited(draw, draw.choice(lines), draw.randint(1, 17)) for _ in range(25)]
    lines += ["copyright the authors 2019", "copyright the authors 2020"]
    draw.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 3 : i * 3 + 3])) for i in range(-(-len(lines) // 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.repeated_lines(docs, edit_chars=20, share=line_dedup.SHARE, most=most).where("reason = 'near'").collect()
    want = brute_growing(rows, most)
    size = {(key, pos): len(line) for key, text in rows for pos, line in enumerate(text.split("\n"))}
    assert {(r.doc_id, r.pos, r.first_key, r.first_pos) for r in found} == want
    assert any(size[w[:2]] >= (300 if most == 15 else 100) for w in want) and any(size[w[:2]] < 40 for w in want)
    assert len(line_dedup.repeated_lines(docs).where("reason = 'near'").collect()) < len(want)
