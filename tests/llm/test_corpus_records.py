"""Exact dedup, source divergence and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tether.llm import divergence, exact_dedup, merkle
from .conftest import WORDS, rows_of

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, recipe int, n int, best int, g string, at string, rank int, digest int, part int, value int, term int, uses int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def clashing(spark, rows):
    """``rows``: (doc_id, text, lang, source, n_chars), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x", 1, 1, 1, "x", "x", 1, 1, 1, 1, 1, 1) for r in rows], CLASHING)


@pytest.fixture(scope="module")
def odd_rows(odd_texts):
    rows = [(i, t, ["en", "de", None, "", "é"][i % 5], ["a", "b", None][i % 3], None if i % 4 == 0 else i) for i, t in enumerate(odd_texts)]
    return rows + [(0, None, "en", "a", 1), (0, None, "en", "a", 1), (None, "a null id", None, None, 3), (None, "A NULL id", None, None, 3), (700, "É e", "zz", "b", 3), (701, "é E", "zz", "b", 3)]


# Exact dedup ---------------------------------------------------------------------------------------------------------------------


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lowered(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for i in ids:
            first = i == keep and not stays
            stays |= first
            out[(i, keep, len(ids), first, sha)] += 1
    return out


def test_exact_duplicates_of_odd_texts(spark, odd_rows, documents):
    got = exact_dedup.exact_duplicates(clashing(spark, odd_rows))
    assert Counter(map(tuple, got.collect())) == brute_exact(odd_rows)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, exact_dedup.exact_duplicates(documents).collect())) == brute_exact(rows)
    assert exact_dedup.exact_duplicates(documents.limit(0)).collect() == []


def test_every_letter_is_lowered_as_stated(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and c]
    texts = ["x" + "".join(map(chr, points[i : i + 500])) + "X" for i in range(0, len(points), 500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_dedup.normalised(F.col("t")).alias("n")).collect()
    assert all(r.n == lowered(r.t) for r in got) and len(got) == len(texts)


def test_chunks_make_up_the_text_and_follow_its_content(spark, odd_texts):
    draw = random.Random(4)
    texts = [t for t in odd_texts if t] + ["\x01\x03 a\x01", " ".join(draw.choices(WORDS, k=3000))]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_dedup.chunks(F.col("t")).alias("c"))
    for r in frame.collect():
        assert "".join(r.c) == r.t.replace("\x01", "\x01\x02") and all(0 < len(c) <= exact_dedup.LONGEST for c in r.c)
    # A word put in front changes the first chunks only.
    moved = spark.createDataFrame([(texts[-1],), ("another " + texts[-1],)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert len(set(moved[0].c) & set(moved[1].c)) > len(moved[0].c) / 2 > 5


def test_identifiers_that_clash_are_given_anew(spark, monkeypatch, documents):
    real, seeds = exact_dedup.chunk_id, []

    def weak(chunk, seed):
        seeds.append(seed)
        return F.struct(F.length(chunk).cast("long").alias("a"), F.lit(0).cast("long").alias("b")) if seed < 2 else real(chunk, seed)

    monkeypatch.setattr(exact_dedup, "chunk_id", weak)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, exact_dedup.exact_duplicates(documents).collect())) == brute_exact(rows)
    assert set(seeds) == {0, 1, 2}


def test_identifiers_beyond_the_broadcast_bound(spark, monkeypatch, documents):
    monkeypatch.setattr(exact_dedup, "BROADCAST_IDS", 0)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, exact_dedup.exact_duplicates(documents).collect())) == brute_exact(rows)


# Source divergence ---------------------------------------------------------------------------------------------------------------


def brute_divergence(rows, min_docs=3, top=200):
    docs = [(lowered(t), lang or "", source or "") for _, t, lang, source, *_ in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        here = [i for i, d in enumerate(docs) if d[1] == lang]
        found, total = Counter(), Counter()
        for i in here:
            found.update(set(words[i]))
        kept = {t for t, n in found.items() if n >= min_docs}
        uses = defaultdict(Counter)
        for i in here:
            uses[docs[i][2]].update(t for t in words[i] if t in kept)
            total.update(t for t in words[i] if t in kept)
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in uses.items()}
        q = {t: 1 + 10**9 * (total[t] + 1) // (sum(total.values()) + len(kept)) for t in kept}
        for s in uses:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in uses if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if uses[s][t] > 0 and p[s][t] > q[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(listed, 1)]
    return sorted(out, key=repr)


def test_divergence_of_odd_texts(spark, odd_rows, documents):
    assert rows_of(divergence.divergence_audit(clashing(spark, odd_rows), min_docs=1), "*") == brute_divergence(odd_rows, 1)
    assert rows_of(divergence.divergence_audit(clashing(spark, odd_rows)), "*") == brute_divergence(odd_rows)
    assert divergence.divergence_audit(documents.limit(0)).collect() == []


@pytest.mark.parametrize("top", [3, 200])
def test_divergence_with_many_ties(spark, monkeypatch, top):
    # Windows of few bytes and hand-overs after few terms change nothing.
    monkeypatch.setattr(divergence, "WINDOW", 16)
    monkeypatch.setattr(divergence, "HELD", 5)
    draw = random.Random(8)
    many = [f"{a}{b}" for a in WORDS for b in WORDS]
    rows = [(i, " ".join(draw.choices(many, k=80) + draw.choices(WORDS, k=30)), draw.choice(["en", "de"]), draw.choice("abcc") if i % 9 else None, 1) for i in range(90)]
    rows += [(1000, "", "en", "empty", 1), (1001, None, "none", "x", 1), (1002, "one", "none", "y", 1)]
    assert rows_of(divergence.divergence_audit(clashing(spark, rows), top=top), "*") == brute_divergence(rows, top=top)


# Merkle manifest -----------------------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def brute_tree(nodes, fanout):
    """The node that is left, and for each of ``nodes`` the others on its path with its place among them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for path, i in zip(paths, at):
            run, place = runs[i // fanout], i % fanout
            path.append((place, run[:place] + run[place + 1 :]))
        at = [i // fanout for i in at]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def brute_manifest(rows, fanout=2):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = brute_leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        tampered = brute_leaf(doc_id, source, lang, n_chars + 1, text) if hit else leaf
        groups[lang].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, tampered))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[g])], fanout) for g in names]
    root, above = brute_tree([t[0] for t in trees], fanout)
    out = []
    for name, (subroot, paths), rest in zip(names, trees, above):
        for (_, doc_id, leaf, tampered), path in zip(sorted(groups[name]), paths):
            node = tampered
            for place, others in path + rest:
                node = sha("".join(others[:place] + [node] + others[place:]))
            proof = sha("".join(d for _, others in path + rest for d in others))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def test_manifest_of_odd_rows(spark, odd_rows, documents):
    assert rows_of(merkle.manifest(clashing(spark, odd_rows)), "*") == brute_manifest(odd_rows)
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = brute_manifest(rows)
    assert rows_of(merkle.manifest(documents), "*") == want and {r[-1] for r in want} == {True, False}
    assert merkle.manifest(documents.limit(0)).collect() == []


@pytest.mark.parametrize(("n", "fanout", "height"), [(1, 2, 6), (2, 2, 1), (9, 2, 2), (64, 2, 3), (65, 2, 6), (130, 2, 2), (30, 3, 2), (17, 5, 1)])
def test_trees_of_any_shape(spark, n, fanout, height):
    rows = [(i, f"text {i}", "en" if i < n else f"l{i}", "s", 3) for i in range(n + 3)]
    got = merkle.proofs(merkle.leaves_of(clashing(spark, rows)), fanout, height)
    assert rows_of(got, "*") == brute_manifest(rows, fanout)


def test_some_requests_descend_alone(spark):
    nodes = [sha(str(i)) for i in range(150)]
    leaves = spark.createDataFrame([("", i, d) for i, d in enumerate(nodes)], "g string, rank long, digest string")
    tree = merkle.build(leaves, 2, 3)
    root, paths = brute_tree(nodes, 2)
    heads = tree.tops.select("g", "digest", F.array().cast(merkle.PATH).alias("path"))
    wanted = [0, 77, 149]
    met = merkle.descend(tree, heads, leaves.where(F.col("rank").isin(wanted)).select("g", "rank"), 3).collect()
    found = {}
    for row in met:
        for ask in row.asked:
            node, path = merkle.descended(row.levels, ask["rank"] % 8, 2)
            found[ask["rank"]] = (node, [(s["place"], s["others"]) for s in path] + [(s.place, s.others) for s in row.path])
    assert found == {i: (nodes[i], paths[i]) for i in wanted} and tree.tops.first().digest == root


def test_equal_content_is_stored_once(spark):
    # Two groups with the same leaves share their records, and each still has proofs of its own.
    leaves = spark.createDataFrame([(g, i, sha(str(i))) for g in "ab" for i in range(20)], "g string, rank long, digest string")
    tree = merkle.build(leaves, 2, 2)
    assert tree.records[0].count() == 5 and {r.g for r in tree.tops.collect()} == {"a", "b"} and len({r.digest for r in tree.tops.collect()}) == 1
