import hashlib
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tether.llm import byte_bpe, packing, token_counts, vocabularies

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = vocabularies.load_ranks(MULTI)
LIBRARY = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS.ids, special_tokens={})
TOKENIZER = Tokenizer.from_file(JSON)
REPLAY = byte_bpe.MergeReplay(RANKS)
COUNTS = token_counts.PrefixCounts(vocabularies.load_json(JSON))
ENCODER = packing.Encoder(JSON)
SOME_TEXT = st.text(alphabet=st.sampled_from(" \n\t'abehinorstERS013.,!é中 😀"), max_size=60)


def by_tokenizers(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def test_pattern_is_the_public_one():
    assert vocabularies.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.lists(SOME_TEXT, max_size=4))
def test_replay_equals_library(texts):
    assert [array("I", ids).tolist() for ids in REPLAY.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(SOME_TEXT)
def test_counts_and_ids_equal_library(text):
    ids = by_tokenizers(text)
    assert COUNTS.measure(text, 5)[0] == len(ids) and array("I", ENCODER.encode(text)).tolist() == ids


@settings(max_examples=100, deadline=None)
@given(SOME_TEXT, st.integers(0, 12))
def test_every_prefix(text, budget):
    counts = COUNTS.at_prefixes(text)
    ends = [k for k in range(1, len(text) + 1) if not text[k - 1].isspace()]
    want = {k: len(by_tokenizers(text[:k])) for k in ends}
    assert {k: counts[len(text[:k].encode()) - 1] for k in ends} == want
    whole = len(by_tokenizers(text)) <= budget
    fit = len(text) if whole else max([k for k in ends if want[k] <= budget], default=0)
    assert COUNTS.measure(text, budget)[1] == len(text[:fit].encode())


def test_a_full_store_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    small = byte_bpe.MergeReplay(RANKS)
    texts = ["the rain in spain", "stays mainly in the plain", "the plain rain"] * 5
    for _ in range(5):
        assert [array("I", x).tolist() for x in small.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_a_merge_of_lower_rank_that_comes_up_late():
    # "ab" + "c" makes a token older than "ab": the piece is settled on its own.
    names = {bytes((b,)): b for b in range(256)} | {b"abc": 256, b"bc": 300, b"ab": 257, b"bcd": 258}
    own = byte_bpe.MergeReplay(vocabularies.Vocabulary(names, {}, {}))
    pieces = [b"abc", b"ababcd", b"abcabcabc", b"xabcd", b"aaaa"]
    assert [array("I", x).tolist() for x in own.replay(pieces)] == [own.one(p) for p in pieces]


def test_round_trip_of_tables(documents, odd):
    for docs in (documents, odd):
        got = byte_bpe.round_trip(docs, MULTI)
        want = Counter()
        for row in docs.collect():
            text = row.text or ""
            ids = LIBRARY.encode_ordinary(text)
            want[row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert Counter(map(tuple, got.collect())) == want
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_encode_gives_ids(odd):
    assert sum(len(r.ids) for r in byte_bpe.encode(odd, MULTI).collect()) == 4 * sum(len(LIBRARY.encode_ordinary(r.text or "")) for r in odd.collect())


def test_token_counts_of_tables(documents, odd):
    for docs in (documents, odd):
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, JSON).collect())
        want = Counter()
        for row in docs.collect():
            n = len(by_tokenizers(row.text or ""))
            want[row.doc_id, len((row.text or "").encode()), n, n > 512] += 1
        assert got == want


def test_pieces(documents, odd):
    for docs in (documents, odd):
        found = defaultdict(list)
        for r in packing.pieces(docs, JSON, size=700).collect():
            found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        want = defaultdict(list)
        for row in docs.collect():
            ids = [*by_tokenizers(row.text or ""), 0]
            first = len(ids) % 700 or 700
            bounds = [0, *range(first, len(ids) + 1, 700)]
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                want[row.doc_id].append((i, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())))
        assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def checked(rows, limits):
    """Sequences of ``(sequence_id, offset, length)`` rows: gapless and within every capacity."""
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(parts) <= limits.documents and sum(n * n for _, n in parts) <= limits.cost
    return len(held)


@pytest.mark.parametrize("shares", [1_000_000, 7])
def test_packing_of_tables(documents, monkeypatch, shares):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", shares)
    rows = packing.pack(documents, JSON).collect()
    n = checked([(r.sequence_id, r.offset, r.length) for r in rows], packing.Capacities())
    assert n <= -(-sum(r.length for r in rows) // 2048) + 2
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_packing_of_odd_and_empty_tables(odd):
    rows = packing.pack(odd, JSON, keep_ids=True).collect()
    checked([(r.sequence_id, r.offset, r.length) for r in rows], packing.Capacities())
    assert sum(r.start == 0 for r in rows) == odd.count() and all(len(r.ids) == r.length for r in rows)
    assert packing.pack(odd.limit(0), JSON).collect() == []


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12),
    st.sampled_from(["residual", "dot"]),
    st.sampled_from([(64, 64, 4096), (64, 3, 4096), (64, 64, 4096 // 2 + 2048), (100, 5, 4500)]),
)
def test_plan_keeps_every_capacity(counts, rule, most):
    limits = packing.Capacities(*most, rule=rule)
    made = packing.plan(counts, limits)
    rows, covered = [], Counter()
    order = list(zip(*map(list, (made.length, made.first, made.each, made.sequence, made.offset))))
    for (length, first, each, sequence, offset), following in zip(order, [*order[1:], None]):
        last = following[1] if following and following[0] == length else counts[length]
        for j in range(last - first):
            rows.append((sequence + j // each, offset + j % each * length, length))
        covered[length] += last - first
    assert covered == Counter(counts) and checked(rows, limits) == made.n_sequences


def test_a_piece_that_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({10: 1}, packing.Capacities(100, 10, 99))
