import brute
import pytest
from test_search import corpus
from test_similarity import words

from pyspark.sql import functions as F

from tether.operators import joins, search, similarity
from tether.operators.similarity import similar_words
from tether.session import stored


@pytest.fixture
def eager_splits(monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 20)
    monkeypatch.setattr(joins, "LIGHT_ROWS", 1)


def rows(n, hot):
    return [("hot" if i % 3 == 0 else f"k{i % hot}", i) for i in range(n)]


@pytest.mark.parametrize("broadcast_keys", [0, 1000])
def test_split_join_equals_plain_join(table, eager_splits, monkeypatch, broadcast_keys):
    monkeypatch.setattr(joins, "BROADCAST_KEYS", broadcast_keys)
    left, right = table(rows(300, 20), "k string, a int"), table(rows(90, 40), "k string, b int")
    split = {r.k: (r.rows, r.columns) for r in joins.split_keys(left, joins.heavy_keys(right, "k"), "k").collect()}
    # 100 left-hand and 30 right-hand rows make tiles of 20 pairs at most, copied along the shorter side.
    assert split["hot"] == (23, 7) and all(r * c > 1 for r, c in split.values())
    got = joins.balanced_join(left, right, "k")
    assert sorted(map(tuple, got.select("k", "a", "b").collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_search_with_split_words(table, eager_splits):
    labels, mentions = corpus(11)
    hits = search.search_hits(table([(x,) for x in mentions], "mention string"), table(labels, "kb_id string, label string"), 10)
    want = brute.search(mentions, labels, 10)
    got = {(r.mention, r["rank"]): (r.kb_id, r.label) for r in hits.collect()}
    assert got == {(m, i + 1): x[:2] for m, found in want.items() for i, x in enumerate(found)}


def test_similar_words_with_split_keys(table, eager_splits):
    a, b = words(12, 200, "ab", 9), words(13, 200, "ab", 9)
    got = similar_words(table([(w,) for w in a], "w string"), table([(w,) for w in b], "w string"))
    assert {tuple(r) for r in got.collect()} == {(x, y) for x in a for y in b if brute.similarity(x, y) > 0.8}


def test_one_long_side_is_cut_alone(table, eager_splits):
    left, right = table(rows(300, 20), "k string, a int"), table([("hot", 1), ("hot", 2)], "k string, b int")
    split = joins.split_keys(left, joins.heavy_keys(right, "k"), "k").first()
    assert (split.rows, split.columns) == (10, 1)
    assert joins.balanced_join(left, right, "k").count() == 200


def test_each_side_is_computed_once(spark, table, monkeypatch):
    """Words come from stored tables after they have been read once."""
    read = []

    def counted(df, name):
        read.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    for module in (similarity, joins):
        monkeypatch.setattr(module, "stored", counted)
    left = spark.range(300).select(F.concat(F.lit("word"), "id").alias("w"))
    right = spark.range(1000, 1200).select(F.concat(F.lit("word"), "id").alias("w"))
    plan = similar_words(left, right)._jdf.queryExecution().executedPlan().toString()
    assert sum(p.count("Range (") for p in [*read, plan]) == 2
