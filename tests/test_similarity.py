import random

import pytest
from brute import similarity
from pyspark.sql import functions as F

from tether.functions.hamming import allowed_differences, hamming_similarity
from tether.operators.similarity import similar_words


def words(seed, n, alphabet="aab", longest=28):
    r = random.Random(seed)
    return sorted({"".join(r.choice(alphabet) for _ in range(r.randint(1, longest))) for _ in range(n)})


def test_boundary_words(table):
    rows = [("abcde", "abcdx"), ("abcdef", "abcdex"), ("abcdefghij", "abcdefghxx"), ("abc", "abcdefgh"), ("", ""), ("", "a"), ("a", "A")]
    got = table(rows, "a string, b string").select(hamming_similarity(F.col("a"), F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [similarity(a, b) for a, b in rows]
    assert [r.x > 0.8 for r in got] == [False, True, False, False, True, False, False]


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.5, 2 / 3, 0.7, 0.8, 0.9, 0.95])
def test_allowed_differences(spark, threshold):
    got = spark.range(1, 200).select(allowed_differences(F.col("id"), threshold).alias("k")).collect()
    assert [r.k for r in got] == [max(d for d in range(n) if 1 - d / n > threshold) for n in range(1, 200)]


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.5, 2 / 3, 0.8, 0.95])
def test_join_equals_all_pairs(table, threshold):
    a, b = [*words(1, 150), "", "\xe9" * 7 + "x"], [*words(2, 100), "", "\xe9" * 7 + "y"]
    got = similar_words(table([(w,) for w in a], "w string"), table([(w,) for w in b], "w string"), threshold)
    assert {tuple(r) for r in got.collect()} == {(x, y) for x in a for y in b if x and y and similarity(x, y) > threshold}


def test_long_words(table):
    base = "".join(random.Random(4).choice("abcdefgh") for _ in range(120))
    r = random.Random(6)

    def changed(k, cut):
        text = list(base[: len(base) - cut])
        for i in r.sample(range(len(text)), k):
            text[i] = "#"
        return "".join(text)

    others = [changed(k, cut) for k in range(0, 30, 3) for cut in (0, 2, 10, 23, 24, 30)]
    got = similar_words(table([(base,)], "w string"), table([(w,) for w in others], "w string"))
    assert {x.word_b for x in got.collect()} == {w for w in others if similarity(base, w) > 0.8}


def test_shared_start_in_a_third_of_words(table):
    many = [f"http{i:05d}" for i in range(1500)] + words(9, 3000, "abcdefghij", 12)
    some = [f"http{i:05d}" for i in range(0, 1500, 50)] + ["abcdefghij"]
    got = similar_words(table([(w,) for w in many], "w string"), table([(w,) for w in some], "w string"))
    assert {tuple(x) for x in got.collect()} == {(x, y) for x in set(many) for y in some if similarity(x, y) > 0.8}


def test_plan_has_no_all_pairs_join(table):
    df = similar_words(table([("a",)], "w string"), table([("b",)], "w string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_threshold_range(table):
    with pytest.raises(ValueError):
        similar_words(table([("a",)], "w string"), table([("b",)], "w string"), 1.0)
