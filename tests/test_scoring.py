import random
from collections import Counter

import brute
import pytest

from tether.operators import scoring
from tether.operators.evaluation import link_eval
from tether.operators.similarity import similar_words
from tether.session import stored


def bag_rows(bags):
    return [(key, w, n, len(bag)) for key, bag in bags.items() for w, n in Counter(bag).items()]


@pytest.fixture(scope="module")
def bags():
    r = random.Random(2)
    words = ["".join(r.choice("abc") for _ in range(r.randint(2, 9))) for _ in range(40)] + ["The"]

    def bag(n):
        return ["The", "The", *[r.choice(words) for _ in range(n)]]

    return {str(i): bag(r.randint(0, 20)) for i in range(12)}, {f"/m/{i}": bag(r.randint(0, 8)) for i in range(9)}


def make(table, bags):
    docs, nouns = bags
    pairs = [(d, k, len(docs[d])) for i, d in enumerate(docs) for j, k in enumerate([*nouns, "/m/none"]) if (i + j) % 2]
    return (
        table(pairs + pairs[:5], "warc_id string, kb_id string, n_mentions long"),
        table(bag_rows(docs), "warc_id string, mention string, n long, n_mentions long"),
        table(bag_rows(nouns), "kb_id string, mention string, n long, n_mentions long"),
        {(d, k) for d, k, _ in pairs},
    )


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_scores_equal_loops(table, bags, threshold):
    pairs, counts, nouns, wanted = make(table, bags)
    got = scoring.similarity_scores(pairs, counts, nouns, threshold)
    assert {(r.warc_id, r.kb_id): r.score for r in got.collect()} == pytest.approx(brute.scores(*bags, wanted, threshold))


def test_score_over_abstract_nouns(table, bags):
    pairs, counts, nouns, wanted = make(table, bags)
    got = {(r.warc_id, r.kb_id): r.score for r in scoring.similarity_scores(pairs, counts, nouns, normalize="abstract").collect()}
    by_document = brute.scores(*bags, wanted)
    want = {(d, k): s * len(bags[0][d]) / len(bags[1][k]) if k in bags[1] else 0.0 for (d, k), s in by_document.items()}
    assert got == pytest.approx(want)


def test_record_against_itself(table):
    rows = bag_rows({"1": ["Foo", "Bar", "Bar"]})
    counts = table(rows, "warc_id string, mention string, n long, n_mentions long")
    pairs = table([("1", "1", 3)], "warc_id string, kb_id string, n_mentions long")
    assert scoring.similarity_scores(pairs, counts, counts.withColumnRenamed("warc_id", "kb_id")).first().score == pytest.approx(5 / 3)


def test_best_candidate_and_threshold(table):
    rows = [
        ("1", "A", "/m/2", 1.0, 0.5),
        ("1", "A", "/m/1", 1.0, 0.5),
        ("1", "A", "/m/0", 0.5, 0.5),
        ("1", "A", "/m/3", 9.0, 0.4),
        ("1", "B", "/m/9", 1.0, 0.2),
        ("1", "C", "/m/9", 1.0, 0.19),
    ]
    best = scoring.best_candidate(table(rows, "warc_id string, mention string, kb_id string, search_score double, score double"))
    assert {r.mention: r.kb_id for r in best.collect()} == {"A": "/m/1", "B": "/m/9", "C": "/m/9"}
    assert {r.mention for r in scoring.link_threshold(best).collect()} == {"A", "B"}


def test_evaluation(table):
    schema = "warc_id string, mention string, kb_id string"
    gold = table([("1", "A", "x"), ("1", "B", "y"), ("2", "A", "x"), ("2", "A", "x")], schema)
    links = table([("1", "A", "x"), ("1", "A", "x"), ("1", "B", "z")], schema)
    row = link_eval(links, gold).first()
    assert tuple(row) == pytest.approx((3, 2, 1, 0.5, 1 / 3, 0.4))
    assert tuple(link_eval(links.limit(0), gold.limit(0)).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    published = [(560, 61, 7, 0.11475409836065574, 0.0125, 0.022544283413848634), (560, 169, 12, 0.07100591715976332, 0.02142857142857143, 0.03292181069958847)]
    for n_gold, n_linked, n_correct, *ratios in published:
        gold = table([(str(i), "m", "k") for i in range(n_gold)], schema)
        links = table([(str(i) if i < n_correct else f"x{i}", "m", "k") for i in range(n_linked)], schema)
        assert list(link_eval(links, gold).first())[3:] == pytest.approx(ratios)


def test_least_score_equals_a_filter_and_pairs_are_read_once(table, bags):
    pairs, counts, nouns, _ = make(table, bags)
    pairs, similar = stored(pairs, "pairs"), stored(similar_words(counts.select("mention"), nouns.select("mention")), "similar")
    for normalize in ("document", "abstract"):
        whole = scoring.similarity_scores(pairs, counts, nouns, normalize=normalize, similar=similar).collect()
        got = scoring.similarity_scores(pairs, counts, nouns, normalize=normalize, similar=similar, min_score=0.2)
        want = sorted(tuple(r) for r in whole if r.score >= 0.2)
        assert sorted(map(tuple, got.collect())) == want and 0 < len(want) < len(whole)
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("ReadSchema: struct<warc_id:string,kb_id:string") == 1
