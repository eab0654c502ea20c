import random

import brute
import pytest

from tether.operators import search


def corpus(seed, n_labels=250, n_mentions=60):
    r = random.Random(seed)
    # A third of the labels hold the most common word, and a few words are in most of the rest.
    vocabulary = ["the"] * 12 + ["of"] * 8 + ["new", "old"] * 3 + [f"w{i}" for i in range(25)]
    labels = {(f"/m/0{r.randint(0, 80)}", " ".join(r.choice(vocabulary).title() for _ in range(r.randint(1, 6)))) for _ in range(n_labels)}
    mentions = {" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 5))) for _ in range(n_mentions)} | {"The", "unknown", "THE the"}
    return sorted(labels), sorted(mentions)


@pytest.mark.parametrize(("seed", "size", "long"), [(1, 3, 64), (2, 10, 2), (3, 100, 64), (4, 1, 0), (5, 7, 1)])
def test_hits_equal_scoring_every_label(table, monkeypatch, seed, size, long):
    monkeypatch.setattr(search, "LONG_MENTION", long)
    labels, mentions = corpus(seed)
    hits = search.search_hits(table([(x,) for x in mentions], "mention string"), table(labels, "kb_id string, label string"), size)
    got = {}
    for r in sorted(hits.collect(), key=lambda r: (r.mention, r["rank"])):
        got.setdefault(r.mention, []).append((r.kb_id, r.label, pytest.approx(r.search_score, abs=2e-6)))
    want = brute.search(mentions, labels, size)
    assert set(got) == set(want)
    for mention, rows in want.items():
        assert [x[:2] for x in got[mention]] == [x[:2] for x in rows], mention
        assert [x[2] for x in rows] == [x[2] for x in got[mention]]


def test_candidates_are_cut_before_grouping(table):
    labels = [("/m/01", "Foo"), ("/m/01", "Foo Bar"), ("/m/02", "Foo Baz Qux"), ("/m/03", "Foo a b c")]
    mentions = table([("Foo",)], "mention string")
    got = search.best_candidates(mentions, table(labels, "kb_id string, label string"), results=2)
    assert {r.kb_id: r.labels for r in got.collect()} == {"/m/01": ["Foo", "Foo Bar"]}
    whole = search.search(mentions, table(labels, "kb_id string, label string"))
    assert {r.kb_id for r in whole.collect()} == {"/m/01", "/m/02", "/m/03"}


def test_top_hits_of_parsed_responses(table):
    hits = table([("a", "/m/1", "x", 1.0), ("a", "/m/2", "y", 3.0), ("a", "/m/3", "z", 2.0)], "mention string, kb_id string, label string, search_score double")
    got = search.top_hits(hits, 2).orderBy("rank").collect()
    assert [(r["rank"], r.kb_id) for r in got] == [(1, "/m/2"), (2, "/m/3")]


def test_ranking_keeps_only_the_first_rows_before_the_shuffle(table):
    labels = table([("/m/1", "a b")], "kb_id string, label string")
    plan = search.search_hits(table([("a",)], "mention string"), labels)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_very_long_mention(table):
    labels = [(f"/m/{i}", f"w{i} w{i + 1}") for i in range(400)]
    mention = " ".join(f"w{i}" for i in range(0, 300))
    got = search.search_hits(table([(mention,)], "mention string"), table(labels, "kb_id string, label string"), 20)
    want = brute.search([mention], labels, 20)[mention]
    assert [(r.kb_id, r.label) for r in got.orderBy("rank").collect()] == [x[:2] for x in want]


def test_mention_of_twenty_thousand_words(table, monkeypatch):
    """Rows grow with the words of a mention, not with their square."""
    labels = [(f"/m/{i}", f"w{i} w{i + 1}" + (" the" if i % 3 else "")) for i in range(20000)]
    mention = " ".join(f"w{i}" for i in range(20000)) + " the"
    made = []
    plain = search._word_hits

    def counted(words, postings):
        made.append((words.count(), words.join(postings, "word").count()))
        return plain(words, postings)

    monkeypatch.setattr(search, "_word_hits", counted)
    got = search.search_hits(table([(mention,), ("w7 the",)], "mention string"), table(labels, "kb_id string, label string"), 5).collect()
    assert made[0][0] == 20001 and made[0][1] < 5 * 20001
    assert {r.mention for r in got} == {mention, "w7 the"} and len(got) == 10
    best = next(r for r in got if r.mention == mention and r["rank"] == 1)
    assert best.label in {"w19999 w20000", "w0 w1"} or best.n_words == 3
