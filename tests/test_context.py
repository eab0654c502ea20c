import math
import random
from itertools import product

import pytest

from tether.functions import words as fw
from tether.operators import context
from tether.operators import mentions as m
from tether.plans.documents import document_mentions

USES = "word string, tag string, n long"
MOVES = "before string, tag string, n long"


def cost(part, whole):
    exact = -1000 * math.log(part / whole)
    return math.floor(abs(exact) + 0.5) * (1 if exact > 0 else -1)


def brute_tags(words, uses, moves):
    """The best of all sequences; of equal ones the first when read from the end."""
    tags = sorted({t for b, t, _ in moves} | {b for b, _, _ in moves} - {""} - {""})
    tags = [t for t in tags if t]
    counts = {(b, t): 1 + sum(n for x, y, n in moves if (x, y) == (b, t)) for b in ["", *tags] for t in ["", *tags]}
    move = {(b, t): cost(n, sum(v for (x, _), v in counts.items() if x == b)) for (b, t), n in counts.items()}
    total = sum(n for *_, n in uses)

    def choices(word):
        listed = {t: n for w, t, n in uses if w == word.lower()}
        if len(listed) < 2 or not "A" <= word[0] <= "Z":
            return {"NNP" if "A" <= word[0] <= "Z" else "NN": 0}
        return {t: cost(n, sum(listed.values())) - cost(sum(x for _, y, x in uses if y == t), total) for t, n in listed.items()}

    per_word = [choices(w) for w in words]

    def whole(path):
        return sum(c[t] for c, t in zip(per_word, path)) + sum(move[a, b] for a, b in zip(("", *path), (*path, "")))

    return list(min(product(*per_word), key=lambda path: (whole(path), path[::-1])))


@pytest.mark.parametrize("seed", range(4))
def test_tags_equal_the_best_of_all_sequences(table, seed):
    r = random.Random(seed)
    vocabulary = ["A", "Bo", "Cy", "Di", "a", "bo", "z", "Zu", "E1"]
    tags = ["NN", "NNP"] + (["VB"] if seed % 2 else [])
    uses = [(w.lower(), t, r.choice([1, 2, 2, 5, 40])) for w in ["A", "Bo", "Cy", "Di"] for t in tags if r.random() < 0.9] + [("zu", "NNP", 7)]
    moves = [(b, t, r.choice([0, 1, 1, 3, 30])) for b in ["", *tags] for t in ["", *tags]]
    docs = [[r.choice(vocabulary) for _ in range(r.randint(0, 8))] for _ in range(150)]
    rows = table(list(enumerate(docs)), "warc_id int, words array<string>")
    got = context.tag_in_context(rows, table(uses, USES), table(moves, MOVES)).collect()
    assert {r.warc_id: [(t.word, t.tag) for t in r.tagged] for r in got} == {i: list(zip(d, brute_tags(d, uses, moves))) for i, d in enumerate(docs)}


def test_neighbours_decide(table):
    """The same word is a name between names and none at the head of a sentence of common words."""
    rows = table([("1", ["Rose", "went", "home"]), ("2", ["Ann", "Rose", "Lee"]), ("3", [])], "warc_id string, words array<string>")
    uses = table([("rose", "NN", 10), ("rose", "NNP", 10)], USES)
    moves = table([("NNP", "NNP", 90), ("NNP", "NN", 10), ("NN", "NN", 90), ("NN", "NNP", 5), ("", "NN", 50), ("", "NNP", 50)], MOVES)
    got = {r.warc_id: [t.tag for t in r.tagged] for r in context.tag_in_context(rows, uses, moves).collect()}
    assert got == {"1": ["NN", "NN", "NN"], "2": ["NNP", "NNP", "NNP"], "3": []}
    docs = table([("1", "Rose went home"), ("2", "Ann Rose Lee")], "warc_id string, body string")
    found = {r.warc_id: r.mentions for r in document_mentions(docs, tag_uses=uses, tag_moves=moves).collect()}
    assert found == {"1": [], "2": ["Ann", "Rose", "Lee", "Ann Rose Lee"]}


def test_counts_of_uses_and_moves(table):
    rows = table([("1", ["The", "dog", "The"]), ("2", []), ("3", ["Dog"])], "warc_id string, words array<string>")
    assert {tuple(r) for r in context.tag_uses(rows).collect()} == {("the", "NNP", 2), ("dog", "NN", 1), ("dog", "NNP", 1)}
    moves = {(r.before, r.tag): r.n for r in context.tag_moves(m.tag_tokens(rows)).collect()}
    assert moves == {("", "NNP"): 2, ("NNP", "NN"): 1, ("NN", "NNP"): 1, ("NNP", ""): 2, ("", ""): 1}


def test_a_long_stretch_of_open_words(table):
    rows = table([("1", ["Rose"] * 3000)], "warc_id string, words array<string>")
    uses = table([("rose", "NN", 10), ("rose", "NNP", 11), ("dog", "NN", 100)], USES)
    moves = table([("NNP", "NNP", 90), ("NN", "NN", 90)], MOVES)
    assert {t.tag for t in context.tag_in_context(rows, uses, moves).first().tagged} == {fw.NOUN}


def test_too_many_tags(table):
    rows = table([("1", ["Rose"])], "warc_id string, words array<string>")
    moves = table([("", f"T{i}", 1) for i in range(context.MOST_TAGS + 1)], MOVES)
    with pytest.raises(ValueError, match="more than 64 tags"):
        context.tag_in_context(rows, table([("rose", "T1", 1)], USES), moves)
