import random

import pytest
from brute import lemma
from pyspark.sql import functions as F

from tether.operators import lemmas as lemma_module
from tether.operators import mentions as m
from tether.operators import rows
from tether.operators.lemmas import NOUN_ENDINGS, capitals_decide, lemmas
from tether.session import stored


def test_lemmas_equal_rule_loop(table):
    r = random.Random(5)
    stems = ["a", "ba", "bus", "wolf", "box", "man", "fish", "church", "city", "quiz", "ss", "x"]
    tails = ["", "s", "es", "ses", "ves", "xes", "zes", "ches", "shes", "men", "ies", "ss", "sses", "sss"]
    words = sorted({r.choice(stems) + r.choice(tails) + r.choice(tails) for _ in range(400)} | {"s", "men", "ses", "Dogs"})
    lexicon = {w for w in words if r.random() < 0.3} | {"wolf", "box", "man", "fish", "city", "church", "bus"}
    exceptions = {"bas": ["ba"], "xmen": ["nowhere"], "boxes": ["fish", "box"][:1]}
    got = lemmas(
        table([(w,) for w in words], "word string"),
        table([(w,) for w in lexicon], "word string"),
        table([(w, f) for w, forms in exceptions.items() for f in forms], "word string, form string"),
    )
    assert {x.word: x.lemma for x in got.collect()} == {w: lemma(w, lexicon, NOUN_ENDINGS, exceptions) for w in words}


def test_lemmas_in_documents(table):
    docs = table([("1", "Two dogs-houses, dogs and Dogs 4Fdogs!"), ("2", "")], "warc_id string, body string")
    lexicon = table([("dog",)], "word string")
    got = {r.warc_id: r.words for r in m.word_arrays(docs, lexicon).collect()}
    assert got == {"1": ["Two", "dogshouses", "dog", "and", "Dogs", "dog"], "2": []}


def by_full_stage(docs, lexicon, odd=None):
    """Every word through the lemma stage, then tags."""
    return {r.warc_id: r.mentions for r in m.mention_arrays(m.tag_tokens(m.word_arrays(docs, lexicon, odd))).collect()}


def random_docs(table, seed, n=120):
    r = random.Random(seed)
    atoms = ["Dogs", "dogs", "Dog", "Boxes", "Men", "men", "Wolves", "wolves", "1s", "9es", "'s", "s", "Es", "es", "4Fs", "1Dogs", "-Cities", "Geese", "geese", "Zs", "The", "x", "X", "\xe9s", "_", "As"]
    return table([(str(i), " ".join(r.choice(atoms) for _ in range(r.randint(0, 14)))) for i in range(n)], "warc_id string, body string")


LEXICONS = [
    (["Dog", "dog", "Box", "man", "wolf", "Wolf", "A", "City"], None, True),
    (["Dog", "Goose", "1Dog", "-City"], [("Geese", "Goose"), ("geese", "goose")], True),
    # Words without a letter, and lower-case words with capitalised or empty forms, matter too.
    (["Dog", "1", "9", "\xe9", "'"], None, False),
    (["Dog", "Goose", "5"], [("geese", "Goose")], False),
    (["Dog", "x", "5x"], [("x", "5"), ("men", "4F")], False),
]


@pytest.mark.parametrize(("known", "odd", "capitals"), LEXICONS)
def test_capitalised_words_are_enough(table, known, odd, capitals):
    docs = random_docs(table, len(known))
    lexicon = table([(w,) for w in known], "word string")
    exceptions = odd and table(odd, "word string, form string")
    assert capitals_decide(lexicon, exceptions) == capitals
    got = {r.warc_id: r.mentions for r in m.text_mention_arrays(docs, None, lexicon, exceptions).collect()}
    assert got == by_full_stage(docs, lexicon, exceptions)
    assert got != {r.warc_id: r.mentions for r in m.text_mention_arrays(docs).collect()}
    chunks = {r.warc_id: r.chunks for r in m.text_chunk_arrays(docs, lexicon, exceptions).collect()}
    assert chunks == {r.warc_id: r.chunks for r in m.chunk_arrays(m.tag_tokens(m.word_arrays(docs, lexicon, exceptions))).collect()}


def test_documents_are_read_twice_at_most(spark, tmp_path, table, monkeypatch):
    path = str(tmp_path / "docs")
    random_docs(table, 3).write.parquet(path)
    lexicon = table([("Dog",)], "word string")
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    for module in (m, lemma_module):
        monkeypatch.setattr(module, "stored", kept)
    found = m.text_mention_arrays(spark.read.parquet(path), None, lexicon)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("ReadSchema: struct<warc_id:string,body:string>") for p in plans) == 2


def test_words_beside_the_changed_ones_stay(table):
    docs = table([("1", "Two Dogs of Mr Dogs-Wolves 4FDogs, Dogs"), ("2", "no names")], "warc_id string, body string")
    got = {r.warc_id: r.mentions for r in m.text_mention_arrays(docs, None, table([("Dog",)], "word string")).collect()}
    assert got == {"1": ["Two", "Dog", "DogsWolves", "Dog", "Dog", "Two Dog", "Mr DogsWolves Dog Dog"], "2": []}


def test_only_tokens_that_may_change_are_asked(table, monkeypatch):
    """With irregular words too, other tokens never leave their text."""
    docs = table([("1", "Two geese\x0band dogs's 4Fdogs saw (aurae) men"), ("2", "none")], "warc_id string, body string")
    lexicon = table([("dog",), ("man",), ("aura",), ("goose",)], "word string")
    odd = table([("aurae", "aura"), ("geese", "goose"), ("geese", "goose"), (None, "x")], "word string, form string")
    asked = []

    def kept(df, name):
        out = stored(df, name)
        if name == "words-asked":
            asked.extend(w for r in out.collect() for w in r.words)
        return out

    monkeypatch.setattr(m, "stored", kept)
    got = {r.warc_id: r.words for r in m.word_arrays(docs, lexicon, odd).collect()}
    assert got == {"1": ["Two", "goose", "and", "dog", "s", "dog", "saw", "aura", "man"], "2": ["none"]}
    assert sorted(asked) == ["'s", "aurae", "dogs", "geese", "men"]


def test_words_are_looked_up_in_a_share_of_the_map(table):
    pairs = table([("1", f"w{i}", f"v{i}") for i in range(2000)] * 2 + [("2", "a", "b")], "warc_id string, word string, new string")
    maps = rows.word_maps(pairs, "word", "new", "swaps")
    asked = table([("1", ["w7", "w1999", "x"]), ("2", ["a", "w7"]), ("3", ["a"])], "warc_id string, words array<string>").join(maps, "warc_id", "left")
    largest = F.array_max(F.transform("swaps", lambda s: F.coalesce(F.size(s), F.lit(0))))
    got = asked.select("warc_id", F.transform("words", lambda w: rows.looked_up("swaps", w)).alias("found"), largest.alias("n")).collect()
    assert {r.warc_id: r.found for r in got} == {"1": ["v7", "v1999", None], "2": ["b", None], "3": [None]}
    assert next(r.n for r in got if r.warc_id == "1") < 100


def test_text_is_cut_down_to_names_once(spark, tmp_path, table, monkeypatch):
    """Texts are read by one job, and what later ones read holds names and gaps only."""
    path = str(tmp_path / "docs")
    text = "small words " * 40 + "Two Dogs 1 Dogs, 9a (of) " + "more small words " * 40
    table([("1", text), ("2", None), ("3", "")], "warc_id string, body string").write.parquet(path)
    plans, left = [], []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = stored(df, name)
        if name == "names":
            left.extend(r.body for r in out.collect())
        return out

    for module in (m, lemma_module):
        monkeypatch.setattr(module, "stored", kept)
    found = m.text_mention_arrays(spark.read.parquet(path), None, table([("Dog",)], "word string"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum(f"{path}]" in p for p in plans) == 1
    assert sorted(x.strip() for x in left if x) == ["x Two Dogs 1 Dogs, x"]
    assert {r.warc_id: r.mentions for r in found.collect()} == {"1": ["Two", "Dog", "Dog", "Two Dog Dog"], "2": None, "3": []}
