import random
import re

from pyspark.sql import functions as F

from tether.functions import words as fw
from tether.operators import mentions as m
from tether.plans.documents import document_mentions

EDGES = ["4Fcaf\xe9 3AB New-York U.S. snake_case 1E2 na\xefve", "The the DOD A Al", "don't It's he'll 'tis N'T", "foo--bar end...Start ''q``", ""]


def random_texts(n=300):
    r = random.Random(3)
    atoms = ["The", "the", "DOD", "A", "Al", "x", "Foo", "bar", "4F", "1E2", "-", "--", "...", "'s", "n't", "_", "\xe9", "Z", ".", "9"]
    gaps = [" ", "", "\n", ", ", "  ", "(", "@", "\t", "\x0b", "&"]
    return ["".join(r.choice(atoms) + r.choice(gaps) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_tokens(table):
    got = table([(t,) for t in EDGES], "t string").select(fw.tokens(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [
        ["4Fcaf\xe9", "3AB", "New-York", "U.S.", "snake_case", "1E2", "na\xefve"],
        ["The", "the", "DOD", "A", "Al"],
        ["do", "n't", "It", "'s", "he", "'ll", "'tis", "N'T"],
        ["foo", "bar", "end", "Start", "q"],
        [],
    ]


def test_clean_words_equals_cleaning_each_token(table):
    df = table([(t,) for t in EDGES + random_texts()], "t string")
    each = fw.nonempty(F.transform(fw.tokens(F.col("t")), lambda w: fw.clean(fw.strip_hex(w))))
    rows = df.select("t", fw.tokens(F.col("t")).alias("tokens"), fw.clean_words(F.col("t")).alias("whole"), each.alias("each")).collect()
    for r in rows:
        plain = [re.sub(r"[0-9]", "", re.sub(r"[\W_]+", "", re.sub("[0-9][A-F]", "", w), flags=re.ASCII)) for w in r.tokens]
        assert r.whole == r.each == [w for w in plain if w], r.t


def test_cleaned_edges(table):
    df = table([(EDGES[0],)], "t string").select(fw.clean_words(F.col("t")).alias("x"))
    assert df.first().x == ["caf", "B", "NewYork", "US", "snakecase", "nave"]
    assert table([("na\xefve_1!",)], "t string").select(fw.strip_nonword(F.col("t"), unicode=True).alias("x")).first().x == "na\xefve1"


def test_word_filters(table):
    rows = table([(w,) for w in ("The", "the", "DOD", "A", "Al", "al", "US")], "word string")
    assert {r.word for r in m.remove_stop_words(rows).collect()} == {"The", "DOD", "A", "Al", "al", "US"}
    assert {r.word for r in m.long_or_acronyms(rows).collect()} == {"The", "the", "DOD", "A", "US"}


def test_runs_and_mentions(table):
    docs = table([("1", "Foo bar Big Red car Al The X Y end Foo"), ("2", ""), ("3", "lower only")], "warc_id string, body string")
    tagged = m.tag_tokens(m.word_arrays(docs))
    got = {r.warc_id: r.mentions for r in m.mention_arrays(tagged).collect()}
    assert got == {"1": ["Foo", "Big", "Red", "The", "X", "Y", "Foo", "Big Red", "Al The X Y"], "2": [], "3": []}
    counts = {(r.warc_id, r.mention): (r.n, r.n_mentions) for r in m.mention_counts(m.mention_arrays(tagged)).collect()}
    assert counts["1", "Foo"] == (2, 9) and counts["1", "Big Red"] == (1, 9)
    kinds = [(r.ord, r.kind) for r in m.mention_rows(m.mention_arrays(tagged)).orderBy("ord").collect()]
    assert kinds == [(i, "word" if i < 7 else "run") for i in range(9)]


def test_text_mentions_equal_tagged_mentions(table):
    docs = table([(str(i), t) for i, t in enumerate(EDGES + random_texts())], "warc_id string, body string")
    for options in ({}, {"stop_words": ["Foo", "the"]}):
        whole = {r.warc_id: r.mentions for r in m.text_mention_arrays(docs, **options).collect()}
        tagged = {r.warc_id: r.mentions for r in m.mention_arrays(m.tag_tokens(m.word_arrays(docs)), **options).collect()}
        assert whole == tagged


def test_very_long_run(table):
    docs = table([("1", "Word " * 30000)], "warc_id string, body string")
    found = m.text_mention_arrays(docs).first().mentions
    assert len(found) == 30001 and len(found[-1]) == 5 * 30000 - 1


def test_lexicon_overrides_rule(table):
    docs = table([("1", "The paris Paris is Red"), ("2", "")], "warc_id string, body string")
    lexicon = table([("the", "NN"), ("paris", "NNP")], "word string, tag string")
    tagged = {r.warc_id: [(t.word, t.tag) for t in r.tagged] for r in m.tag_tokens(m.word_arrays(docs), lexicon).collect()}
    assert tagged == {"1": [("The", "NN"), ("paris", "NNP"), ("Paris", "NNP"), ("is", "NN"), ("Red", "NNP")], "2": []}


def test_tag_lexicon(table):
    words = table([("1", ["The", "the", "the", "Bob", "Bob", "bob", "x"])], "warc_id string, words array<string>")
    got = {r.word: (r.n, r.n_capital, r.tag) for r in m.tag_lexicon(words).collect()}
    assert got == {"the": (3, 1, "NN"), "bob": (3, 2, "NNP"), "x": (1, 0, "NN")}


def typed(docs, gazetteer, types=None):
    return m.typed_entities(m.chunk_arrays(m.tag_tokens(m.word_arrays(docs))), gazetteer, types)


def test_typed_entities(table):
    docs = table([("1", "Bob met Big Red and Bob again"), ("2", "nobody")], "warc_id string, body string")
    gazetteer = table([("Bob", "PERSON"), ("Bob", "GPE"), ("Big Red", "ORGANIZATION"), ("Red", "GPE")], "name string, type string")
    found = typed(docs, gazetteer)
    assert {(r.pos, r.word_at, r.entity, r.type) for r in found.collect()} == {
        (0, 0, "Bob", "PERSON"),
        (0, 0, "Bob", "GPE"),
        (1, 0, "Big Red", "ORGANIZATION"),
        (2, 0, "Bob", "PERSON"),
        (2, 0, "Bob", "GPE"),
    }
    assert {(r.entity, r.type) for r in m.entity_types(found).collect()} == {("Bob", "PERSON"), ("Big Red", "ORGANIZATION")}
    # The longer name takes its words though its type is not wanted.
    places = m.entity_mentions(typed(docs, gazetteer, ["GPE"]), docs)
    assert {r.warc_id: r.mentions for r in places.collect()} == {"1": ["Bob"], "2": []}


def test_names_inside_runs(table):
    docs = table([("1", "we met President Barack Obama"), ("2", "A B C D C D E")], "warc_id string, body string")
    names = ["Barack Obama", "Obama", "A B C", "B C D E", "C D", "C D E", "", " ", "D  E"]
    found = typed(docs, table([(n, "X") for n in names], "name string, type string"))
    assert {(r.warc_id, r.word_at, r.entity) for r in found.collect()} == {("1", 1, "Barack Obama"), ("2", 0, "A B C"), ("2", 4, "C D E")}


def test_names_in_random_runs_equal_a_walk(table):
    r = random.Random(11)
    letters = "ABCD"
    names = sorted({" ".join(r.choice(letters) for _ in range(r.randint(1, 4))) for _ in range(25)})
    chunks = [[" ".join(r.choice(letters) for _ in range(r.randint(1, 12))) for _ in range(r.randint(0, 4))] for _ in range(60)] + [[" ".join("AB" * 500)]]
    want = set()
    for i, texts in enumerate(chunks):
        for pos, chunk in enumerate(texts):
            words, at = chunk.split(), 0
            while at < len(words):
                longest = max((n for n in range(1, len(words) - at + 1) if " ".join(words[at : at + n]) in names), default=0)
                if longest:
                    want.add((i, pos, at, " ".join(words[at : at + longest])))
                at += max(longest, 1)
    rows = table(list(enumerate(chunks)), "warc_id int, chunks array<string>")
    found = m.typed_entities(rows, table([(n, "X") for n in names], "name string, type string"))
    assert {(x.warc_id, x.pos, x.word_at, x.entity) for x in found.collect()} == want


def test_words_of_all_scripts(table):
    docs = table([("1", "Élan vital in Ōsaka Москва4 9F½x and naïve Straße_1")], "warc_id string, body string")
    assert m.word_arrays(docs, unicode=True).first().words == ["Élan", "vital", "in", "Ōsaka", "Москва", "½x", "and", "naïve", "Straße"]
    assert document_mentions(docs, unicode=True).first().mentions == ["Élan", "Ōsaka", "Москва", "Straße", "Ōsaka Москва"]
    lexicon = table([("Straße",), ("Москва",)], "word string")
    assert document_mentions(docs, unicode=True, lemma_lexicon=lexicon).first().mentions[:3] == ["Élan", "Ōsaka", "Москва"]


def test_unicode_words_equal_cleaning_each_token(table):
    df = table([(t,) for t in EDGES + random_texts() + ["½ ² Ⅳ é1é _ ß"]], "t string")
    each = fw.nonempty(F.transform(fw.tokens(F.col("t")), lambda w: fw.clean(fw.strip_hex(w), True)))
    for r in df.select(fw.clean_words(F.col("t"), True).alias("whole"), each.alias("each")).collect():
        assert r.whole == r.each


def test_names_are_found_in_what_is_left_of_a_text(table):
    """Also over tokens without letters, other scripts, and stretches of any length."""
    long = "A " + "small 1a (9) " * 200_000 + "Foo Bar"
    more = ["\xe9Foo Bar \xe9a Z", "4Fa Foo 4FA Bar", "1 2A 3 Foo", "a1 Foo 1 2 Bar 3 b", "Foo\x0bx\x0bBar", "x", " x Foo", "Foo -- 'S Bar", "11AB Foo 1\U0001f600b"]
    df = table([(t,) for t in EDGES + more + [long] + random_texts()], "t string")
    left = fw.only_letters(fw.name_text(fw.ready_text(F.col("t"))))
    whole = fw.clean_text(F.col("t"))
    rows = df.select(
        "t", fw.rule_mentions(left).alias("a"), fw.rule_mentions(whole).alias("b"), fw.rule_chunks(left).alias("c"), fw.rule_chunks(whole).alias("d"), F.length(left).alias("n")
    ).collect()
    for r in rows:
        assert (r.a, r.c) == (r.b, r.d), r.t[:200]
    assert min(r.n for r in rows if len(r.t) > 1000) < 1000
