import functools
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from tether.functions import keys
from tether.operators import dictionary, search
from tether.operators import mentions as m
from tether.operators.mentions import mention_counts
from tether.operators.rows import keyed
from tether.plans import linking
from tether.plans.documents import document_mentions, record_mentions
from tether.plans.linking import best_links, link_entities
from tether.session import shared_dir
from workload import queries as wq
from workload import tables as t
from workload.oracles import ORACLES
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tiny(table):
    docs = [("1", "Foo Bar went. Foo saw Alpha and Gamma"), ("2", "Foo alone with nothing in common"), ("3", "")]
    labels = [("/m/01", "Foo Bar"), ("/m/02", "Foo"), ("/m/03", "Alpha")]
    triples = []
    for kb, text, lang in [("1", "Foo Bar and Alpha and Gammas", "en"), ("2", "Zeta Eta", "en"), ("3", "Alpha", "de")]:
        triples += [(f"s{kb}", keys.SAME_AS, f"{keys.KB_NAMESPACE}m.0{kb}"), (f"s{kb}", keys.SAME_AS, f"p{kb}"), (f"p{kb}", keys.ABSTRACT, f'"{text}"@{lang}')]
    return (
        table(docs, "warc_id string, body string"),
        table(labels, "kb_id string, label string"),
        table(triples, "s string, p string, o string"),
    )


def collected(df):
    return sorted(map(tuple, df.collect()))


def test_links(tiny):
    # Bag of record 1: Foo Bar Foo Alpha Gamma, "Foo Bar". Nouns of /m/01: Foo Bar Alpha Gammas, "Foo Bar".
    assert collected(link_entities(*tiny)) == [
        ("1", "Bar", "/m/01"),
        ("1", "Foo", "/m/01"),
        ("1", "Foo", "/m/01"),
        ("1", "Foo Bar", "/m/01"),
        ("2", "Foo", "/m/01"),
    ]
    best = {(r.warc_id, r.mention): (r.n, r.score) for r in best_links(*tiny).collect()}
    assert best["1", "Foo"] == (2, pytest.approx(6 / 6)) and best["2", "Foo"] == (1, pytest.approx(1 / 1))


def test_threshold_and_order_of_rows(tiny):
    docs, labels, triples = tiny
    low, high = collected(link_entities(*tiny)), collected(link_entities(*tiny, threshold=1.01))
    assert set(high) <= set(low) and high == []
    shuffled = link_entities(docs.repartition(3), labels.orderBy("label", ascending=False), triples.repartition(5, "p"))
    assert collected(shuffled) == low


def test_unrelated_rows_change_nothing(tiny, table):
    docs, labels, triples = tiny
    more = docs.unionByName(table([("9", "Foo Bar Foo Bar")], "warc_id string, body string"))
    assert [r for r in collected(link_entities(more, labels, triples)) if r[0] != "9"] == collected(link_entities(*tiny))


def test_text_plan_runs_in_the_jvm(spark, tiny):
    plan = link_entities(*tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["warc_id", "mention", "kb_id"] and df.count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


def test_every_document_is_read(spark):
    assert t.docs(spark, SF).count() == t.table(spark, SF, "documents").count()


def same(value):
    return round(value, 6) if isinstance(value, float) else value


# Variants of whole linking runs, whose parts other queries compare; check.py compares these too. TETHER_ALL_QUERIES=1 runs all of them here.
LONG = set() if os.environ.get("TETHER_ALL_QUERIES") else set(
    "similarity_score_by_abstract best_candidate link_threshold links_tsv link_entities_by_type link_entities_with_lexicon link_entities_streamed".split()
)


def once(fn):
    """``fn`` of a session and a folder, run once for each further text."""
    results = {}

    @functools.wraps(fn)
    def run(spark, sf_dir, *more):
        key = tuple(x for x in more if isinstance(x, str))
        if key not in results:
            results[key] = fn(spark, sf_dir, *more)
        return results[key]

    return run


@pytest.fixture(scope="module")
def shared_inputs():
    """Inputs that many queries derive in the same way are derived once for all tests of this module."""
    patch = pytest.MonkeyPatch()
    for name in ("_lemma_options", "_labels", "_knowledge", "_mentions", "_nouns", "_chunks"):
        patch.setattr(wq, name, once(getattr(wq, name)))
    yield
    patch.undo()


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in LONG])
def test_query_equals_sql(spark, shared_inputs, name):
    con = duckdb.connect()
    for view in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    df = REGISTRY[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    want = sorted([tuple(map(same, r)) for r in cursor.fetchall()], key=repr)
    assert sorted([tuple(map(same, r)) for r in df.select(columns).collect()], key=repr) == want


def test_hot_anchor_makes_no_pairs(spark, table):
    """Labels that share their inner word are anchored on another piece."""
    docs = spark.range(400).select(F.col("id").cast("string").alias("warc_id"), F.concat(F.lit("he is one of them, Univ"), "id", F.lit(" of Town"), "id", F.lit(".")).alias("body"))
    labels = spark.range(300).select(F.concat(F.lit("Univ"), "id", F.lit(" of Town"), "id").alias("label"), F.lit("/m/0").alias("kb_id"))
    near = []
    plain = dictionary.balanced_join

    def counted(left, right, on):
        joined = plain(left, right, on)
        near.append(joined.count())
        return joined

    dictionary.balanced_join = counted
    try:
        found = dictionary.dictionary_labels(docs, labels)
    finally:
        dictionary.balanced_join = plain
    texts = [r.body for r in docs.collect()]
    assert found.count() == sum(r.label in text for r in labels.collect() for text in texts)
    assert near[0] < 3000


def test_documents_without_typed_entities_stay(table):
    docs = table([("1", "We saw Foo there"), ("2", "nothing here"), ("3", ""), ("4", "We saw Bar")], "warc_id string, body string")
    names = table([("Foo", "PERSON"), ("Bar", "GPE")], "name string, type string")
    assert {r.warc_id: r.mentions for r in document_mentions(docs, gazetteer=names).collect()} == {"1": ["Foo"], "2": [], "3": [], "4": ["Bar"]}
    assert {r.warc_id: r.mentions for r in document_mentions(docs, gazetteer=names, types=["GPE"]).collect()} == {"1": [], "2": [], "3": [], "4": ["Bar"]}


def test_lemmas_reach_mentions(table):
    docs = table([("1", "We met Dogs and Geese"), ("2", "Foo")], "warc_id string, body string")
    lexicon = table([("Dog",), ("Goose",)], "word string")
    odd = table([("Geese", "Goose")], "word string, form string")
    assert {r.warc_id: r.mentions for r in document_mentions(docs, lemma_lexicon=lexicon, lemma_exceptions=odd).collect()} == {"1": ["Dog", "Goose"], "2": ["Foo"]}


def test_records_that_share_an_id_are_scored_alone(tiny, table):
    docs, labels, triples = tiny
    texts = [("1", "Foo Bar and Alpha"), ("1", "Foo Bar met Zeta and Eta and Theta"), ("1", "Foo Bar and Alpha")]
    shared = table(texts, "warc_id string, body string")
    apart = table([(str(i), body) for i, (_, body) in enumerate(texts)], "warc_id string, body string")
    want = sorted(("1", r.mention, r.n, r.kb_id, r.score) for r in best_links(apart, labels, triples).collect())
    got = [(r.warc_id, r.mention, r.kb_id, r.score) for r in best_links(shared, labels, triples).collect() for _ in range(r.n)]
    assert sorted(got) == sorted((w[0], w[1], w[3], w[4]) for w in want for _ in range(w[2]))
    assert len({r[3] for r in got if r[1] == "Foo Bar"}) == 2
    assert collected(link_entities(shared, labels, triples)) == sorted(("1", m, k) for _, m, k in collected(link_entities(apart, labels, triples)))
    counts = mention_counts(record_mentions(keyed(shared)))
    assert sorted((r.warc_id.id, r.mention, r.n, r.n_mentions) for r in counts.collect()) == sorted(
        [("1", x, 2, 8) for x in ("Foo", "Bar", "Alpha", "Foo Bar")] + [("1", x, 1, 6) for x in ("Foo", "Bar", "Zeta", "Eta", "Theta", "Foo Bar")]
    )


def test_tied_hits_keep_the_order_of_the_response(table):
    hits = table([("m", 0, "b", "x", 1.0), ("m", 1, "a", "y", 1.0), ("m", 2, "c", "z", 2.0)], "mention string, pos int, kb_id string, label string, search_score double")
    assert [r.kb_id for r in search.top_hits(hits, 2).orderBy("rank").collect()] == ["c", "b"]


def test_candidates_are_scored_without_their_mentions(tiny):
    docs, labels, triples = tiny
    counts = mention_counts(record_mentions(keyed(docs)))
    scored = linking.scored_candidates(counts, labels, triples).select("warc_id.id", "kb_id", "score").distinct()
    assert collected(linking.record_scores(counts, labels, triples).select("warc_id.id", "kb_id", "score")) == collected(scored)


@pytest.mark.parametrize("name", ["link_entities_from_responses", "link_entities_with_lexicon"])
def test_texts_become_mentions_once(spark, monkeypatch, name):
    """Stored answers and a learned lexicon need the mentions or words of all texts before links do; texts are not cleaned again for those."""
    made = []

    def counted(function):
        def call(docs, *args, **options):
            made.append("body" in docs.columns and any("documents.parquet" in f for f in docs.inputFiles()))
            return function(docs, *args, **options)

        return call

    monkeypatch.setattr(m, "word_arrays", counted(m.word_arrays))
    monkeypatch.setattr(m, "text_mention_arrays", counted(m.text_mention_arrays))
    assert REGISTRY[name](spark, SF).columns == ["warc_id", "mention", "kb_id"]
    assert sum(made) == 1
