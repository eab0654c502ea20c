import random

from pyspark.sql import functions as F

from tether.operators import dictionary
from tether.operators.dictionary import dictionary_labels


def test_labels_equal_substring_test(table):
    r = random.Random(8)
    atoms = ["art", "cart", "Art", "of", "the", "a", "\xe9t\xe9", "New York", "x-y", "of the art"]
    gaps = [" ", "  ", "\n", "", ", "]
    docs = [(str(i), "".join(r.choice(atoms) + r.choice(gaps) for _ in range(r.randint(0, 15)))) for i in range(120)]
    labels = sorted({"".join(r.choice(atoms) + r.choice(gaps) for _ in range(r.randint(1, 4))) for _ in range(150)} | {"a", "rt", "t o", "f  ", "e a", "ar", "absent word here"})
    labels = [x for x in [*labels, " ", "  ", "\n"] if x]
    named = [(x, f"/m/{i % 7}") for i, x in enumerate(labels)]
    got = dictionary_labels(table([*docs, (None, "art")], "warc_id string, body string"), table(named, "label string, kb_id string"))
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(d, x, k) for d, text in docs for x, k in named if x in text}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_beginning_shared_by_all_makes_no_pairs(spark, monkeypatch):
    """Thousands of words and labels that begin alike: candidates are counted, not seconds."""
    met = []
    plain = dictionary.balanced_join

    def counted(left, right, on):
        joined = plain(left, right, on)
        if on == "gram":
            met.append(joined.count())
        return joined

    monkeypatch.setattr(dictionary, "balanced_join", counted)
    code = lambda column: F.translate(F.lpad(F.conv(column, 10, 26), 4, "0"), "0123456789ABCDEFGHIJKLMNOP", "abcdefghijklmnopqrstuvwxyz")
    docs = spark.range(4000).select(F.col("id").cast("string").alias("warc_id"), F.concat(F.lit("con"), code("id"), F.lit("ing and")).alias("body"))
    labels = spark.range(1000).select(F.concat(F.lit("con"), code(F.col("id") * 7), F.lit("x")).alias("label"), F.lit("/m/0").alias("kb_id"))
    here = spark.range(5).select(F.concat(F.lit("con"), code(F.col("id") * 7), F.lit("in")).alias("label"), F.lit("/m/1").alias("kb_id"))
    found = dictionary_labels(docs, labels.unionByName(here)).collect()
    assert len(found) == 5 and met[0] < 5000


def test_common_edges_are_counted_not_listed(spark, monkeypatch):
    """A label whose first piece ends most words is anchored elsewhere, and only the anchor's words become rows."""
    listed = []
    plain = dictionary._piece_words

    def counted(pieces, vocabulary):
        rows = plain(pieces, vocabulary)
        listed.append(rows.count())
        return rows

    monkeypatch.setattr(dictionary, "_piece_words", counted)
    docs = spark.range(2000).select(F.col("id").cast("string").alias("warc_id"), F.concat(F.lit("w"), "id", F.lit("a Rare"), "id").alias("body"))
    labels = spark.range(3).select(F.concat(F.lit("a Rare"), "id", F.lit("")).alias("label"), F.lit("/m/0").alias("kb_id"))
    found = {(r.warc_id, r.label) for r in dictionary_labels(docs, labels).collect()}
    assert found == {(str(i), f"a Rare{n}") for n in range(3) for i in range(2000) if str(i).startswith(str(n))}
    assert listed[0] > 2000 and listed[1] == len(found)
